"""Readability of documents: sentence length, terms, references. Totals are summed per document before they are divided."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import ratio

#: A full stop behind a digit ends no sentence.
SENTENCE_END = r"(?<!\d)[.!?。](?=\s|$)"
REFERENCE = r"제\s*\d+\s*[조항부장절]|§\s*\d+|\b[Ss]ection \d+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def sentence_count(text: Column) -> Column:
    """Sentence ends, one at least where there are words."""
    return F.when(word_count(text) > 0, F.greatest(F.regexp_count(text, F.lit(SENTENCE_END)), F.lit(1))).otherwise(0)


def sentence_length(sections: DataFrame, key: str, text: str) -> DataFrame:
    """``key, words, sentences, asl``: words by sentences over the whole document, not a mean of means."""
    totals = sections.groupBy(key).agg(F.sum(word_count(F.col(text))).alias("words"), F.sum(sentence_count(F.col(text))).alias("sentences"))
    return totals.withColumn("asl", ratio(F.col("words"), F.col("sentences")))


def term_density(tokens: DataFrame, key: str, token: str, hard: DataFrame) -> DataFrame:
    """``key, kinds, hard_kinds, density``: different hard terms among all different terms. ``hard`` has a column ``term``."""
    kinds = tokens.select(key, F.col(token).alias("term")).distinct()
    marked = kinds.join(hard.select("term").distinct().withColumn("_hard", F.lit(1)), "term", "left")
    return marked.groupBy(key).agg(F.count("*").alias("kinds"), F.count("_hard").alias("hard_kinds")).withColumn("density", ratio(F.col("hard_kinds"), F.col("kinds")))


def references_per_thousand(text: Column) -> Column:
    return ratio(F.regexp_count(text, F.lit(REFERENCE)) * 1000, word_count(text))


def missing_share(found: Column, required: Column) -> Column:
    """Share of required items (an array) that were not found; null if none is required."""
    return ratio(F.size(F.array_except(required, found)), F.size(F.array_distinct(required)))


def sensitivity(scores: DataFrame, key: str, first: str, second: str, weights: tuple[float, ...] = (0.3, 0.4, 0.5, 0.6, 0.7)) -> DataFrame:
    """``key, weight, score`` for several weights of the first axis; null where an axis is."""
    w = F.explode(F.array(*(F.lit(x) for x in weights)))
    return scores.withColumn("weight", w).select(key, "weight", (F.col("weight") * F.col(first) + (1 - F.col("weight")) * F.col(second)).alias("score"))
