"""Joins beyond plain equality: substring with blocking, as-of, cascades of keys, best match with a margin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def containing(longer: DataFrame, shorter: DataFrame, text: str, part: str, gram: int = 3) -> DataFrame:
    """Pairs in which ``text`` contains ``part``, without comparing all with all: a part can only be in a text that has the
    part's first ``gram`` characters somewhere; a shorter part must be one of the text's stretches of its own length.
    Empty parts match nothing. Equal texts are searched once; their rows are then streamed past what was found, unsorted."""

    def stretches(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("_searched") - size + 1)
        return F.when(F.length("_searched") >= size, F.transform(starts, lambda i: F.substring(F.col("_searched"), i, F.lit(size)))).otherwise(F.array().cast("array<string>"))

    grams = F.array_distinct(F.concat(*map(stretches, range(1, gram + 1))))
    texts = longer.select(F.col(text).alias("_searched")).distinct().withColumn("_gram", F.explode(grams))
    parts = shorter.withColumn("_head", F.substring(F.col(part), 1, gram))
    pairs = texts.join(parts, (F.col("_gram") == F.col("_head")) & F.contains("_searched", F.col(part))).drop("_gram", "_head")
    return longer.join(pairs.hint("shuffle_hash"), F.col(text) == F.col("_searched")).drop("_searched")


def as_of(left: DataFrame, right: DataFrame, on: Sequence[str], at: str, valid_from: str, bring: Sequence[str]) -> DataFrame:
    """Each left row with ``bring`` of the newest right row of its key that is not after it, null if there is none. Both
    sides go through one sort by key and time; the last right values are carried forward. Of right rows with equal
    key and time the greatest counts."""
    value = F.struct(F.col(valid_from).alias("_from"), *bring)
    events = left.select(*on, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.select(value).schema[0].dataType).alias("_value"))
    facts = right.groupBy(*on, F.col(valid_from).alias("_at")).agg(F.max(value).alias("_value")).select(*on, "_at", F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema[0].dataType).alias("_row"), "_value")
    w = Window.partitionBy(*on).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = events.unionByName(facts).withColumn("_last", F.last("_value", ignorenulls=True).over(w)).where("_side = 1")
    return carried.select("_row.*", F.col("_last._from").alias(valid_from), *(F.col(f"_last.{b}").alias(b) for b in bring))


def newest_edition(left: DataFrame, editions: DataFrame, on: Sequence[str], at: str, since: str) -> DataFrame:
    """Each left row with ``since`` of the newest edition of its key that is not after it. For few editions per key, as of
    rules and forms: they are one array per key, and the left rows, however many a key has, are not sorted."""
    dates = editions.groupBy(*on).agg(F.array_sort(F.collect_set(since)).alias("_dates"))
    usable = F.filter("_dates", lambda d: d <= F.col(at))
    return left.join(dates, list(on), "left").withColumn(since, F.try_element_at(usable, F.lit(-1))).drop("_dates")


def unique_match(left: DataFrame, right: DataFrame, on: Sequence[str], key: str, bring: str) -> DataFrame:
    """Left rows with ``bring`` and ``match``: MATCHED if exactly one right row has the key, AMBIGUOUS if more, else
    NO_CANDIDATE. The count is taken per key before the join."""
    candidates = right.groupBy(*on).agg(F.count_distinct(bring).alias("_n"), F.min(bring).alias("_one"))
    joined = left.join(candidates, list(on), "left")
    return joined.withColumn(bring, F.when(F.col("_n") == 1, F.col("_one"))).withColumn(
        "match", F.when(F.col("_n") == 1, "MATCHED").when(F.col("_n") > 1, "AMBIGUOUS").otherwise("NO_CANDIDATE")
    ).drop("_n", "_one")


def first_hit(left: DataFrame, steps: Sequence[tuple[str, DataFrame, str, str]], bring: str) -> DataFrame:
    """A cascade of equi-joins: each step (name, table, left key, table key) gives ``bring`` to rows that have none yet;
    ``step`` names the one that did. A table's key must be unique."""
    out = left.withColumn(bring, F.lit(None).cast("string")).withColumn("step", F.lit(None).cast("string"))
    for name, table, left_key, right_key in steps:
        found = table.select(F.col(right_key).alias("_key"), F.col(bring).cast("string").alias("_found"))
        out = out.join(found, F.col(left_key) == F.col("_key"), "left")
        out = out.withColumn("step", F.when(F.col(bring).isNull() & F.col("_found").isNotNull(), F.lit(name)).otherwise(F.col("step")))
        out = out.withColumn(bring, F.coalesce(bring, "_found")).drop("_key", "_found")
    return out


def best_with_margin(scored: DataFrame, keys: Sequence[str], score: Column, candidate: str, least: float, margin: float) -> DataFrame:
    """Per key the best candidate, if its score is ``least`` or more and ``margin`` above the second."""
    w = Window.partitionBy(*keys).orderBy(F.desc("_score"), candidate)
    top = scored.withColumn("_score", score).withColumn("_rank", F.row_number().over(w)).where("_rank <= 2")
    pivoted = top.groupBy(*keys).agg(
        F.max(F.when(F.col("_rank") == 1, F.col(candidate))).alias(candidate),
        F.max(F.when(F.col("_rank") == 1, F.col("_score"))).alias("score"),
        F.max(F.when(F.col("_rank") == 2, F.col("_score"))).alias("second"),
    )
    return pivoted.where((F.col("score") >= least) & (F.col("second").isNull() | (F.col("score") - F.col("second") >= margin)))


def token_similarity(left: Column, right: Column) -> Column:
    """Jaccard similarity of two arrays as sets; null if both are empty."""
    return F.try_divide(F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right)))


def group_similarity(df: DataFrame, keys: Sequence[str], id_: str, name: str, most: int = 1000) -> DataFrame:
    """``a, b, similarity`` of every two rows of a group (``keys``) with a < b: the Jaccard similarity of their names' words.
    All pairs are the result; so each two different names are compared once, and the rows that bear them only carry the
    figure. The rows of a name are dealt in arrays of ``most`` at most, and pairs by group and name, not by group."""
    spark, own = df.sparkSession, [F.col(k).alias(f"_{k}") for k in keys]
    words = lambda c: F.split(c, " ")
    order = Window.partitionBy(*keys, name).orderBy(id_)
    chunk = F.floor((F.row_number().over(order) - 1) / most)
    bearers = df.select(*keys, F.col(name).alias("_other"), F.col(id_).alias("_b"), chunk.alias("_chunk")).groupBy(*keys, "_other", "_chunk").agg(F.collect_list("_b").alias("_bs"))
    names = df.select(*own, F.col(name).alias("_name")).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    found = bearers.join(names, on).select(*(f"_{k}" for k in keys), "_name", "_bs", token_similarity(words("_name"), words("_other")).alias("similarity"))
    rows = df.select(*keys, F.col(id_).alias("a"), F.col(name).alias("_own")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "_own")
    pairs = rows.join(found.hint("shuffle_merge"), on & F.col("_own").eqNullSafe(F.col("_name")))
    return pairs.select("a", F.explode("_bs").alias("b"), "similarity").where("a < b")


def orphans(child: DataFrame, parent: DataFrame, child_key: Column, parent_key: Column) -> DataFrame:
    """Children whose key is given but has no parent."""
    return child.where(child_key.isNotNull()).join(parent, child_key == parent_key, "left_anti")
