"""Quality rules as a learned decision list.

From labelled documents' statistics, sequential covering learns an ordered list of rules: each is a conjunction
of thresholds, grown on two thirds of the sample by information gain, pruned on the rest, and kept if it is
precise there; what it covers is then left out. The list becomes one Spark conditional expression. The document
gets the verdict of the first rule that holds, or that of the default.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_RE, checkpointed, map_lists, read

SYMBOLS = "#*$%&|<>"
WINDOW = 8
STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_digits long, n_marks long, n_same_words long, n_kinds long"


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """How many words stand in a run of ``window`` words that the list holds at least twice, the first included.

    Runs are numbered exactly by doubling: pairs of equal halves get equal numbers."""
    if len(words) <= window:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    have = 1
    while have < window:
        step = min(have, window - have)
        pairs = ids[: len(ids) - step] * (len(words) + 1) + ids[step:]
        kinds, ids = np.unique(pairs, return_inverse=True)
        if len(kinds) == len(ids):  # no pair twice, so no longer run either
            return 0
        have += step
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts named in ``STATISTICS``; all 0 for a null or empty text."""
    if not text:
        return (0,) * 11
    words = WORD_RE.findall(text)
    lines = [x for x in text.split("\n") if WORD_RE.search(x)]
    joined = "".join(words)
    ascii_upper = sum(map(str.isupper, words))
    return (
        len(words),
        len(joined),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        ascii_upper,
        sum(map(text.count, "0123456789")),
        text.count("!") + text.count("?"),
        sum(a == b for a, b in zip(words, words[1:])),
        len(set(words)),
    )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts of ``STATISTICS`` for every whole text; null counts as empty. Map-only."""

    def run(ids, texts):
        rows = [statistics(t) for t in texts]
        return [ids, *([r[k] for r in rows] for k in range(11))]

    return map_lists(docs, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {STATISTICS}", id_col, text_col)


def features() -> dict[str, Column]:
    """What thresholds are put on: counts per word, line or character."""
    words, lines, chars = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_lines", "word_chars"))
    return {
        "symbols_per_char": F.col("n_symbols") / chars,
        "dup_lines_per_line": F.col("n_dup_lines") / lines,
        "repeats_per_word": F.col("n_repeat_words") / words,
        "same_per_word": F.col("n_same_words") / words,
        "kinds_per_word": F.col("n_kinds") / words,
        "upper_per_word": F.col("n_upper") / words,
        "digits_per_char": F.col("n_digits") / chars,
        "marks_per_word": F.col("n_marks") / words,
        "chars_per_word": F.col("word_chars") / words,
        "words_per_line": F.col("n_words") / lines,
        "n_words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Rule:
    """Documents for which every condition ``(feature, at_least, threshold)`` holds are bad."""

    conditions: tuple[tuple[str, bool, float], ...]

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, at_least, threshold in self.conditions:
            out &= x[name] >= threshold if at_least else x[name] <= threshold
        return out

    def column(self) -> Column:
        out, columns = F.lit(True), features()
        for name, at_least, threshold in self.conditions:
            out = out & (columns[name] >= F.lit(threshold) if at_least else columns[name] <= F.lit(threshold))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>=' if a else '<='} {t:.6g}" for n, a, t in self.conditions) + " -> drop"


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, longest: int, cuts: int, barred: frozenset = frozenset()) -> list[tuple[str, bool, float]]:
    """The conditions of one rule, each that of most information gain; the first is none of the ``barred`` (feature, at
    least) starts."""
    here, conditions = np.ones(len(bad), bool), []
    while len(conditions) < longest:
        p, n = int(bad[here].sum()), int((~bad[here]).sum())
        if not n or not p:
            break
        best, best_gain = None, 1e-9
        for name, values in x.items():
            order = np.argsort(values[here], kind="stable")
            v, b = values[here][order], bad[here][order]
            from_here = np.cumsum(b[::-1])[::-1]
            all_from = np.arange(len(v), 0, -1)
            edges = np.flatnonzero(v[1:] > v[:-1]) + 1
            if len(edges) > cuts:
                edges = edges[np.linspace(0, len(edges) - 1, cuts).astype(int)]
            base = math.log2(p / (p + n))
            for at_least in True, False:
                if not conditions and (name, at_least) in barred:
                    continue
                pos = from_here[edges] if at_least else p - from_here[edges]
                total = all_from[edges] if at_least else len(v) - all_from[edges]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pos > 0, pos * (np.log2(pos / np.maximum(total, 1)) - base), -1)
                if len(gain) and gain.max() > best_gain:
                    k = int(gain.argmax())
                    best_gain, best = float(gain[k]), (name, at_least, float((v[edges[k]] + v[edges[k] - 1]) / 2))
        if best is None:
            break
        conditions.append(best)
        name, at_least, threshold = best
        here &= x[name] >= threshold if at_least else x[name] <= threshold
    return conditions


def learn(x: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.95, longest: int = 4, most_rules: int = 12, cuts: int = 256) -> list[Rule]:
    """Sequential covering. A rule is kept if, after pruning, at least ``precision`` of what it covers in the pruning
    third is bad (Laplace-corrected) and at least 3 rows are. After one that isn't the next rule starts with another
    feature or direction; learning ends when no start is left."""
    third = np.arange(len(bad)) % 3 == 2
    left, rules, barred = np.ones(len(bad), bool), [], set()
    while len(rules) < most_rules and bad[left].sum() >= 6:
        grow, prune = left & ~third, left & third
        part = lambda mask: {k: v[mask] for k, v in x.items()}
        conditions = _grow(part(grow), bad[grow], longest, cuts, frozenset(barred))
        if not conditions:
            break

        def worth(cs: list) -> tuple[float, int]:
            hit = Rule(tuple(cs)).covers(part(prune))
            p, n = int(bad[prune][hit].sum()), int((~bad[prune])[hit].sum())
            return ((p + 1) / (p + n + 2), p)

        best = max((conditions[:k] for k in range(1, len(conditions) + 1)), key=lambda cs: (round(worth(cs)[0], 3), -len(cs)))
        share, hits = worth(best)
        if hits < 3 or share < min(precision, 1 - 1 / (hits + 2)):
            barred.add(conditions[0][:2])
            continue
        rule = Rule(tuple(best))
        rules.append(rule)
        left &= ~rule.covers(x)
        barred.clear()
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: false for the first rule that covers the row, else true."""
    out = None
    for rule in rules:
        out = F.when(rule.column(), F.lit(False)) if out is None else out.when(rule.column(), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(stats: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> list[Rule]:
    """Learn from at most about ``sample`` labelled documents, drawn by a hash of the id, that don't fail the base. Only
    their statistics come to the driver. Labels that are null, or have no document, are left out; without labels there are no rules."""
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, sample / max(1, total)) * (1 << 20))
    columns = features()
    rows = (
        stats.where("not base_failed").join(known.where(draw), "doc_id")
        .select("doc_id", F.struct("quality", *(c.alias(n) for n, c in columns.items())).alias("row"))
        .groupBy("doc_id")
        .agg(F.min("row").alias("row"))  # of rows with equal ids always the same one
        .select("doc_id", "row.*")
        .toPandas()
    )
    if rows.empty:
        return []
    rows["place"] = [hash_place(i) for i in rows["doc_id"]]
    rows = rows.sort_values(["place", "doc_id"])
    return learn({n: rows[n].to_numpy(float) for n in columns}, (rows["quality"] == 0).to_numpy(), **options)


def hash_place(doc_id: int) -> int:
    import zlib

    return zlib.crc32(str(doc_id).encode())


def judge(docs: DataFrame, labels: DataFrame, least_words: int = 20, repeat_percent: int = 30, **options) -> DataFrame:
    """``doc_id``, the statistics, ``base_failed`` and ``kept`` of every document; one row per input row.

    Base: fewer than ``least_words`` words, or more than ``repeat_percent`` % of them in repeated runs. A null or
    empty text has no words and fails. Ids may be null or repeated; other columns are ignored."""
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    stats = checkpointed(text_statistics(docs)).withColumn("base_failed", failed)  # 100 bytes a document; the texts are read once
    rules = fit(stats, labels, **options)
    return stats.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
