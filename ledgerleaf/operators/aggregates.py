"""Aggregations with fixed definitions: nearest-rank percentiles, null-safe ratios, checksums, strata and runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Null where the whole is 0 or null."""
    return F.try_divide(part, whole)


def nearest_rank(df: DataFrame, keys: Sequence[str], value: str, q: float, alias: str, ranges: int = 64) -> DataFrame:
    """Per group the value at place min(n - 1, floor(q n)) of the sorted values, counted from 0; nulls don't count.

    Equal values are one row with a count before anything is sorted. These are cut into about ``ranges`` ranges by approximate
    quantiles of the whole; counts of the ranges tell which holds a group's place, and only that range is sorted."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_times"))
    edges = df.agg(F.percentile_approx(value, [k / ranges for k in range(1, ranges)], 10 * ranges)).first()[0] or []
    placed = counted.withColumn("_range", _bucket_of(F.col(value), sorted(set(edges))))
    w = Window.partitionBy(*keys).orderBy("_range")
    sums = placed.groupBy(*keys, "_range").agg(F.sum("_times").alias("_in"))
    sums = sums.withColumn("_before", F.sum("_in").over(w) - F.col("_in")).withColumn("_n", F.sum("_in").over(Window.partitionBy(*keys)))
    wanted = sums.withColumn("_place", F.least(F.col("_n") - 1, F.floor(F.lit(q) * F.col("_n")))).where("_place >= _before and _place < _before + _in")
    wanted = wanted.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_range").alias("_wanted"), "_before", "_place")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_range") == F.col("_wanted")]
    inside = placed.join(wanted, reduce(and_, on))
    upto = F.sum("_times").over(Window.partitionBy(*keys).orderBy(value)) + F.col("_before")
    return inside.withColumn("_upto", upto).where("_upto > _place").groupBy(*keys).agg(F.min(value).alias(alias))


def _bucket_of(value: Column, edges: list) -> Column:
    """How many of the sorted edges are below the value: a tree of comparisons, of the logarithm of their number deep."""
    if not edges:
        return F.lit(0)

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(edges[middle]), tree(middle + 1, high)).otherwise(tree(low, middle))

    return tree(0, len(edges))


def status_summary(df: DataFrame, status: str, value: str, wanted: Sequence[str]) -> DataFrame:
    """One row: counts by status in one pass, share of OK, and minimum, median and sum of ``value`` over the OK rows."""
    ok = F.col(status) == wanted[0]
    return df.agg(
        F.count("*").alias("n"), *(F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in wanted),
        ratio(F.count_if(ok), F.count("*")).alias("ok_share"), F.min(F.when(ok, F.col(value))).alias("least"),
        F.median(F.when(ok, F.col(value))).alias("median"), F.sum(F.when(ok, F.col(value))).alias("total"),
    )


def reason_histogram(df: DataFrame, reason: str) -> DataFrame:
    """Counts by what stands before the first colon of a reason, 60 characters of it at most."""
    return df.where(F.col(reason).isNotNull()).groupBy(F.left(F.substring_index(reason, ":", 1), F.lit(60)).alias("reason")).count()


def table_checksum(df: DataFrame) -> DataFrame:
    """One row ``n, checksum``: equal for equal multisets of rows, whatever their layout. Each row's SHA-256 is cut in four
    numbers of 60 bits, which are added up: sums, unlike sorted lists, are formed before the shuffle and take one row."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring("h", 15 * k + 1, 15), 16, 10).cast("decimal(38,0)"))
    sums = df.select(row.alias("h")).agg(F.count("*").alias("n"), *(F.coalesce(part(k), F.lit(0)).cast("string").alias(f"s{k}") for k in range(4)))
    return sums.select("n", F.sha2(F.concat_ws("|", "n", "s0", "s1", "s2", "s3"), 256).alias("checksum"))


def group_sizes(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: number of groups, largest and mean size."""
    return df.groupBy(*key).agg(F.count("*").alias("size")).agg(F.count("*").alias("groups"), F.max("size").alias("largest"), F.avg("size").alias("mean_size"))


def consecutive_groups(df: DataFrame, keys: Sequence[str], order: str, same: Sequence[str], collect: str) -> DataFrame:
    """Neighbours (by ``order``) with equal ``same`` columns as one group each: its number, size and collected values."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = F.lit(False)
    for c in same:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    marked = df.withColumn("_new", F.when(changed | (F.row_number().over(w) == 1), 1).otherwise(0))
    marked = marked.withColumn("group_no", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "group_no", *same).agg(
        F.count("*").alias("size"), F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.col(collect).alias("_m")))), lambda x: x["_m"]).alias("members")
    )


def joined_text(df: DataFrame, keys: Sequence[str], order: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Per group the texts in order, joined, and the SHA-256 of that."""
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), separator)
    return df.groupBy(*keys).agg(parts.alias("joined")).withColumn("sha256", F.sha2("joined", 256))


def run_verdict(failed: Column, total: Column, most: float = 0.2) -> Column:
    """FAILED without results, if all failed, or if more than ``most`` did."""
    return F.when((total == 0) | (failed == total) | (ratio(failed, total) > most), "FAILED").otherwise("SUCCEEDED")


def strata(df: DataFrame, keys: Sequence[str], unit: str, least: int = 30) -> DataFrame:
    """Populations: distinct units per stratum, and whether there are enough for a percentile."""
    return df.groupBy(*keys).agg(F.count_distinct(unit).alias("units")).withColumn("usable", F.col("units") >= least)


def weighted(scores: Sequence[Column], weights: Sequence[float]) -> Column:
    """Weighted sum, null as soon as one score is."""
    out = F.lit(0.0)
    for s, w in zip(scores, weights, strict=True):
        out = out + s * F.lit(w)
    return out


def combined_status(status: str) -> Column:
    """Aggregate: the status of a whole from its parts', in this order; no parts is not OK."""
    s = F.col(status)
    return (
        F.when(F.count(s) == 0, "NO_PARTS").when(F.bool_and(s == "OK"), "OK").when(F.bool_and(s == "FAILED"), "FAILED")
        .when(F.bool_or(s == "FAILED"), "PARTIAL").otherwise("PENDING")
    )


def joint_counts(df: DataFrame, *columns: Column) -> DataFrame:
    """``key, n``: counts by the columns' values joined by colons; nulls as a dash."""
    return df.groupBy(F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit("-")) for c in columns)).alias("key")).agg(F.count("*").alias("n"))


def first_of_each(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key: a minimum, formed before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")
