"""Operators on half-open ranges [start, end) within a group (a document, a page): union, overlap, containment,
subtraction. Joins bin the ranges, so that they are equi-joins and never compare all with all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_ranges(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Merges ranges that overlap or touch: a new one begins where the start is beyond all ends before it."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col(start) <= reach, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def _bins(start: Column, last: Column, size: int) -> Column:
    return F.explode(F.sequence(F.floor(start / size), F.floor(last / size)))


def points_in_ranges(points: DataFrame, ranges: DataFrame, keys: Sequence[str], at: str, start: str = "start", end: str = "end", bin_size: int = 1000, how: str = "inner") -> DataFrame:
    """Points with the ranges that hold them. A point has one bin, a range all that it touches; so no pair comes twice.
    ``how`` may also be left_semi or left_anti."""
    p = points.withColumn("_bin", F.floor(F.col(at) / bin_size))
    r = ranges.where(F.col(end) > F.col(start)).withColumn("_bin", _bins(F.col(start), F.col(end) - 1, bin_size))
    r = r.select(*(F.col(c).alias(f"_r_{c}") if c in (*keys, "_bin") else F.col(c) for c in r.columns))
    on = F.lit(True)
    for k in (*keys, "_bin"):
        on = on & (p[k] == r[f"_r_{k}"])
    joined = p.join(r, on & (p[at] >= r[start]) & (p[at] < r[end]), how)
    return joined.drop("_bin", *(f"_r_{k}" for k in (*keys, "_bin")))


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], bin_size: int = 1000, how: str = "inner") -> DataFrame:
    """Pairs of ranges (``start, end`` and ``r_start, r_end``) of equal keys that share a place. A pair is reported in
    the bin of the place where the overlap begins, once."""
    lf = left.where(F.col("end") > F.col("start")).withColumn("_bin", _bins(F.col("start"), F.col("end") - 1, bin_size))
    rt = right.where(F.col("r_end") > F.col("r_start")).withColumn("_bin", _bins(F.col("r_start"), F.col("r_end") - 1, bin_size))
    rt = rt.select(*(F.col(c).alias(f"_r_{c}") if c in (*keys, "_bin") else F.col(c) for c in rt.columns))
    on = (F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))
    for k in (*keys, "_bin"):
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    if how == "inner":
        on = on & (F.col("_bin") == F.floor(F.greatest("start", "r_start") / bin_size))
    out = lf.join(rt, on, how)
    if how != "inner":
        out = out.drop("_bin").dropDuplicates()
    return out.drop("_bin", *(f"_r_{k}" for k in (*keys, "_bin")))


def subtract_ranges(whole: DataFrame, holes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is left of ``whole`` (one ``start, end`` per key) without ``holes`` (``start, end``): the gaps between the
    merged holes, clipped."""
    merged = union_ranges(holes.select(*keys, "start", "end"), keys).select(*keys, F.col("start").alias("h_start"), F.col("end").alias("h_end"))
    both = whole.join(merged, list(keys), "left").where(F.col("h_start").isNull() | (F.col("h_start") < F.col("end")) & (F.col("h_end") > F.col("start")))
    cuts = both.groupBy(*keys, "start", "end").agg(F.array_sort(F.collect_list(F.struct("h_start", "h_end"))).alias("h"))
    cuts = whole.join(cuts, [*keys, "start", "end"], "left").withColumn("h", F.filter(F.coalesce("h", F.array()), lambda x: x["h_start"].isNotNull()))
    starts = F.concat(F.array("start"), F.transform("h", lambda x: x["h_end"]))
    ends = F.concat(F.transform("h", lambda x: x["h_start"]), F.array("end"))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.struct(F.greatest(x["a"], F.col("start")).alias("a"), F.least(x["b"], F.col("end")).alias("b")))
    return cuts.select(*keys, F.explode(F.filter(pieces, lambda x: x["a"] < x["b"])).alias("p")).select(*keys, F.col("p.a").alias("start"), F.col("p.b").alias("end"))


def range_violations(df: DataFrame, keys: Sequence[str], seq: str = "seq", start: str = "start", end: str = "end", length: str = "length") -> DataFrame:
    """Rows whose number does not follow on, whose range is half given, out of bounds or overlaps one before it."""
    w = Window.partitionBy(*keys).orderBy(seq)
    before = F.coalesce(F.max(F.col(end)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    given = F.col(start).isNotNull() & F.col(end).isNotNull()
    bad = ~((F.col(start) >= 0) & (F.col(start) < F.col(end)) & (F.col(end) <= F.col(length)))
    problem = F.array_compact(
        F.array(
            F.when(F.col(seq) != F.row_number().over(w), "SEQUENCE"),
            F.when(F.col(start).isNull() != F.col(end).isNull(), "HALF_RANGE"),
            F.when(given & bad, "OUT_OF_BOUNDS"),
            F.when(given & ~bad & (F.col(start) < before), "OVERLAP"),
        )
    )
    return df.withColumn("problems", problem).where(F.size("problems") > 0)
