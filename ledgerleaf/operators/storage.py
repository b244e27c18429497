"""Immutable versions, incremental runs and loading: each step computes new rows from old ones, none updates in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def assign_versions(arrivals: DataFrame, key: Sequence[str], order: Sequence[str], digest: str, latest: DataFrame | None = None) -> DataFrame:
    """``version, reused`` of ordered arrivals: content equal to the newest version of its key is that version again, other
    content the next. ``latest`` (key, digest, version) continues earlier batches."""
    if latest is not None:
        known = latest.select(*key, F.col(digest).alias("_known"), F.col("version").alias("_base"))
        arrivals = arrivals.join(known, list(key), "left")
    else:
        arrivals = arrivals.withColumn("_known", F.lit(None).cast("string")).withColumn("_base", F.lit(0))
    w = Window.partitionBy(*key).orderBy(*order)
    before = F.coalesce(F.lag(digest).over(w), F.col("_known"))
    marked = arrivals.withColumn("reused", F.col(digest).eqNullSafe(before))
    number = F.coalesce("_base", F.lit(0)) + F.sum(F.when(F.col("reused"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("version", number.cast("int")).drop("_known", "_base")


def newest(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row of each key: a maximum, so formed before the shuffle; no sort of a key's rows."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*(o.alias(f"o{k}") for k, o in enumerate(order)))).alias("_r")).select(*key, "_r.*")


def last_usable(attempts: DataFrame, key: Sequence[str], status: str, number: str, failed: str = "FAILED") -> DataFrame:
    """Per key the last attempt that did not fail, else the last."""
    return newest(attempts, key, [F.col(status) != failed, F.col(number)])


def surrogate_ids(df: DataFrame, natural_key: Sequence[str], alias: str) -> DataFrame:
    """Numbers rows 1, 2, ... in the order of their natural key, the same on each load. Keys are cut into ranges by
    their hash's leading digits, counted, and numbered within: no task sorts all rows. Order is that of the hash."""
    hashed = df.withColumn("_h", F.md5(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in natural_key))))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, 2))
    before = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1))  # 256 rows
    starts = hashed.groupBy(F.col("_b").alias("b")).agg(F.count("*").alias("n")).select("b", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *natural_key))
    return hashed.withColumn(alias, within).join(starts, F.col("_b") == F.col("b")).withColumn(alias, (F.col(alias) + F.col("_before")).cast("long")).drop("_h", "_b", "b", "_before")


def complete_until(days: DataFrame, source: str, day: str, complete: str) -> DataFrame:
    """Completeness watermark per source: the last day of the unbroken row of complete days from the first on."""
    w = Window.partitionBy(source).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    gap = F.datediff(day, F.coalesce(F.lag(day).over(Window.partitionBy(source).orderBy(day)), F.date_sub(day, 1))) != 1
    ok = days.withColumn("_gap", gap).withColumn("_ok", F.min(F.col(complete) & ~F.col("_gap")).over(w))
    return ok.groupBy(source).agg(F.min(day).alias("first_day"), F.max(F.when(F.col("_ok"), F.col(day))).alias("watermark"))


def restart_day(watermark: Column, first_day: Column, lookback: int = 3) -> Column:
    """Where a run starts again: some days before the watermark, but not before the first day. Null without a watermark."""
    return F.when(watermark.isNotNull(), F.greatest(F.date_sub(watermark, lookback), F.coalesce(first_day, F.date_sub(watermark, lookback))))


def advanced(old: Column, new: Column) -> Column:
    """A watermark never goes back."""
    return F.greatest(old, new)


def unseen(batch: DataFrame, seen: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of a batch whose key the state table lacks; rows of one key within the batch come once."""
    return batch.dropDuplicates(list(key)).join(seen.select(*key), list(key), "left_anti")


def within_budget(calls: DataFrame, scope: Sequence[str], order: Sequence[str], cost: str, budget: float) -> DataFrame:
    """Which calls, in order, a budget admits; after the first that does not fit, none does."""
    w = Window.partitionBy(*scope).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return calls.withColumn("spent", F.sum(cost).over(w)).withColumn("admitted", F.col("spent") <= budget)


def reachable_tables(spark: SparkSession, edges: DataFrame, start: Sequence[str]) -> DataFrame:
    """Tables that truncating ``start`` reaches over foreign keys (``child, parent``), themselves included. The catalog is
    small; each round adds what the last one reached."""
    found = spark.createDataFrame([(s,) for s in start], "name string")
    count = len(set(start))
    while True:
        more = edges.join(found, edges["parent"] == found["name"], "left_semi").select(F.col("child").alias("name"))
        found = found.union(more).distinct()
        now = found.count()
        if now == count:
            return found
        count = now


def snapshot_leavers(days: DataFrame, day: str, key: str, complete: str) -> DataFrame:
    """Keys that stand in one complete day's snapshot and not in the next complete day's."""
    good = days.where(F.col(complete)).select(day, key).distinct()
    order = good.select(day).distinct()
    following = order.withColumn("_next", F.lead(day).over(Window.orderBy(day)))  # one row per day
    now = good.join(following, day).where(F.col("_next").isNotNull())
    later = good.select(F.col(day).alias("_d"), F.col(key).alias("_k"))
    return now.join(later, (F.col("_next") == F.col("_d")) & (F.col(key) == F.col("_k")), "left_anti").select(F.col("_next").alias("gone_on"), key)


def late_arrivals(found: DataFrame, marks: DataFrame, source: str, day: str) -> DataFrame:
    """``source, late``: new rows on days that the watermark (``source, watermark``) had already passed, every source with a row."""
    behind = found.join(marks.select(source, "watermark"), source).where(F.col(day) <= F.col("watermark"))
    return marks.select(source).join(behind.groupBy(source).agg(F.count("*").alias("late")), source, "left").fillna(0, ["late"])


def newest_run(runs: DataFrame, products: DataFrame) -> DataFrame:
    """The run that began last of those that wrote any of ``products`` (``created_run_id``); of two at once the greater id."""
    wrote = runs.join(products, runs["run_id"] == products["created_run_id"], "left_semi")
    return wrote.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1)
