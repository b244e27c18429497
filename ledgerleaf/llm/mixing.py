"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Each source queues its documents in a shuffled order, once for each time they may be taken. A document's
virtual finish time is the number of its source's words up to and including it, divided by the source's
target. All queues are merged by finish time and cut where the next document would pass the total budget, so
every source has been served to nearly the same fraction of its target.

Running sums are kept in two levels, so that no task holds a source: the shuffled order is cut into ranges of
the hash, whose sums are few, and each range is summed by itself. The merged order is cut in the same way by
finish time: only the range in which the budget ends is sorted row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, n_words, read

WEIGHTS = (5, 2, 1)
#: Ranges of one finish-time unit; finish times of 4 and more share the last range's scale (see ``_slot``).
SLOTS = 1024


def _order_hash(id_col: str) -> Column:
    """The shuffled order: a hash of the id alone, so that reruns and any layout of the input agree."""
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight, target`` of each source from ``source, size`` rows.

    Sources in code-point order, null last, get ``weights`` in turn. The budget is ``share`` times all words;
    a target stops at ``cap`` times its source's words and the excess is shared again by weight until no target
    is above its cap. That is a level L with target = min(cap, L * weight), found from running sums over the
    sources by cap per weight. One row per source goes through one task here, never one per document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per_source.select(
        "source", "source_size", weight.cast("long").alias("weight"), F.sum("source_size").over(Window.partitionBy(F.lit(0))).alias("_all")
    ).withColumn("ratio", F.lit(cap) * F.col("source_size") / F.col("weight"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.col("_all") - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(
        by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    # The level is the one that the first source not stopped by its cap sees; sources before it are stopped.
    first = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", F.col("source").isNull().alias("no_source"), "source", "level")))
    found = ranked.withColumn("level", level).withColumn("level", first.over(Window.partitionBy(F.lit(0)))["level"])
    stopped = F.lit(cap) * F.col("source_size")
    return found.select(
        "source", "source_size", "weight",
        F.when(F.col("level").isNull() | (F.col("ratio") <= F.col("level")), stopped).otherwise(F.col("level") * F.col("weight")).cast("double").alias("target"),
    )


def _slot(finish: Column) -> Column:
    """The range of a finish time; ranges widen from 4 on, so that there are some thousands at most."""
    return F.when(finish < 4, F.floor(finish * SLOTS)).otherwise(4 * SLOTS + F.floor(F.least(F.log2(finish), F.lit(64.0)) * 64)).cast("int")


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How often each document is taken: ``doc_id, size, source, source_size, target, times, taken``.

    One row per input row. ``size`` counts words (null text: 0); ``times`` is 0, 1 or 2 (``cap`` rounds of the
    source), ``taken`` is ``times * size``. Documents without words are never taken. Repeated ids stand next to
    each other in the queue, smaller ones first; equal rows are taken equally often as far as the cut allows
    (the cut goes between queue places). An empty table gives no rows. Other columns are ignored.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), _order_hash(id_col).alias("place")
    ).withColumn("bin", F.substring("place", 1, 3))
    sized = checkpointed(sized)  # the texts are read once; some 60 bytes a document go on
    targets = source_targets(sized.select("source", "size"), share, cap, weights)

    # Words of each source before each range of the shuffled order: at most 4,096 rows per source.
    by_source = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = sized.groupBy("source", "bin").agg(F.sum("size").alias("in_bin")).select(
        F.col("source").alias("s"), F.col("bin").alias("b"), F.coalesce(F.sum("in_bin").over(by_source), F.lit(0)).alias("before")
    )
    context = targets.join(starts, F.col("source").eqNullSafe(F.col("s"))).select("s", "b", "before", "source_size", "target")
    in_bin = Window.partitionBy("source", "bin").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = (
        sized.withColumn("upto", F.sum("size").over(in_bin))
        .withColumn("copy", F.row_number().over(in_bin))
        .join(context, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
        .withColumn("upto", F.col("upto") + F.col("before"))
    )
    return _served(checkpointed(queued), share, cap)


def _served(queued: DataFrame, share: float, cap: float) -> DataFrame:
    rounds = [k for k in range(int(-(-cap // 1)))]
    finish = [F.try_divide(F.col("upto") + k * F.col("source_size"), F.col("target")) for k in rounds]  # null for a source without words
    wanted = (F.col("size") > 0) & (F.col("target") > 0)
    entries = queued.where(wanted).select(
        "source", "bin", "place", "doc_id", "copy", "size", F.explode(F.array(*(F.struct(F.lit(k).alias("round"), f.alias("finish")) for k, f in zip(rounds, finish, strict=True)))).alias("e")
    ).select("source", "bin", "place", "doc_id", "copy", "size", "e.round", "e.finish").withColumn("slot", _slot(F.col("finish")))
    # Words before each range of finish times, and the budget: a few thousand rows whatever the input is.
    merged = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = entries.groupBy("slot").agg(F.sum("size").alias("in_slot")).select(
        "slot", "in_slot", F.coalesce(F.sum("in_slot").over(merged), F.lit(0)).alias("done")
    )
    budget = queued.agg((F.lit(share) * F.coalesce(F.sum("size"), F.lit(0))).alias("budget"))
    cut_slot = (
        slots.join(F.broadcast(budget), F.col("done") + F.col("in_slot") > F.col("budget"))  # one row: the total
        .agg(F.min_by(F.struct("slot", "done", "budget"), "slot").alias("cut"))
        .select(F.coalesce("cut.slot", F.lit(1 << 30)).alias("cut_slot"), "cut.done", "cut.budget")
    )
    order = Window.orderBy("finish", "round", F.col("source").asc_nulls_last(), "place", "doc_id", "copy").rowsBetween(Window.unboundedPreceding, 0)
    in_cut = (
        entries.join(F.broadcast(cut_slot), F.col("slot") == F.col("cut_slot"))  # one row
        .withColumn("sum", F.col("done") + F.sum("size").over(order))
    )
    # The first queue place that would pass the budget; everything before it is taken.
    last = in_cut.where(F.col("sum") > F.col("budget")).agg(
        F.min(F.struct("finish", "round", F.col("source").isNull().alias("no_source"), "source", "place", "doc_id", "copy")).alias("last")
    )
    cut = cut_slot.select("cut_slot").join(F.broadcast(last))
    served = queued.join(F.broadcast(cut))  # one row
    times = F.lit(0)
    for k, f in zip(rounds, finish, strict=True):
        here = F.struct(f.alias("finish"), F.lit(k).alias("round"), F.col("source").isNull().alias("no_source"), "source", "place", "doc_id", "copy")
        before_cut = F.when(_slot(f) != F.col("cut_slot"), _slot(f) < F.col("cut_slot")).otherwise(F.col("last").isNull() | (here < F.col("last")))
        times = times + F.when(wanted & before_cut, 1).otherwise(0)
    return served.withColumn("times", times.cast("int")).select(
        "doc_id", "size", "source", "source_size", "target", "times", (F.col("times") * F.col("size")).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    keep = docs.columns
    taken = mix(docs, **options).where("times > 0").groupBy(F.col("doc_id").alias("_mix_id"), F.col("size").alias("_mix_size"), F.col("source").alias("_mix_source")).agg(
        F.sort_array(F.collect_list("times"), False).alias("_mix_times")
    )
    key = [F.col("doc_id").eqNullSafe(F.col("_mix_id")), n_words(F.col("text")).eqNullSafe(F.col("_mix_size")), F.col("source").eqNullSafe(F.col("_mix_source"))]
    place = Window.partitionBy("doc_id", "source", "_mix_size").orderBy("text")
    joined = docs.join(taken, key[0] & key[1] & key[2]).withColumn("_mix_place", F.row_number().over(place))
    times = F.coalesce(F.get("_mix_times", F.col("_mix_place") - 1), F.lit(0))
    return joined.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), times))).select(*(F.col(f"`{c}`") for c in keep))


def op3_weighted_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight,
         (sum(source_size) OVER ())::BIGINT AS total FROM s
), r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS seen FROM r
), m AS (SELECT *, (SELECT seen FROM l WHERE ratio > seen ORDER BY ratio, source NULLS LAST LIMIT 1) AS level FROM l
), t AS (
  SELECT source, source_size, total,
         CASE WHEN level IS NULL OR ratio <= level THEN 2.0::DOUBLE * source_size ELSE level * weight END AS target FROM m
), q AS (
  SELECT d.*, t.source_size, t.target, t.total,
         row_number() OVER (PARTITION BY d.source, d.place ORDER BY d.doc_id, d.size) AS copy,
         (sum(size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size ROWS UNBOUNDED PRECEDING))::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT doc_id, source, place, copy, size, total, k, (upto + k * source_size)::DOUBLE / target AS finish
  FROM q, (VALUES (0), (1)) x(k) WHERE size > 0 AND target > 0
), c AS (
  SELECT *, sum(size) OVER (ORDER BY finish, k, source NULLS LAST, place, doc_id, copy ROWS UNBOUNDED PRECEDING) AS done FROM e
), n AS (
  SELECT doc_id, source, place, copy, count(*) AS times FROM c WHERE done <= 1.5::DOUBLE * total GROUP BY ALL
)
SELECT q.doc_id, q.size, q.source_size, q.target, (coalesce(n.times, 0) * q.size)::BIGINT AS taken
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id AND q.source IS NOT DISTINCT FROM n.source
  AND q.place = n.place AND q.copy = n.copy
"""
