"""Texts as lines and pages with code-point offsets, and what is found in them by windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.text import digit_mask, strip

PAGE_NUMBER = r"(?U)^[-\s]*\d+(\s*/\s*\d+)?[-\s]*$"
#: Bytes of text that are cut into lines at once; a longer text is cut alone.
SLICE_BYTES = 1 << 21


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SLICE_BYTES`` of column ``text``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // SLICE_BYTES)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def text_lines(df: DataFrame, key: str, text: str = "text", separator: str = "\n") -> DataFrame:
    """``key, no, start, end, line`` of every line (or page, with a form feed). Offsets are summed within the row, in Arrow
    batches: nothing is shuffled, and rows with equal keys are texts of their own. A null text has no lines."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in _slices(b, 1)):
            pieces = [t.split(separator) if t is not None else [] for t in batch.column(1).to_pylist()]
            counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
            lines = [x for p in pieces for x in p]
            sizes = np.fromiter(map(len, lines), np.int64, len(lines))
            first = np.repeat(np.cumsum(counts) - counts, counts)  # the text's first line among all
            upto = np.concatenate([[0], np.cumsum(sizes + len(separator))])
            starts = upto[:-1] - upto[first] if len(lines) else sizes
            rows = pa.array(np.repeat(np.arange(len(pieces)), counts))
            numbers = (np.arange(len(lines)) - first).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(numbers), pa.array(starts), pa.array(starts + sizes), pa.array(lines, pa.string())], names=[key, "no", "start", "end", "line"])

    schema = StructType([StructField(key, kind), StructField("no", IntegerType()), StructField("start", LongType()), StructField("end", LongType()), StructField("line", StringType())])
    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def ascending_runs(marks: DataFrame, keys: Sequence[str], order: str, number: str) -> DataFrame:
    """Numbers each maximal strictly ascending stretch of ``number``: column ``run``, from 1."""
    w = Window.partitionBy(*keys).orderBy(order)
    starts = F.when(F.col(number) > F.lag(number).over(w), 0).otherwise(1)
    return marks.withColumn("_new", starts).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def ascending_picks(marks: DataFrame, keys: Sequence[str], order: str, number: str) -> DataFrame:
    """The marks whose number exceeds every number before it."""
    before = F.max(number).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return marks.withColumn("_before", before).where(F.col("_before").isNull() | (F.col(number) > F.col("_before"))).drop("_before")


def until_next(marks: DataFrame, keys: Sequence[str], start: str, end: Column, alias: str = "end") -> DataFrame:
    """Each mark's range ends where the next begins, the last at ``end``."""
    return marks.withColumn(alias, F.coalesce(F.lead(start).over(Window.partitionBy(*keys).orderBy(start)), end))


def until_level(heads: DataFrame, keys: Sequence[str], order: str, level: str, end: Column, levels: int | None = None, alias: str = "end") -> DataFrame:
    """Each heading's range ends at the next of its own or a higher level (a smaller number from 1), else at ``end``.
    ``levels``: how many there are, by default the largest number in the data, which a small query finds."""
    if levels is None:
        levels = heads.agg(F.max(level)).first()[0] or 0
    after = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    found = F.lit(None).cast("long")
    for n in range(1, levels + 1):
        found = F.when(F.col(level) == n, F.min(F.when(F.col(level) <= n, F.col(order))).over(after)).otherwise(found)
    return heads.withColumn(alias, F.coalesce(found, end))


def page_furniture(df: DataFrame, key: str, text: str = "text", share: float = 0.3, least: int = 3) -> DataFrame:
    """``furniture`` of texts whose pages end with form feeds; keys are unique."""
    pages = text_lines(df, key, text, "\f").select(key, F.col("no").alias("page"), F.col("start").alias("page_start"), F.col("line").alias("page_text"))
    return furniture(pages, [key], share, least)


def furniture(pages: DataFrame, keys: Sequence[str], share: float = 0.3, least: int = 3) -> DataFrame:
    """``keys, start, end`` of the first and last non-blank lines of pages that, but for numbers, stand on 30 % of the pages
    of a book (``keys``) and 3 at least, and of last lines that are page numbers. ``pages``: keys, page, page_start and
    page_text; the key and page of a row are unique. The edges are found within the page's row; only they are shuffled."""
    lines = text_lines(pages.select(F.struct(*keys, "page", "page_start").alias("at"), "page_text"), "at", "page_text")
    lines = lines.where(strip(F.col("line")) != "").select(*(F.col(f"at.{k}") for k in keys), "at.page", (F.col("at.page_start") + F.col("start")).alias("start"), "no", "line")
    edge = F.struct("no", "start", "line")
    ends = lines.groupBy(*keys, "page").agg(F.min(edge).alias("a"), F.max(edge).alias("z"))
    both = F.array(F.struct("a.*", (F.col("a.no") == F.col("z.no")).alias("last")), F.struct("z.*", F.lit(True).alias("last")))
    edges = ends.select(*keys, "page", F.explode(F.array_distinct(both)).alias("e")).select(*keys, "page", "e.*").withColumn("mask", digit_mask(F.col("line")))
    totals = pages.groupBy(*keys).agg(F.count("*").alias("pages"))
    often = (
        edges.where("mask <> ''").groupBy(*keys, "mask").agg(F.countDistinct("page").alias("on")).join(totals, list(keys))
        .where(F.col("on") >= F.greatest(F.lit(least), F.col("pages") * share)).select(*keys, "mask", F.lit(True).alias("often"))
    )
    found = edges.join(often, [*keys, "mask"], "left").where(F.col("often") | F.col("last") & strip(F.col("line")).rlike(PAGE_NUMBER))
    end = F.col("start") + F.length(F.regexp_replace("line", r"(?U)\s+$", ""))
    return found.select(*keys, "start", end.alias("end")).distinct()
