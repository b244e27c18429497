"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import re
import tempfile
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(r"[^ \t-\r]+")


T = TypeVar("T")

#: Where rows without an id stand.
LAST = (1 << 63) - 1


def place_of(id_col: str, text_col: str) -> tuple[Column, Column]:
    """A row's place: its id (a missing one stands last), then a hash of its text, -1 for none. Rows with equal ids and
    unlike texts are therefore different documents; rows with equal ids and texts share a place."""
    th = F.conv(F.substring(F.md5(text_col), 1, 15), 16, 10).cast("long")
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), F.coalesce(th, F.lit(-1))


def placed(docs: DataFrame) -> DataFrame:
    """``doc, th, text`` by ``place_of``."""
    doc, th = place_of("doc_id", "text")
    return docs.select(doc.alias("doc"), th.alias("th"), "text")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the input tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``rows`` rows, and ``size`` bytes of text or binary but for a longer single row."""
    bytes_ = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
            bytes_ += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at, upto = 0, np.cumsum(bytes_)
    while at < batch.num_rows:
        before = upto[at - 1] if at else 0
        end = max(at + 1, min(at + rows, int(np.searchsorted(upto, before + size, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def map_lists(df: DataFrame, fn: Callable[..., list], schema: str, *columns: str, rows: int = 256, size: int = 8 << 20) -> DataFrame:
    """Map-only stage: ``fn`` gets the listed columns as Python lists, at most ``rows`` rows or ``size`` bytes at once (a
    longer text comes alone), and returns one list per field of ``schema``. Arrow carries the batches; nothing is
    shuffled."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows, size):
                out = fn(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.select(*(F.col(c) for c in columns)).mapInArrow(run, fields)


_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept by this worker process between tasks. Spark's workers outlive a stage, and their caches would
    add up over a pipeline; so a worker keeps one such object, and the next stage's takes the place of the last one's."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def n_words(text: Column) -> Column:
    """Words of a text, 0 for null, with a built-in function."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it. Where the setting is missing a folder is made only
    for a session whose executors are threads of this process, as in tests; a cluster without it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.gettempdir() + "/checkpoints"
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the cluster's shared folder."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Lets executors delete the shuffle files behind tables that have been checkpointed and are no longer held. Spark does so
    when the driver collects its own garbage, which an idle driver puts off while the files of every round pile up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
