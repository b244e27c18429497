"""Streaming intake: late and repeated arrivals, and a sink that may see a batch twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def once_within(stream: DataFrame, key: list[str], time: str, lateness: str = "3 days") -> DataFrame:
    """Each key once while its repeats come within ``lateness``; state older than that is dropped."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)


def daily_counts(stream: DataFrame, time: str, kind: str, lateness: str = "3 days") -> DataFrame:
    """Arrivals per day and kind; a day is given out when nothing for it is expected any more (append mode)."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, "1 day").alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").cast("date").alias("day"), kind, "n")


def idempotent_sink(stream: DataFrame, path: str, checkpoint: str, key: list[str]):
    """Starts a query that appends rows with unseen keys. A batch is written to a folder of its own number, so that one
    that is run again replaces itself; keys of earlier batches are looked up, later ones not."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(key)
        if number:
            seen = spark.read.option("basePath", path).schema(batch.schema.add("batch", "long")).parquet(path).where(F.col("batch") < number).select(*key)
            rows = rows.join(seen, key, "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
