"""Handing out results: tables that are written once, and a manifest that names and digests them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import table_checksum


def released(spark: SparkSession, tables: dict[str, DataFrame], folder: str, run_id: str) -> DataFrame:
    """Writes each table (documents, excluded, scores) to a folder of its own that must not exist, then the manifest ``official``
    (``run_id, name, n, checksum``) as JSON, last: a release without it is not whole. Returns the manifest."""
    manifest = None
    for name, df in tables.items():
        path = f"{folder}/{name}.parquet"
        df.write.mode("errorifexists").parquet(path)
        one = table_checksum(spark.read.parquet(path)).select(F.lit(run_id).alias("run_id"), F.lit(name).alias("name"), "n", "checksum")
        manifest = one if manifest is None else manifest.unionByName(one)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{folder}/official.json")
    return spark.read.json(f"{folder}/official.json")


def installed(spark: SparkSession, assets: DataFrame, folder: str) -> DataFrame:
    """``name, sha256, path`` of assets (``name, text``), stored under their digest: one that is there already stays as it is, so
    that a run's prompts can't change behind its records."""
    named = assets.select("name", "text", F.sha2("text", 256).alias("sha256"))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    new = named.join(spark.read.parquet(folder).select("sha256"), "sha256", "left_anti") if there else named
    new.select("text", "sha256").dropDuplicates(["sha256"]).write.mode("append").partitionBy("sha256").parquet(folder)
    return named.select("name", "sha256", F.concat(F.lit(f"{folder}/sha256="), "sha256").alias("path"))
