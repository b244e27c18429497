"""Loading raw objects and extractions into the relational tables: what is joined, skipped or refused, and full scans that
compare what was loaded with what is stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import newest, surrogate_ids


def joined_or_error(left: DataFrame, right: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """Every left row with its right row; a row without one is an error when it is read. Right keys are unique."""
    marked = left.join(right.withColumn("_there", F.lit(True)), list(on), "left")
    key = F.concat_ws(",", *(F.col(k).cast("string") for k in on))
    there = F.when(F.col("_there"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"no {what} for "), key)).cast("boolean"))
    return marked.withColumn("_there", there).where("_there").drop("_there")


def loadable(bodies: DataFrame, attempts: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(bodies with their extraction attempt, ``on, reason`` of the others): a body that was never extracted is skipped."""
    marked = bodies.join(attempts.withColumn("_there", F.lit(True)), list(on), "left")
    skipped = marked.where("_there is null").select(*on, F.lit("NO_EXTRACTION").alias("reason"))
    return marked.where("_there").drop("_there"), skipped


def with_parent_ids(children: DataFrame, parents: DataFrame, natural_key: Sequence[str], alias: str) -> DataFrame:
    """Children with the surrogate id of their parent, which is numbered anew from its natural key on each load."""
    return children.join(surrogate_ids(parents.select(*natural_key).distinct(), natural_key, alias), list(natural_key))


def foreign_rows(tables: dict[str, DataFrame], source: str) -> DataFrame:
    """``table, n``: rows that another source than ``source`` owns, of tables that have any. Truncating these must be refused."""
    out = None
    for name, df in tables.items():
        found = df.where(~F.col("source").eqNullSafe(F.lit(source))).agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        out = found if out is None else out.unionByName(found)
    return out.where("n > 0")


def refuse_foreign(tables: dict[str, DataFrame], source: str) -> None:
    """Raises an error if a table that is to be truncated holds rows of another source; one row per table is looked at."""
    found = foreign_rows(tables, source).collect()
    if found:
        raise ValueError("rows of other sources: " + ", ".join(f"{r['table']} {r['n']}" for r in found))


def changed_contents(rows: DataFrame, files: DataFrame, key: str, digest: str, size: str) -> DataFrame:
    """``key, problem`` of rows whose stored file (``key, content``) is missing or has another size or SHA-256."""
    read = files.select(key, F.sha2("content", 256).alias("_sha"), F.octet_length("content").alias("_size"))
    problem = F.when(F.col("_sha").isNull(), "MISSING").when(F.col("_size") != F.col(size), "SIZE").when(F.col("_sha") != F.col(digest), "DIGEST")
    return rows.join(read, key, "left").select(key, problem.alias("problem")).where("problem is not null")


def changed_slices(sections: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Sections whose text is not that of their range in the document's text (``key, text``)."""
    slice_ = F.substring(F.col("text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start"))
    return sections.where("char_start is not null").join(texts.select(key, "text"), key, "left").where(~F.col("section_text").eqNullSafe(slice_)).drop("text")


def missing_values(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, column``: given columns that a row lacks, blank ones included."""
    lacking: list[Column] = [F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in columns]
    return df.select(key, F.explode(F.array_compact(F.array(*lacking))).alias("column"))


def unclaimed_hits(hits: DataFrame, claimed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Hits that no claim accounts for."""
    return hits.join(claimed.select(*on).distinct(), list(on), "left_anti")


def picked_run(runs: DataFrame, parser: str) -> DataFrame:
    """``run_id`` of the last whole run (no limit, SUCCEEDED) of a parser version; an error when read if there is none. Ids begin
    with the time."""
    last = runs.where((F.col("parser_version") == parser) & F.col("limit").isNull() & (F.col("status") == "SUCCEEDED")).agg(F.max("run_id").alias("run_id"))
    return last.select(F.coalesce("run_id", F.raise_error(F.lit(f"no whole run of {parser}")).cast("string")).alias("run_id"))


def last_lines(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The last line of each key in a file of JSON lines. Lines stand in the order of the file's splits, then of the scan."""
    lines = spark.read.text(path).select(F.from_json("value", schema).alias("v"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_id"))
    rows = lines.select("v.*", "_at", "_id")
    return newest(rows, [key], [F.col("_at"), F.col("_id")]).drop("_at", "_id")


def count_differences(loaded: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """``table, loaded, expected`` of tables whose row counts differ; ``expected``: ``table, expected``, as counted on disk."""
    counts = None
    for name, df in loaded.items():
        one = df.agg(F.count("*").alias("loaded")).select(F.lit(name).alias("table"), "loaded")
        counts = one if counts is None else counts.unionByName(one)
    return counts.join(expected, "table", "full").where(~F.col("loaded").eqNullSafe(F.col("expected"))).select("table", "loaded", "expected")


def unwanted_manifests(runs: DataFrame) -> DataFrame:
    """EXTRACT runs that name a selection manifest, which only other kinds of runs may have."""
    return runs.where((F.col("run_kind") == "EXTRACT") & (F.col("selection_manifest_path").isNotNull() | F.col("selection_manifest_sha256").isNotNull()))
