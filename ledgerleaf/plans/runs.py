"""Whole runs: texts to sections and attempts, tables with ids, and the rules' report; also from the command line.

    python -m ledgerleaf.plans.runs extract TEXTS OUT [--limit N] [--parser-version V]
    python -m ledgerleaf.plans.runs check TABLES
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import extract_status, quality_flags, structure_status
from ..operators.aggregates import reason_histogram, run_verdict, status_summary
from ..operators.intervals import range_violations
from ..operators.rules import report
from ..operators.sections import FOUND, sections_of
from ..operators.storage import surrogate_ids, unseen
from .schemas import TABLES, table_rules

PARSER = "text-1.0_prep-1"


def extract(texts: DataFrame, parser: str = PARSER, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sections, attempts) of texts (``raw_object_id, text``). With ``done`` (earlier attempts), texts that this parser
    version has been through are left out. A text that can't be split has an attempt and no sections."""
    if done is not None:
        texts = unseen(texts, done.where(F.col("parser_version") == parser), ["raw_object_id"])
    split = texts.withColumn("found", sections_of(F.col("text")))
    rows = split.select("raw_object_id", F.length("text").alias("length"), "text", F.explode("found").alias("s")).select("raw_object_id", "length", "text", "s.*")
    sections = rows.select(
        "raw_object_id", F.lit(parser).alias("parser_version"), F.col("seq").alias("section_seq"), F.col("kind").alias("section_kind"), F.col("part").alias("part_seq"),
        F.col("number").alias("source_section_no"), "title", F.col("start").alias("char_start"), F.col("end").alias("char_end"),
        F.when(F.col("start").isNotNull(), F.substring("text", F.col("start") + 1, F.col("end") - F.col("start"))).alias("section_text"), F.col("status").alias("extract_status"),
    )
    broken = range_violations(rows, ["raw_object_id"]).groupBy("raw_object_id").agg(F.count("*").alias("violations"))
    status = extract_status(F.lit(False), F.col("text").isNotNull(), F.lit(None), F.col("text"), F.coalesce("violations", F.lit(0)))
    attempts = split.join(broken, "raw_object_id", "left").select(
        "raw_object_id", F.lit(parser).alias("parser_version"), status.alias("extract_status"), structure_status(F.col("found").isNotNull(), F.lit("OK")).alias("structure_status"),
        F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("long").alias("text_length"), quality_flags(F.col("text")).alias("quality_flags"),
        F.when(F.col("found").isNull(), F.lit("NO_PARTS: no part headings")).alias("error_reason"),
    )
    return surrogate_ids(sections, ["raw_object_id", "parser_version", "section_seq"], "section_id"), attempts


def summary(sections: DataFrame, attempts: DataFrame) -> DataFrame:
    """One row: attempts by status, sections found, and the run's verdict."""
    found = sections.agg(F.count("*").alias("sections"), F.count_if(F.col("extract_status") == FOUND).alias("sections_found"))
    totals = status_summary(attempts, "extract_status", "text_length", ("EXTRACT_OK", "EXTRACT_FAILED", "OCR_REQUIRED"))
    return totals.crossJoin(found).withColumn("verdict", run_verdict(F.col("n") - F.col("n_extract_ok"), F.col("n")))  # one row each


def check(tables: dict[str, DataFrame]) -> DataFrame:
    """The report of all rules over the given tables; those that are missing count as empty."""
    spark = next(iter(tables.values())).sparkSession
    return report(table_rules(), {n: tables.get(n, spark.createDataFrame([], t.columns)) for n, t in TABLES.items()})


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("extract")
    one.add_argument("texts"), one.add_argument("out"), one.add_argument("--limit", type=int), one.add_argument("--parser-version", default=PARSER)
    commands.add_parser("check").add_argument("tables")
    got = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if got.command == "extract":
        texts = spark.read.parquet(got.texts)
        sections, attempts = extract(texts.orderBy("raw_object_id").limit(got.limit) if got.limit else texts, got.parser_version)
        sections.write.mode("errorifexists").parquet(f"{got.out}/section")
        attempts.write.mode("errorifexists").parquet(f"{got.out}/file_extraction")
        written = [spark.read.parquet(f"{got.out}/{t}") for t in ("section", "file_extraction")]
        summary(*written).show(vertical=True, truncate=False)
        reason_histogram(written[1], "error_reason").show(truncate=False)
        return 0
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(got.tables)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = {s.getPath().getName() for s in listed} & TABLES.keys()
    result = check({n: spark.read.parquet(f"{got.tables}/{n}") for n in sorted(names)}).collect()
    for r in result:
        print("ok  " if r.ok else "FAIL", r.rule, r.description, r.violations)
    return int(not all(r.ok for r in result))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
