"""Tables of the relational model, as schemas with their keys, and the rules their rows must keep."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.rules import Rule, parent_rule, row_rule, unique_rule


@dataclass(frozen=True)
class Table:
    layer: str
    columns: str
    key: tuple[str, ...]


TABLES: dict[str, Table] = {
    "distributor": Table("staging", "distributor_id string, name string, type string", ("distributor_id",)),
    "document": Table("raw", "document_id long, source string, source_doc_key string, document_type string, title string, received_date date, distributor_id string, previous_document_id long, is_correction boolean", ("source", "source_doc_key")),
    "raw_object": Table("raw", "raw_object_id long, document_id long, source string, source_object_key string, version_seq int, file_role string, format string, sha256 string, byte_size long, storage_path string, status string, collected_at timestamp", ("source", "source_object_key", "version_seq")),
    "pipeline_run": Table("raw", "run_id string, run_kind string, is_official boolean, status string, config_sha256 string, config_manifest string, upstream_run_id string, baseline_date date, started_at timestamp, completed_at timestamp", ("run_id",)),
    "collection_attempt": Table("raw", "run_id string, request_key string, attempt_no int, outcome string, http_status int, raw_object_id long, finished_at timestamp", ("run_id", "request_key", "attempt_no")),
    "file_extraction": Table("staging", "raw_object_id long, parser_version string, extract_status string, structure_status string, text_path string, text_sha256 string, text_length long, manifest_path string, manifest_sha256 string, error_reason string", ("raw_object_id", "parser_version")),
    "metric_definition": Table("mart", "metric_key string, metric_id string, version int, target string, direction string, status string", ("metric_key",)),
    "source_watermark": Table("raw", "source string, scope_key string, first_day date, watermark date, run_id string", ("source", "scope_key")),
    "section": Table("staging", "section_id long, raw_object_id long, parser_version string, section_seq int, section_kind string, part_seq int, source_section_no string, title string, char_start int, char_end int, section_text string, extract_status string", ("raw_object_id", "parser_version", "section_seq")),
    "fund_group": Table("staging", "fund_key string, name string, manager string, risk_grade int, risk_grade_source string", ("fund_key",)),
    "population_snapshot": Table("mart", "run_id string, metric_key string, population_key string, member_count long, scored_count long, missing_count long", ("run_id", "metric_key", "population_key")),
    "llm_field_extraction": Table("staging", "run_id string, document_id long, field_name string, attempt_no int, status string, value variant, evidence_section_id long, evidence_start int, evidence_end int, model string, cost decimal(38,18)", ("run_id", "document_id", "field_name", "attempt_no")),
    "product": Table("staging", "product_id string, short_code string, standard_code string, name string, fund_key string, is_etf boolean, etf_confidence string, valid_from date, valid_to date", ("product_id",)),
    "product_distributor": Table("staging", "product_id string, distributor_id string, snapshot_month string", ("product_id", "distributor_id", "snapshot_month")),
    "document_product": Table("staging", "document_id long, product_id string, match_method string, match_score decimal(38,18)", ("document_id", "product_id")),
    "score": Table("mart", "run_id string, target_key string, metric_key string, assessor_key string, document_id long, product_id string, fund_key string, status string, raw_score decimal(38,18), reason string", ("run_id", "target_key", "metric_key", "assessor_key")),
    "match_failure": Table("staging", "failure_id long, source string, source_key string, reason string, status string, detail string", ("failure_id",)),
}


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Creates what does not exist yet, as Parquet tables named by layer and table; returns the names."""
    names = []
    for name, table in TABLES.items():
        full = f"{database + '.' if database else ''}{table.layer}_{name}"
        columns = table.columns.replace(" variant", " string")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING parquet")
        names.append(full)
    return names


def table_rules() -> list[Rule]:
    """Keys, parents and row conditions of all tables."""
    c = F.col
    both = lambda a, b: c(a).isNull() != c(b).isNull()
    targets = sum((c(x).isNotNull().cast("int") for x in ("document_id", "product_id", "fund_key")), F.lit(0))
    return [
        *(unique_rule(f"key_{name}", name, table.key) for name, table in TABLES.items()),
        parent_rule("parent_raw_object", "raw_object", "document_id", "document", "document_id"),
        parent_rule("parent_extraction", "file_extraction", "raw_object_id", "raw_object", "raw_object_id"),
        parent_rule("parent_section", "section", "raw_object_id", "raw_object", "raw_object_id"),
        parent_rule("parent_document_distributor", "document", "distributor_id", "distributor", "distributor_id"),
        row_rule("version_from_1", "versions start at 1", "raw_object", c("version_seq") < 1),
        row_rule("sha_format", "digests are 64 lowercase hex digits", "raw_object", ~c("sha256").rlike("^[0-9a-f]{64}$")),
        row_rule("ok_has_text", "an OK extraction has its text", "file_extraction", (c("extract_status") == "EXTRACT_OK") & (c("text_path").isNull() | c("text_sha256").isNull())),
        row_rule("parser_format", "parser versions", "file_extraction", ~c("parser_version").rlike("^[a-z0-9._-]+$")),
        row_rule("manifest_pair", "manifest path and digest come together", "file_extraction", both("manifest_path", "manifest_sha256")),
        row_rule("section_range", "0 <= start < end", "section", (c("char_start") < 0) | (c("char_start") >= c("char_end")) | both("char_start", "char_end")),
        row_rule("missing_section", "a section not found has no range and no text", "section", (c("extract_status") == "SECTION_BOUNDARY_NOT_FOUND") & (c("char_start").isNotNull() | c("section_text").isNotNull())),
        row_rule("section_length", "the text is as long as its range", "section", F.length("section_text") != c("char_end") - c("char_start")),
        row_rule("upstream_score", "only SCORE runs have an upstream run", "pipeline_run", (c("run_kind") == "SCORE") != c("upstream_run_id").isNotNull()),
        row_rule("official_score", "official runs are succeeded SCORE runs", "pipeline_run", c("is_official") & ~((c("run_kind") == "SCORE") & (c("status") == "SUCCEEDED"))),
        Rule("one_official", "one official run at most", lambda t: t["pipeline_run"].where("is_official").agg(F.count("*").alias("n")).where("n > 1")),
        row_rule("grade", "risk grades are 1 to 6 and have a source", "fund_group", ~c("risk_grade").between(1, 6) | (c("risk_grade").isNotNull() & c("risk_grade_source").isNull())),
        row_rule("month_format", "months are YYYYMM", "product_distributor", ~c("snapshot_month").rlike("^[0-9]{4}(0[1-9]|1[0-2])$")),
        row_rule("etf_flag", "the flag follows the confidence", "product", ~c("is_etf").eqNullSafe(F.when(c("etf_confidence") == "KRX_CONFIRMED", True).when(c("etf_confidence") == "NOT_ETF", False))),
        row_rule("validity", "periods are not reversed", "product", c("valid_to") < c("valid_from")),
        row_rule("one_target", "a score has one target", "score", targets != 1),
        row_rule("score_value", "a score is OK if and only if it has a value", "score", (c("status") == "OK") != c("raw_score").isNotNull()),
        row_rule("counts", "counts are not negative and add up", "population_snapshot", (c("member_count") < 0) | (c("scored_count") + c("missing_count") != c("member_count"))),
        row_rule("evidence_range", "evidence ranges", "llm_field_extraction", both("evidence_start", "evidence_end") | (c("evidence_start") >= c("evidence_end"))),
        row_rule("ok_value", "an OK field has a value", "llm_field_extraction", (c("status") == "OK") & c("value").isNull()),
    ]
