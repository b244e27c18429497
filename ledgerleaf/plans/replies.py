"""Asking a model about the fields of documents: what is asked, which earlier replies serve again, how often a call is tried,
which attempt counts, and the checks of a finished run. Calls go through a client that the caller gives."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.conversion import value_errors
from ..operators.storage import last_usable, newest

# Fixed values.
FIELDS = ("principal_loss_notice", "key_risk_phrases", "fee_structure", "redemption_terms")
NOT_FOR_LISTED = "redemption_terms"
MOST_ATTEMPTS = 2
REUSABLE = ("OK", "UNDETERMINED", "NOT_APPLICABLE")
RECONVERTED = "EVIDENCE_NOT_LOCATED"
PRIOR_KEYS = ("document_id", "field_name", "input_sha256", "prompt_sha256", "model_name", "model_params")
REASONS = {
    "FOUND": (None,), "NOT_FOUND": ("NOT_IN_DOCUMENT",), "UNDETERMINED": ("AMBIGUOUS", "SOURCE_SECTION_MISSING"), "NOT_APPLICABLE": ("OUT_OF_SCOPE",),
    "FAILED": ("CALL_FAILED", "PARSE_FAILED", "SCHEMA_INVALID", "EVIDENCE_NOT_LOCATED"),
}

#: (reply or null, error or null) of a prompt and an input.
Converse = Callable[[str, str], tuple[str | None, str | None]]
#: (result status, reason) of a reply and an error.
Judge = Callable[[str | None, str | None], tuple[str, str | None]]


def usable(status: Column, text: Column, start: Column) -> Column:
    """Whether a section can be quoted: found, with text and place."""
    return F.coalesce(status == "OK", F.lit(False)) & text.isNotNull() & start.isNotNull()


def field_inputs(documents: DataFrame, listed: Column, fields: Sequence[str] = FIELDS) -> tuple[DataFrame, DataFrame]:
    """(a row per document and field, the excluded rows): listed funds are not asked for redemption terms."""
    rows = documents.withColumn("_listed", F.coalesce(listed, F.lit(False))).withColumn("field_name", F.explode(F.array(*map(F.lit, fields))))
    left_out = F.col("_listed") & (F.col("field_name") == NOT_FOR_LISTED)
    return rows.where(~left_out).drop("_listed"), rows.where(left_out).drop("_listed")


def section_inputs(sections: DataFrame, objects: DataFrame, document_ids: Sequence[int] | None, parser: str) -> DataFrame:
    """Sections of a parser version with the document that owns their raw object; ``document_ids`` None: of all documents."""
    owned = sections.where(F.col("parser_version") == parser).join(objects.select("raw_object_id", "document_id"), "raw_object_id")
    return owned if document_ids is None else owned.where(F.col("document_id").isin(list(document_ids)))


def mixed_sources(rows: DataFrame, key: str = "document_id", source: str = "raw_object_id") -> DataFrame:
    """Documents whose sections come from several raw objects, which is an error, with the objects' ids."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(source)).alias("sources")).where(F.size("sources") > 1)


def prior_replies(wanted: DataFrame, attempts: DataFrame, keys: Sequence[str] = PRIOR_KEYS) -> DataFrame:
    """Each wanted row with ``prior``: the newest stored reply to the same six keys that was of use, else the newest that failed
    only because its evidence was not located; null without one."""
    failed = F.col("result_status") == "FAILED"
    of_use = F.col("result_status").isin(*REUSABLE) | (failed & (F.col("error_reason") == RECONVERTED))
    brought = F.struct("extraction_id", "run_id", "result_status", "raw_response_path", "response_sha256").alias("prior")
    stored = attempts.where(F.col("raw_response_path").isNotNull() & of_use)
    return wanted.join(newest(stored.select(*keys, "extraction_id", brought), keys, [F.col("prior.result_status") != "FAILED", F.col("extraction_id")]).drop("extraction_id"), list(keys), "left")


def planned(wanted: DataFrame, files: DataFrame, sections: Column) -> DataFrame:
    """``plan`` of rows with ``prior``: NO_INPUT without sections; REUSE if the stored reply still has its digest; CALL, and
    ``prior_missing`` if there was a reply whose file is gone or changed. ``files``: ``raw_response_path, content``."""
    read = files.select(F.col("raw_response_path").alias("_path"), F.sha2("content", 256).alias("_sha"))
    found = wanted.join(read, F.col("prior.raw_response_path") == F.col("_path"), "left")
    same = F.coalesce(F.col("_sha") == F.col("prior.response_sha256"), F.lit(False))
    plan = F.when(sections == 0, "NO_INPUT").when(same, "REUSE").otherwise("CALL")
    return found.withColumn("plan", plan).withColumn("prior_missing", F.col("prior").isNotNull() & ~same & (sections > 0)).drop("_path", "_sha")


def asked(wanted: DataFrame, client: Callable[[], Converse], judge: Judge, most: int = MOST_ATTEMPTS) -> DataFrame:
    """``document_id, field_name, attempt_no, reply, result_status, error_reason``: each row (``document_id, field_name, prompt,
    input_text``) is asked until a reply does not fail, ``most`` times at most. One client per partition."""
    ddl = "document_id long, field_name string, attempt_no int, reply string, result_status string, error_reason string"
    schema = pa.schema([("document_id", pa.int64()), ("field_name", pa.string()), ("attempt_no", pa.int32()), ("reply", pa.string()), ("result_status", pa.string()), ("error_reason", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        converse = client()
        for batch in batches:
            out = []
            for document, field, prompt, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for n in range(1, most + 1):
                    reply, error = converse(prompt, text)
                    status, reason = judge(reply, error)
                    out.append((document, field, n, reply, status, reason))
                    if status != "FAILED":
                        break
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema, strict=True)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return wanted.select(F.col("document_id").cast("long"), "field_name", "prompt", "input_text").mapInArrow(run, ddl)


def selected(attempts: DataFrame, keys: Sequence[str] = ("run_id", "document_id", "field_name")) -> DataFrame:
    """Attempts with ``is_selected``: of each group the last that did not fail, else the last. New rows in place of updates."""
    one = last_usable(attempts.select(*keys, "attempt_no", "result_status"), keys, "result_status", "attempt_no").select(*keys, F.col("attempt_no").alias("_one"))
    return attempts.join(one, list(keys)).withColumn("is_selected", F.col("attempt_no") == F.col("_one")).drop("_one")


def envelope_problems(e: DataFrame) -> DataFrame:
    """Rows with ``problems``, the rules that a stored result breaks: columns ``status, contract_version, field_name, reason_code,
    value`` (JSON)``, raw_text, evidence`` (array of ``section_id, char_start, char_end, quote``) and ``checked_section_ids``."""
    status, evidence, checked = F.col("status"), F.col("evidence"), F.col("checked_section_ids")
    reason_fits = F.lit(False)
    for s, codes in REASONS.items():
        fits = [F.col("reason_code").eqNullSafe(F.lit(c)) for c in codes]
        reason_fits = reason_fits | ((status == s) & F.greatest(*fits, F.lit(False)))
    good = lambda x: x["section_id"].isNotNull() & (x["char_start"] >= 0) & (x["char_start"] < x["char_end"]) & x["quote"].isNotNull()
    has = F.coalesce((F.size(evidence) > 0) & F.forall(evidence, lambda x: F.coalesce(good(x), F.lit(False))), F.lit(False))
    found = status == "FOUND"
    n_checked, ids_given = F.coalesce(F.size(checked), F.lit(-1)), F.coalesce(F.forall(checked, lambda i: i.isNotNull()), F.lit(False))
    rules = [
        (~F.coalesce(F.col("contract_version") == 1, F.lit(False)), "CONTRACT_VERSION"),
        (F.col("field_name").isNull(), "FIELD_NAME"),
        (~F.coalesce(reason_fits, F.lit(False)), "REASON_CODE"),
        (found & ~has, "EVIDENCE"),
        (found & F.col("raw_text").isNull(), "RAW_TEXT"),
        (found & F.col("value").isNull(), "VALUE"),
        (~found & (F.col("value").isNotNull() | F.col("raw_text").isNotNull()), "VALUE_NOT_NULL"),
        (~found & ~F.coalesce(F.size(evidence) == 0, F.lit(False)), "EVIDENCE_NOT_EMPTY"),
        ((status == "NOT_FOUND") & ((n_checked <= 0) | ~ids_given), "CHECKED_SECTIONS"),
        ((status != "NOT_FOUND") & (n_checked != 0), "CHECKED_SECTIONS_NOT_EMPTY"),
    ]
    broken = F.array_compact(F.array(*(F.when(c, F.lit(name)) for c, name in rules)))
    wrong = F.when(found & F.col("value").isNotNull() & evidence.isNotNull(), value_errors("field_name", "value", F.size(evidence)))
    broken = F.concat(broken, F.coalesce(wrong, F.array().cast("array<string>")))
    known = F.coalesce(status.isin(*REASONS), F.lit(False))
    return e.withColumn("problems", F.when(known, broken).otherwise(F.array(F.lit("STATUS"))))


def run_problems(attempts: DataFrame, requests: DataFrame, files: DataFrame, objects: DataFrame) -> DataFrame:
    """``document_id, field_name, attempt_no, problem`` of a run's attempts: the request's input has another digest, the evidence
    columns are not those of the first evidence, a failure without reason, a reply whose file is gone or changed, an input
    from another document's object, or a field without exactly one selected attempt (attempt_no null).

    attempts: ``document_id, field_name, attempt_no, result_status, error_reason, input_sha256, raw_response_path,
    response_sha256, is_selected, evidence, evidence_section_id, evidence_char_start, evidence_char_end``; requests: the three
    keys, ``input_text, stated_sha256, raw_object_ids``; files: ``raw_response_path, content``; objects: ``raw_object_id, document_id``."""
    keys = ["document_id", "field_name", "attempt_no"]
    read = files.select("raw_response_path", F.sha2("content", 256).alias("_sha"))
    asked_ = requests.select(*keys, F.sha2("input_text", 256).alias("_input"), F.col("stated_sha256").alias("_stated"))
    rows = attempts.join(asked_, keys, "left").join(read, "raw_response_path", "left")
    first = F.try_element_at("evidence", F.lit(1))
    differs = lambda c: ~F.col(f"evidence_{c}").eqNullSafe(first[c])
    same_input = F.col("_input").eqNullSafe(F.col("input_sha256")) & F.col("_stated").eqNullSafe(F.col("input_sha256"))
    rules = [
        (~same_input, "INPUT_SHA256"),
        (differs("section_id") | differs("char_start") | differs("char_end"), "EVIDENCE_COLUMNS"),
        ((F.col("result_status") == "FAILED") & (F.coalesce("error_reason", F.lit("")) == ""), "NO_REASON"),
        (F.col("raw_response_path").isNotNull() & ~F.col("_sha").eqNullSafe(F.col("response_sha256")), "RESPONSE_SHA256"),
    ]
    own = rows.select(*keys, F.explode(F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in rules)))).alias("problem"))
    used = requests.select(*keys, F.explode("raw_object_ids").alias("raw_object_id"))
    owners = objects.select("raw_object_id", F.col("document_id").alias("_owner"))
    foreign = used.join(owners, "raw_object_id").where(~F.col("_owner").eqNullSafe(F.col("document_id"))).select(*keys, F.lit("FOREIGN_INPUT").alias("problem")).distinct()
    counts = attempts.groupBy("document_id", "field_name").agg(F.count_if("is_selected").alias("n")).where("n <> 1")
    unselected = counts.select("document_id", "field_name", F.lit(None).cast("int").alias("attempt_no"), F.lit("SELECTED").alias("problem"))
    return own.unionByName(foreign).unionByName(unselected)
