"""Collecting from web services over a transport that the caller gives. A transport is made once in each partition by a
function without arguments and is called with an endpoint and parameters; it returns a status and the bytes of the body,
or raises ``OSError`` (a time-out is one). Requests are rows: partitions decide how many run at once, and a lost
executor repeats its partition's requests only."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import OUTCOMES, http_class

Send = Callable[[str, dict[str, str]], tuple[int, bytes]]
Transport = Callable[[], Send]

# Fixed values.
RETRIES = 5
MOST_ROWS, MOST_BYTES = 1000, 1 << 23  # of replies sent to Spark at once
SECRETS = ("crtfc_key", "serviceKey")
#: What the status within a list reply means; any other is PERMANENT_FAILED.
LIST_STATUS = {
    "000": "SUCCESS", "013": "EMPTY", "014": "PERMANENT_FAILED", "010": "CONFIG_ERROR", "011": "CONFIG_ERROR", "012": "CONFIG_ERROR",
    "901": "CONFIG_ERROR", "020": "RATE_LIMITED", "800": "RETRYABLE_FAILED", "900": "RETRYABLE_FAILED",
}

TRIES = "array<struct<attempt_no:int, http_status:int, outcome:string, error_reason:string>>"
_TRY = pa.struct([("attempt_no", pa.int32()), ("http_status", pa.int32()), ("outcome", pa.string()), ("error_reason", pa.string())])


def redacted(params: Column) -> Column:
    """Parameters without those that hold keys."""
    return F.map_filter(params, lambda k, _: ~k.isin(*SECRETS))


class Caller:
    """One request at a time, ``interval`` seconds apart; failures of the outcomes ``again`` are tried up to ``retries``
    times more, after ``backoff`` seconds, twice that, and so on."""

    def __init__(self, send: Send, retries: int = RETRIES, backoff: float = 1.0, interval: float = 1.0, again: tuple[str, ...] = ("RETRYABLE_FAILED",)) -> None:
        self.send, self.retries, self.backoff, self.interval, self.again = send, retries, backoff, interval, again
        self.free_at = 0.0

    def __call__(self, endpoint: str, params: dict[str, str]) -> tuple[bytes | None, list[dict]]:
        tries: list[dict] = []
        while True:
            if (wait := self.free_at - time.monotonic()) > 0:
                time.sleep(wait)
            try:
                status, body = self.send(endpoint, params)
                result, reason = http_class(status), None if status == 200 else f"HTTP {status}"
            except OSError as e:
                status, body, result, reason = None, None, "RETRYABLE_FAILED", type(e).__name__
            self.free_at = time.monotonic() + self.interval
            tries.append({"attempt_no": len(tries) + 1, "http_status": status, "outcome": result, "error_reason": reason})
            if result not in self.again or len(tries) > self.retries:
                return body if result == "SUCCESS" else None, tries
            time.sleep(self.backoff * 2 ** (len(tries) - 1))


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches, closed at ``MOST_ROWS`` or when their ``size`` comes to ``MOST_BYTES``."""
    held, taken = [], 0
    for row in rows:
        held.append(row)
        taken += size(row)
        if len(held) >= MOST_ROWS or taken >= MOST_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, taken = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def fetched(requests: DataFrame, transport: Transport, secret: str | None = None, **caller) -> DataFrame:
    """``request_key, content, outcome, tries`` of requests (``request_key, endpoint, params`` map). A failed request has no
    content. ``secret`` is blotted out wherever a body holds it, so that no stored reply carries a token."""
    schema = pa.schema([("request_key", pa.string()), ("content", pa.binary()), ("outcome", pa.string()), ("tries", pa.list_(_TRY))])

    def replies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        call = Caller(transport(), **caller)
        for batch in batches:
            for key, endpoint, params in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body, tries = call(endpoint, dict(params or {}))
                if secret and body:
                    body = body.replace(secret.encode(), b"***")
                yield key, body, tries[-1]["outcome"], tries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(replies(batches), schema, lambda row: len(row[1] or b""))

    rows = requests.select(F.col("request_key").cast("string"), "endpoint", F.col("params").cast("map<string,string>"))
    return rows.mapInArrow(run, f"request_key string, content binary, outcome string, tries {TRIES}")


def listed_days(days: DataFrame, transport: Transport, endpoint: str, params: dict[str, str], day_params: tuple[str, ...], **caller) -> DataFrame:
    """Pages of a list by day: ``day, page, source_result_code, outcome, items`` (JSON texts), ``tries``. Pages are asked for
    until the reply's ``total_page``; a day without rows is one EMPTY page, any other status ends the day with that
    outcome, and its earlier pages stay."""
    schema = pa.schema([("day", pa.string()), ("page", pa.int32()), ("source_result_code", pa.string()), ("outcome", pa.string()), ("items", pa.list_(pa.string())), ("tries", pa.list_(_TRY))])

    def pages(call: Caller, day: str) -> Iterator[tuple]:
        page, last = 1, 1
        while page <= last:
            body, tries = call(endpoint, params | dict.fromkeys(day_params, day) | {"page_no": str(page)})
            if body is None:
                yield day, page, None, tries[-1]["outcome"], [], tries
                return
            reply = json.loads(body or b"{}")
            code = str(reply.get("status", ""))
            result = LIST_STATUS.get(code, "PERMANENT_FAILED")
            rows = reply.get("list", []) if result == "SUCCESS" else []
            yield day, page, code, result, [json.dumps(r, ensure_ascii=False) for r in rows], tries
            if result != "SUCCESS":
                return
            page, last = page + 1, int(reply.get("total_page", 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = Caller(transport(), **caller)
        days_of = (day for batch in batches for day in batch.column(0).to_pylist())
        return _batched((row for day in days_of for row in pages(call, day)), schema, lambda row: sum(map(len, row[4])))

    return days.select(F.col("day").cast("string")).mapInArrow(run, f"day string, page int, source_result_code string, outcome string, items array<string>, tries {TRIES}")


def day_outcomes(pages: DataFrame) -> DataFrame:
    """``day, outcome, rows``: a day succeeds if its last page did or had no rows."""
    last = F.max_by("outcome", "page")
    return pages.groupBy("day").agg(F.when(last == "EMPTY", "SUCCESS").otherwise(last).alias("outcome"), F.sum(F.size("items")).alias("rows"))


def attempt_rows(fetches: DataFrame, bring: tuple[str, ...], final_outcome: Column, final_error: Column) -> DataFrame:
    """The run log: a row for each try with the columns ``bring``. What the content says (null: nothing) goes to the last try
    only, in place of the transport's outcome and reason."""
    rows = fetches.select(*bring, final_outcome.alias("_outcome"), final_error.alias("_error"), F.size("tries").alias("_n"), F.explode("tries").alias("t"))
    last = F.col("t.attempt_no") == F.col("_n")
    pick = lambda said, own: F.coalesce(F.when(last, F.col(said)), F.col(f"t.{own}")).alias(own)
    return rows.select(*bring, "t.attempt_no", "t.http_status", pick("_outcome", "outcome"), pick("_error", "error_reason"), last.alias("is_last"))


def outcome_counts(attempts: DataFrame) -> DataFrame:
    """Final outcomes of requests, every known outcome with a row."""
    known = attempts.sparkSession.createDataFrame([(o,) for o in OUTCOMES], "outcome string")
    return known.join(attempts.where("is_last").groupBy("outcome").agg(F.count("*").alias("n")), "outcome", "left").fillna(0, ["n"])


def body_problem(role: Column, content: Column, nodes: Column) -> Column:
    """What makes a fetched body unfit for its role; null if nothing does. ``nodes``: how many nodes its tree has."""
    begins = lambda *heads: F.coalesce(F.substring(F.hex(content), 1, 8).isin(*heads), F.lit(False))
    return (
        F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, "EMPTY_BODY")
        .when((role == "cover_xml") & ~begins("504B0304"), "NOT_A_ZIP")
        .when((role == "body_pdf") & ~(begins("25504446") & (F.substring(F.hex(content), 9, 2) == "2D")), "NOT_A_PDF")
        .when((role == "viewer_tree") & (F.coalesce(nodes, F.lit(0)) == 0), "NO_NODES")
    )


def stored_once(attachments: DataFrame, name: str, content: str) -> DataFrame:
    """One row per file name with the SHA-256 and size of its content, however many notices list it; of unlike contents the
    one with the least digest."""
    at = F.struct(F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("long").alias("size"))
    return attachments.groupBy(name).agg(F.min(at).alias("f"), F.count("*").alias("listed")).select(name, "f.*", "listed")


def daily_items(reply: Column, schema: str) -> Column:
    """The rows of a daily list, JSON under ``OutBlock_1``; a reply with an error code is an error."""
    code = F.get_json_object(reply, "$.respCode")
    rows = F.from_json(F.coalesce(F.get_json_object(reply, "$.OutBlock_1"), F.lit("[]")), f"array<{schema}>")
    return F.when(code.isNotNull(), F.raise_error(F.concat(F.lit("daily list: "), code)).cast(f"array<{schema}>")).otherwise(rows)


def pages_left(total: Column, page: Column, per_page: int) -> Column:
    """Page numbers that follow ``page`` until ``total`` rows are covered."""
    last = F.ceil(total / F.lit(per_page)).cast("int")
    return F.when(last > page, F.sequence(page.cast("int") + 1, last)).otherwise(F.array().cast("array<int>"))
