"""From a model's reply to a stored field: the shape of its value, the step at which a reply fails, sentences as the source
has them, and phrases that another field already claims. Rows are replies; all but the shape check is expressions."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import without_spaces
from .intervals import overlapping

Check = Callable[[object, str], list[str]]
MOST_PHRASES = 5  # fixed value


def one(what: str, test: Callable[[object], bool]) -> Check:
    return lambda x, at: [] if test(x) else [f"{at} is not {what}"]


def record(**fields: Check) -> Check:
    """An object with exactly these keys."""

    def check(x: object, at: str) -> list[str]:
        if not isinstance(x, dict) or x.keys() != fields.keys():
            return [f"{at} has not the keys {', '.join(sorted(fields))}"]
        return [e for name, f in fields.items() for e in f(x[name], f"{at}.{name}")]

    return check


def many(item: Check, least: int = 0, most: int | None = None) -> Check:
    def check(x: object, at: str) -> list[str]:
        if not isinstance(x, list) or len(x) < least or most is not None and len(x) > most:
            return [f"{at} is not a list of {least} to {'any' if most is None else most}"]
        return [e for k, v in enumerate(x) for e in item(v, f"{at}[{k}]")]

    return check


def maybe(check: Check) -> Check:
    return lambda x, at: [] if x is None else check(x, at)


TEXT = one("a string", lambda x: isinstance(x, str))
FULL_TEXT = one("a non-empty string", lambda x: isinstance(x, str) and x != "")
NUMBER = one("a number", lambda x: isinstance(x, (int, float)) and not isinstance(x, bool))
AMOUNT = maybe(record(amount=NUMBER, unit=FULL_TEXT))
LOAD = maybe(record(rate=AMOUNT, basis=maybe(TEXT), condition=maybe(TEXT), text=maybe(TEXT)))
FEE_CLASS = record(class_name=maybe(TEXT), front_load=LOAD, back_load=LOAD, total_fee=AMOUNT, peer_total_fee=AMOUNT)
TIER = record(period=TEXT, basis=maybe(TEXT), rate=AMOUNT, applies_to=maybe(many(TEXT, least=1)))
#: Shape of each field's value, and how much evidence it needs for that value (None: any).
SHAPES: dict[str, tuple[Check, Callable[[object], int] | None]] = {
    "fee_structure": (record(classes=many(FEE_CLASS, least=1)), None),
    "redemption_terms": (record(tiers=many(TIER)), None),
    "key_risk_phrases": (many(TEXT, 1, MOST_PHRASES), len),
    "principal_loss_notice": (FULL_TEXT, lambda _: 1),
}


def value_problems(field: str, value: object, evidence: int) -> list[str]:
    """What is wrong with the value of a found field, none if it has its field's shape and evidence."""
    if field not in SHAPES:
        return [f"unknown field {field}"]
    check, needed = SHAPES[field]
    wrong = check(value, "value")
    if not wrong and needed and needed(value) != evidence:
        wrong = [f"{evidence} pieces of evidence for {needed(value)}"]
    return wrong


@F.pandas_udf(ArrayType(StringType()))
def value_errors(field: pd.Series, value: pd.Series, evidence: pd.Series) -> pd.Series:
    """``value_problems`` of values given as JSON; a value that is no JSON is one problem."""

    def errors(f: str, v: str | None, n: int) -> list[str]:
        try:
            return value_problems(f, None if v is None else json.loads(v), n)
        except ValueError:
            return ["value is no JSON"]

    return pd.Series([errors(f, v, int(n or 0)) for f, v, n in zip(field, value, evidence, strict=True)], dtype=object)


def outcome(call_error: Column, is_object: Column, errors: Column, status: Column, located: Column, missing: Column, sections: Column) -> Column:
    """``struct(status, reason)``: the first step at which a reply fails, else what it says. A field counts as not in the
    document only if every source section was there to look in; found evidence must be located."""
    pair = lambda s, r: F.struct(F.lit(s).alias("status"), F.lit(r).cast("string").alias("reason"))
    return (
        F.when(call_error.isNotNull(), pair("FAILED", "CALL_FAILED"))
        .when(~is_object, pair("FAILED", "PARSE_FAILED"))
        .when(F.size(errors) > 0, pair("FAILED", "SCHEMA_INVALID"))
        .when((status == "FOUND") & ~F.coalesce(located, F.lit(False)), pair("FAILED", "EVIDENCE_NOT_LOCATED"))
        .when(status == "FOUND", pair("FOUND", None))
        .when((status == "NOT_FOUND") & ((F.size(missing) > 0) | (sections == 0)), pair("UNDETERMINED", "SOURCE_SECTION_MISSING"))
        .when(status == "NOT_FOUND", pair("NOT_FOUND", "NOT_IN_DOCUMENT"))
        .when(status == "UNDETERMINED", pair("UNDETERMINED", "AMBIGUOUS"))
        .otherwise(F.struct(status.alias("status"), F.lit("OUT_OF_SCOPE").alias("reason")))
    )


def source_value(value: Column, quote: Column, source: Column) -> Column:
    """A sentence as the reply has it if the source does too, white space aside, else the quoted stretch of the source."""
    return F.when(F.contains(without_spaces(source), without_spaces(value)), value).otherwise(quote)


def unclaimed(phrases: DataFrame, claims: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(phrases that share no character with a claim, ``document_id, status`` of documents that lose all of theirs). Both
    sides: ``keys`` (document_id among them), start, end; phrases also ``lost``: whether an earlier step lost some of the
    document's, which forbids to call it NOT_FOUND."""
    other = claims.select(*keys, F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    kept = overlapping(phrases, other, keys, how="left_anti")
    emptied = phrases.groupBy("document_id").agg(F.bool_or("lost").alias("lost")).join(kept.select("document_id").distinct(), "document_id", "left_anti")
    return kept, emptied.select("document_id", F.when(F.col("lost"), "FAILED").otherwise("NOT_FOUND").alias("status"))
