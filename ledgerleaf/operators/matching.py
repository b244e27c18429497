"""Products, legal entities and documents: normal names, hard rules, states and exclusions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import without_spaces
from ..functions.unicode import nfkc

# Fixed values.
LEGAL_FORM = r"\(주\)|\(유\)|주식회사|유한회사"
BRANCH = r"(?<=은행|증권|보험|금고|조합|금융|투자)\S{1,10}(?:지점|본점|영업점)$"
NUMBER_OF_SERIES = r"제?(\d+)호"
CLASS = r"(?:Class|종류)?\s*\(?([A-Z](?:-?[a-z0-9]){0,3})\)?(?:형|클래스)?$"


def product_name(df: DataFrame, name: str) -> DataFrame:
    """``base, series, share_class, kind``: compatibility forms, white space and legal forms go, in this order; then the
    bracketed kind, the number of the series and the class become columns of their own."""
    out = df.withColumn("_n", F.regexp_replace(without_spaces(nfkc(name)), LEGAL_FORM, ""))
    out = out.withColumn("kind", F.nullif(F.regexp_extract("_n", r"\[([^\]]*)\]", 1), F.lit(""))).withColumn("_n", F.regexp_replace("_n", r"\[[^\]]*\]", ""))
    out = out.withColumn("share_class", F.nullif(F.regexp_extract("_n", CLASS, 1), F.lit(""))).withColumn("_n", F.regexp_replace("_n", CLASS, ""))
    out = out.withColumn("series", F.nullif(F.regexp_extract("_n", NUMBER_OF_SERIES, 1), F.lit(""))).withColumn("_n", F.regexp_replace("_n", NUMBER_OF_SERIES, ""))
    return out.withColumnRenamed("_n", "base")


def entity_name(df: DataFrame, name: str, former: DataFrame | None = None) -> DataFrame:
    """``entity``: compatibility forms, then former names by their current ones (``former, current``: both brought to the
    same form first), then legal forms, white space and branches go. Trades (bank, securities) stay: they tell firms apart."""
    simple = lambda c: F.regexp_replace(without_spaces(F.regexp_replace(c, LEGAL_FORM, "")), BRANCH, "")
    out = df.withColumn("entity", simple(nfkc(name)))
    if former is None:
        return out
    known = former.select(simple(nfkc("former")).alias("_former"), simple(nfkc("current")).alias("_current")).groupBy("_former").agg(F.min("_current").alias("_current"))
    return out.join(known, F.col("entity") == F.col("_former"), "left").withColumn("entity", F.coalesce("_current", "entity")).drop("_former", "_current")


def etf_confidence(confirmed: Column, denied: Column, name: Column) -> Column:
    """KRX_CONFIRMED, NOT_ETF (only on evidence; no match is none), NAME_ONLY or PENDING."""
    return F.when(confirmed, "KRX_CONFIRMED").when(denied, "NOT_ETF").when(F.contains(name, F.lit("상장지수")), "NAME_ONLY").otherwise("PENDING")


def is_etf(confidence: Column) -> Column:
    """True, false, or null while unconfirmed."""
    return F.when(confidence == "KRX_CONFIRMED", True).when(confidence == "NOT_ETF", False)


def sale_status(day: Column, start: Column, end: Column, seen: Column) -> Column:
    """State on a day: begins included, ends excluded. An unknown end is no evidence of a sale; being seen that day is."""
    return (
        F.when(seen, "CONFIRMED_ACTIVE").when((end <= day) | (start > day), "CONFIRMED_INACTIVE")
        .when((start <= day) & (day < end), "CONFIRMED_ACTIVE").otherwise("UNKNOWN")
    )


def held_matches(found: DataFrame, earlier: DataFrame, key: str, target: str) -> DataFrame:
    """New matches beside earlier ones (``key, target, by``): what a person confirmed stays; a target that another key
    holds, or that several keys now want, is held back."""
    confirmed = earlier.where("by = 'person'").select(key, F.col(target).alias("_kept"))
    claimed = earlier.select(F.col(target).alias("_t"), F.col(key).alias("_holder")).groupBy("_t").agg(F.min("_holder").alias("_holder"))
    wanted = found.groupBy(target).agg(F.count_distinct(key).alias("_n"))
    out = found.join(wanted, target, "left").join(claimed, F.col(target) == F.col("_t"), "left").join(confirmed, key, "left")
    taken = F.col("_holder").isNotNull() & (F.col("_holder") != F.col(key))
    status = F.when(F.col("_kept").isNotNull(), "CONFIRMED").when(taken | (F.col("_n") > 1), "HELD").otherwise("MATCHED")
    return out.withColumn("status", status).withColumn(target, F.coalesce("_kept", F.when(status == "MATCHED", F.col(target)))).select(key, target, "status")


def collapsed_notices(notices: DataFrame, ad_hoc: Column, file_key: Sequence[str], share_class: str) -> DataFrame:
    """Rows of an ad-hoc notice that name one file become one with all classes; periodic notices stay as they are."""
    rest = [c for c in notices.columns if c not in (*file_key, share_class)]
    one = notices.where(ad_hoc).groupBy(*file_key).agg(*(F.min(c).alias(c) for c in rest), F.array_sort(F.collect_set(share_class)).alias("classes"))
    same = notices.where(~F.coalesce(ad_hoc, F.lit(False))).withColumn("classes", F.array(share_class)).drop(share_class)
    return one.unionByName(same)


def exclusions(df: DataFrame, key: str, reasons: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, ``key, reason`` of the others): the first reason that holds counts."""
    reason = reduce(lambda acc, r: F.when(r[1], F.lit(r[0])).otherwise(acc), reversed(list(reasons)), F.lit(None).cast("string"))
    marked = df.withColumn("_reason", reason)
    return marked.where("_reason is null").drop("_reason"), marked.where("_reason is not null").select(key, F.col("_reason").alias("reason"))


def roles(documents: DataFrame, simple_range: Column, full_range: Column) -> DataFrame:
    """A document once per role that it plays, with that role's ``scope``: PROSPECTUS, and SIMPLE where it has a summary."""
    full = documents.withColumn("role", F.lit("PROSPECTUS")).withColumn("scope", full_range)
    return full.unionByName(documents.where(simple_range.isNotNull()).withColumn("role", F.lit("SIMPLE")).withColumn("scope", simple_range))


def checklist(df: DataFrame, key: str, items: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``key, item, verdict``: of (applies, met) columns, NOT_APPLICABLE, MET, UNMET or, if met is null, UNDETERMINED."""
    verdict = lambda applies, met: F.when(~applies, "NOT_APPLICABLE").when(met, "MET").when(~met, "UNMET").otherwise("UNDETERMINED")
    structs = [F.struct(F.lit(n).alias("item"), verdict(a, m).alias("verdict")) for n, (a, m) in items.items()]
    return df.select(key, F.explode(F.array(*structs)).alias("i")).select(key, "i.*")
