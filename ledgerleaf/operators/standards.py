"""Documents against the standard they are drafted by, the keys and envelopes of their scores, and sections that several
sources hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import json_value, without_spaces

CONTRACT_VERSION = 3  # fixed value


def standard_difference(required: Column, found: Column) -> Column:
    """``struct(status, found, required, missing_items, order_differs_items)`` of the items that an edition requires, in its
    order, and those of a document, in the document's; both without repeats. An item's order differs if another one
    stands at its place among those that both have."""
    held = F.filter(required, lambda i: F.array_contains(found, i))
    own = F.filter(found, lambda i: F.array_contains(required, i))
    moved = F.filter(held, lambda i: F.array_position(held, i) != F.array_position(own, i))
    missing = F.array_except(required, found)
    status = F.when((F.size(missing) == 0) & (F.size(moved) == 0), "MET").otherwise("UNMET")
    return F.struct(status.alias("status"), F.size(held).alias("found"), F.size(required).alias("required"), missing.alias("missing_items"), moved.alias("order_differs_items"))


def position_check(found: Column, item: str, place: int) -> Column:
    """Whether an item stands at its place (from 1) in the document; UNDETERMINED if the document's items are unknown."""
    return F.when(found.isNull(), "UNDETERMINED").when(F.array_position(found, item) == place, "MET").otherwise("UNMET")


def target_key(target_type: Column, anchor: Column, policy: Column) -> Column:
    """SHA-256 of the target as canonical JSON, its keys in order."""
    fields = {"anchor": anchor, "contract_version": F.lit(CONTRACT_VERSION), "selection_policy_version": policy, "target_type": target_type}
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *(F.concat(F.lit(f'"{k}":'), json_value(v)) for k, v in fields.items())), F.lit("}")), 256)


def result(status: Column, value: Column, reason: Column) -> Column:
    return F.struct(status.alias("status"), value.alias("value"), reason.alias("reason"))


def dashboard_envelope(items: Column, axes: Column, metric_key: Column, weights: Column, score: Column, normal: Column, fixes: Column, prospectus: Column, short: Column) -> Column:
    """A document's scores as one nested JSON text; missing values are written as null."""
    readability = F.struct(axes.alias("axes"), metric_key.alias("metric_key"), weights.alias("weights_version"), score.alias("result"), normal.alias("normalization"), fixes.alias("fix_locations"))
    checks = F.struct(prospectus.alias("prospectus"), short.alias("summary_prospectus"))
    whole = F.struct(F.struct(items.alias("items")).alias("part_a_disclosure"), readability.alias("part_b_readability"), checks.alias("drafting_standard_check"))
    return F.to_json(whole, {"ignoreNullFields": "false"})


def shared_sections(sections: DataFrame, source: str, text: str) -> DataFrame:
    """``source, sections, shared, rate``: sections of each source that another source holds too, white space aside. Digests
    meet, not texts; a digest's sections are counted by source before they do."""
    counted = sections.where(F.col(text).isNotNull()).groupBy(F.sha2(without_spaces(F.col(text)), 256).alias("_d"), source).agg(F.count("*").alias("n"))
    several = counted.groupBy("_d").agg((F.count("*") > 1).alias("_both"))
    joined = counted.join(several, "_d").groupBy(source).agg(F.sum("n").alias("sections"), F.sum(F.when(F.col("_both"), F.col("n")).otherwise(0)).alias("shared"))
    return joined.withColumn("rate", F.col("shared") / F.col("sections"))
