"""Listed products against fund names: variants of a name in order, a similarity ratio with a margin, the bounds of a naming
rule, and the log of what found no match."""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.text import without_spaces
from ..functions.unicode import comparable_name
from .joins import best_with_margin, containing

# Fixed values.
ALIASES = {"ACE": ["KINDEX"], "RISE": ["KBSTAR"], "PLUS": ["ARIRANG"], "KIWOOM": ["KOSEF"]}
TAILS = ("증권", "특별자산", "상장지수", "파생", "부동산", "채권", "주식", "혼합", "투자신탁", "재간접", "금리", "통화", "원자재")
LEAST_RATIO, MARGIN = 0.85, 0.05
LEGAL_TAIL = "증권상장|특별자산상장|부동산상장|상장지수|증권투자신탁"
RULE_LIMIT = 0.01
#: Into how many tasks the pairs of one brand are dealt.
SHARES = 16
#: When a failed match is tried again, and whether it counts in the failure rate.
RETRY = {
    "PENDING_MASTER": ("DAILY_FOR_30_DAYS", True),
    "AMBIGUOUS": ("BY_HAND", True),
    "NO_CANDIDATE": ("WEEKLY", True),
    "NO_CODE_IN_SOURCE": ("NEVER", True),
    "BELOW_THRESHOLD": ("NEVER", True),
    "NORMALIZE_FAILED": ("WITH_EXTRACTION", True),
    "CLASS_GRADE_MISMATCH": ("NEVER", True),
    "OUT_OF_SCOPE_SECTOR": ("NEVER", False),
    "NOT_IN_MASTER": ("WITH_MASTER", False),
}


def name_variants(df: DataFrame, name: str, aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """``at, variant`` rows of each name, brackets left out: as it stands, then under its brand's other names, then each of
    these that ends in TR with that written out; in comparable form, the order in ``at``."""
    base = F.trim(F.regexp_replace(name, r"\([^)]*\)", ""))
    brand = F.substring_index("_base", " ", 1)
    others = F.create_map(*(x for b, names in aliases.items() for x in (F.lit(b), F.array(*map(F.lit, names))))) if aliases else F.create_map(F.lit(""), F.array().cast("array<string>"))
    rest = F.substring(F.col("_base"), F.length(brand) + 1, F.length("_base"))
    names = F.concat(F.array("_base"), F.coalesce(F.transform(F.try_element_at(others, brand), lambda b: F.concat(b, rest)), F.array().cast("array<string>")))
    rows = df.withColumn("_base", base).select(*df.columns, F.posexplode(names).alias("at", "_v")).withColumn("variant", comparable_name("_v")).drop("_v")
    spelt = F.concat(F.expr("left(variant, length(variant) - 2)"), F.lit("TOTALRETURN"))
    most = max([len(v) for v in aliases.values()], default=0) + 1
    return rows.unionByName(rows.where(F.endswith("variant", F.lit("TR"))).withColumn("variant", spelt).withColumn("at", F.col("at") + most))


def rematched(listed: DataFrame, funds: DataFrame, aliases: dict[str, list[str]] = ALIASES, tails: Sequence[str] = TAILS) -> DataFrame:
    """``code, status, n, fund`` of every listed product (``code, name``): the funds (``fund, name``) whose name holds the first
    variant that any name holds, followed by nothing or a legal tail, and hedged alike. One is a match, more are AMBIGUOUS."""
    keys = name_variants(listed, "name", aliases).select("code", "at", "variant", F.contains("name", F.lit("H)")).alias("_hedged"))
    named = funds.select("fund", comparable_name("name").alias("_text"), (F.contains("name", F.lit("(H)")) | F.contains(without_spaces(F.col("name")), F.lit("(합성H)"))).alias("_fund_hedged"))
    tail = F.substring(F.col("_text"), F.instr(F.col("_text"), F.col("variant")) + F.length("variant"), F.length("_text"))
    legal = tail == ""
    for t in tails:
        legal = legal | tail.startswith(t)
    # Names are compared once however many products and funds bear them; a code's variants at one place are nearly always one.
    texts, variants = named.select("_text", "_fund_hedged").distinct(), keys.select("variant", "_hedged").distinct()
    hits = containing(texts, variants, "_text", "variant").where(legal & (F.col("_hedged") == F.col("_fund_hedged")))
    found = hits.join(named, ["_text", "_fund_hedged"]).select("variant", "_hedged", "fund")
    asked = keys.groupBy("code", "at").agg(F.array_sort(F.collect_set(F.struct("variant", "_hedged"))).alias("_asked"))
    sets = asked.select("_asked").distinct().select("_asked", F.inline("_asked"))
    counted = sets.join(found, ["variant", "_hedged"]).groupBy("_asked").agg(F.count_distinct("fund").alias("n"), F.min("fund").alias("fund"))
    first = asked.join(counted.hint("shuffle_hash"), "_asked").groupBy("code").agg(F.min_by(F.struct("n", "fund"), "at").alias("f"))
    n = F.coalesce("f.n", F.lit(0))
    status = F.when(n == 1, "MATCHED").when(n > 1, "AMBIGUOUS").otherwise("NO_CANDIDATE")
    return listed.select("code").join(first, "code", "left").select("code", status.alias("status"), n.cast("long").alias("n"), F.when(n == 1, F.col("f.fund")).alias("fund"))


@F.pandas_udf(DoubleType())
def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Twice the characters in common stretches over all characters; null if a side is missing."""
    return pd.Series([None if a is None or b is None else SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)], dtype="float64")


def core_name(name: Column) -> Column:
    """What tells a brand's products apart: the part before the legal tail, without plus signs."""
    head = F.get(F.split(name, LEGAL_TAIL), F.lit(0))
    return F.replace(F.replace(F.replace(head, F.lit("적격")), F.lit("플러스"), F.lit("+")), F.lit("+"))


def similar(listed: DataFrame, funds: DataFrame, brand: Sequence[str], least: float = LEAST_RATIO, margin: float = MARGIN) -> DataFrame:
    """``code, fund, score, second``: the most similar fund of the same brand (both sides: ``brand`` columns, ``core``), if it is
    ``least`` or more and ``margin`` above the second. For a person to confirm."""
    # Equal names are compared once. Of the funds of one name only the first two can be best and second. Shares deal a
    # brand's pairs over many tasks.
    name, spark = [*brand, "core"], listed.sparkSession
    first = Window.partitionBy(*name).orderBy("fund")
    two = funds.where("core is not null").select("fund", *name).withColumn("_n", F.row_number().over(first)).where("_n <= 2")
    theirs = two.groupBy(*name).agg(F.collect_list(F.struct("fund")).alias("_funds")).withColumnRenamed("core", "_core")
    asked = listed.where("core is not null").select(*name).distinct().withColumn("_share", F.pmod(F.xxhash64("core"), F.lit(SHARES)))
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *brand, "_share")
    dealt = theirs.withColumn("_share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SHARES - 1).cast("long"))))
    scored = asked.join(dealt.hint("shuffle_merge"), [*brand, "_share"]).select(*name, "_funds", ratio("core", "_core").alias("_r"))
    best = Window.partitionBy(*name).orderBy(F.desc("_r"), "fund")
    top = scored.select(*name, "_r", F.inline("_funds")).withColumn("_n", F.row_number().over(best)).where("_n <= 2").drop("_n")
    pairs = listed.select("code", *name).join(top.hint("shuffle_hash"), name)
    return best_with_margin(pairs.select("code", "fund", "_r"), ["code"], F.col("_r"), "fund", least, margin)


def unclaimed_status(claimed: Column, set_on: Column, listed_on: Column) -> Column:
    """What a rule's hit is: a product set up after the day of the list can't be on it yet, so it is no false positive."""
    return F.when(claimed, "CLAIMED").when(set_on > listed_on, "PENDING").otherwise("FALSE_POSITIVE")


def rule_bounds(listed: DataFrame, hits: DataFrame) -> DataFrame:
    """One row: how far a naming rule is right. listed: ``matched, missed``; hits: ``claimed``. Hits that nobody claims are the
    upper bound of false positives; those less the listed products without a match the lower one."""
    left = listed.agg(F.count("*").alias("listed"), F.count_if("matched").alias("matched"), F.count_if(F.col("matched") & F.col("missed")).alias("missed"))
    right = hits.agg(F.count("*").alias("hits"), F.count_if(~F.col("claimed")).alias("leftover"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    low = F.greatest(F.col("leftover") - (F.col("listed") - F.col("matched")), F.lit(0))
    out = left.crossJoin(right).withColumns({"miss_rate": share(F.col("missed"), F.col("matched")), "false_high": share(F.col("leftover"), F.col("hits")), "false_low": share(low, F.col("hits"))})  # one row each
    return out.withColumn("verdict", F.when(F.col("miss_rate") >= RULE_LIMIT, "REDESIGN").when(F.col("false_high") >= RULE_LIMIT, "LIST_DECIDES").otherwise("KEEP"))


def grade_flags(classes: DataFrame, funds: DataFrame, key: str) -> DataFrame:
    """Classes with ``flag`` where their grade is not the fund's (``key, grade``). A flagged class stays; one without a grade on
    either side can't differ."""
    own = classes.join(funds.select(key, F.col("grade").alias("fund_grade")), key, "left")
    return own.withColumn("flag", F.when(F.col("grade") != F.col("fund_grade"), "CLASS_GRADE_MISMATCH"))


def failure_log(rows: DataFrame, reason: Column, today: Column) -> DataFrame:
    """A row for each failed match (``reason`` null: none) with ``reason, retry, counts, failed_on, state``; a reason that isn't
    one of the nine is an error."""
    pick = lambda k: F.create_map(*(F.lit(x) for code, v in RETRY.items() for x in (code, v[k])))
    known = F.when(F.col("reason").isin(*RETRY), F.col("reason")).otherwise(F.raise_error(F.concat(F.lit("unknown reason: "), F.col("reason"))).cast("string"))
    failed = rows.withColumn("reason", reason).where("reason is not null").withColumn("reason", known)
    return failed.withColumns({"retry": pick(0)[F.col("reason")], "counts": pick(1)[F.col("reason")], "failed_on": today, "state": F.lit("OPEN")})


def due(log: DataFrame, today: Column, extracted: Column, master_changed: Column) -> DataFrame:
    """Open failures to try again on a day."""
    age = F.datediff(today, "failed_on")
    rule = (
        F.when(F.col("retry") == "DAILY_FOR_30_DAYS", age.between(1, 30)).when(F.col("retry") == "WEEKLY", (age > 0) & (age % 7 == 0))
        .when(F.col("retry") == "WITH_EXTRACTION", extracted).when(F.col("retry") == "WITH_MASTER", master_changed).otherwise(False)
    )
    return log.where((F.col("state") == "OPEN") & rule)
