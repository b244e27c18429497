"""Data-quality rules: each gives the rows that break it, and a report counts them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Rule:
    name: str
    description: str
    violations: Callable[[Tables], DataFrame]


def report(rules: Sequence[Rule], tables: Tables) -> DataFrame:
    """``rule, description, violations, ok``: one row per rule."""
    counted = [r.violations(tables).agg(F.count("*").alias("violations")).select(F.lit(r.name).alias("rule"), F.lit(r.description).alias("description"), "violations") for r in rules]
    return reduce(DataFrame.unionByName, counted).withColumn("ok", F.col("violations") == 0)


def row_rule(name: str, description: str, table: str, broken: Column) -> Rule:
    """Rows for which ``broken`` is true; null is not."""
    return Rule(name, description, lambda t: t[table].where(F.coalesce(broken, F.lit(False))))


def unique_rule(name: str, table: str, key: Sequence[str]) -> Rule:
    """Keys that more than one row has."""
    return Rule(name, f"{table}: {', '.join(key)} is unique", lambda t: t[table].groupBy(*key).count().where("count > 1"))


def parent_rule(name: str, child: str, child_key: str, parent: str, parent_key: str) -> Rule:
    """Given keys without a parent."""

    def find(t: Tables) -> DataFrame:
        keys = t[parent].select(F.col(parent_key).alias("_parent"))
        return t[child].where(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_parent"), "left_anti")

    return Rule(name, f"{child}.{child_key} has a {parent}", find)


def agreement_rule(name: str, left: str, right: str, on: Sequence[str], differ: Column) -> Rule:
    """Pairs of joined rows that disagree: an equi-join with a residual."""
    return Rule(name, f"{left} agrees with {right}", lambda t: t[left].join(t[right], list(on)).where(differ))


def one_value_rule(name: str, tables: Sequence[str], column: str) -> Rule:
    """All rows of all tables hold one value; the violations are the values beyond the first."""

    def find(t: Tables) -> DataFrame:
        values = reduce(DataFrame.union, [t[x].select(column) for x in tables]).distinct()
        return values.withColumn("_n", F.row_number().over(Window.orderBy(column))).where("_n > 1")  # distinct values only

    return Rule(name, f"one {column}", find)


def overlap_rule(name: str, table: str, keys: Sequence[str], start: str, end: str, order: Sequence[str] = ()) -> Rule:
    """Ranges that begin before one before them has ended."""

    def find(t: Tables) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(start, *order).rowsBetween(Window.unboundedPreceding, -1)
        return t[table].where(F.col(start).isNotNull()).withColumn("_reach", F.max(end).over(w)).where(F.col(start) < F.col("_reach"))

    return Rule(name, f"{table}: ranges do not overlap", find)


def count_rule(name: str, table: str, expected: int) -> Rule:
    return Rule(name, f"{table} has {expected} rows", lambda t: t[table].agg(F.count("*").alias("n")).where(F.col("n") != expected))
