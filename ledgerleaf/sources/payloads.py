"""Payloads of web sources as rows: viewer trees, paged lists, XML records, versioned objects. Everything is parsed
by DataFrame expressions; fetching is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import without_spaces
from ..operators.storage import newest

_PAIR = r"""node\d+\['(\w+)'\]\s*=\s*"([^"]*)";"""


def tree_nodes(page: Column) -> Column:
    """``array<map>`` of a viewer page's script: one map of the assignments behind each ``var nodeN = {};`` with an eleId."""
    pieces = F.split(page, r"var\s+node\d+\s*=\s*\{\};")
    blocks = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
    maps = F.transform(blocks, lambda b: F.map_from_arrays(F.regexp_extract_all(b, F.lit(_PAIR), 1), F.regexp_extract_all(b, F.lit(_PAIR), 2)))
    return F.filter(maps, lambda m: F.map_contains_key(m, F.lit("eleId")))


def node_named(nodes: Column, name: str) -> Column:
    """The first node whose text, without white space, is ``name``."""
    return F.get(F.filter(nodes, lambda m: without_spaces(F.element_at(m, "text")) == name), F.lit(0))


def first_link(html: Column, suffix: str = ".pdf") -> Column:
    """The first link to a file of that kind, ampersands decoded; null if there is none."""
    found = F.regexp_extract(html, rf"""(?i)href\s*=\s*["']([^"']*{suffix.replace(".", "[.]")}[^"']*)["']""", 1)
    return F.when(found != "", F.replace(found, F.lit("&amp;"), F.lit("&")))


def links(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """``key, no, link``: the distinct links of a page in the order in which they first appear."""
    found = df.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"""(?i)href\s*=\s*["']([^"']*)["']"""), 1)).alias("pos", "link"))
    return found.groupBy(key, "link").agg(F.min("pos").alias("no"))


def xml_records(df: DataFrame, key: str, xml: str, record: str, fields: tuple[str, ...], closing: str | None = None) -> DataFrame:
    """One row per ``<record>`` with the listed child elements, missing ones null. With ``closing``, a document that lacks
    that end tag is cut off, and gives an error when read."""
    body = F.col(xml)
    if closing:
        body = F.when(F.contains(body, F.lit(closing)), body).otherwise(F.raise_error(F.lit("the response is cut off")))
    blocks = F.regexp_extract_all(body, F.lit(rf"(?s)<{record}>(.*?)</{record}>"), 1)
    rows = df.select(key, F.posexplode(blocks).alias("no", "_b"))
    value = lambda f: F.try_element_at(F.regexp_extract_all("_b", F.lit(rf"(?s)<{f}>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</{f}>"), 1), F.lit(1))
    return rows.select(key, "no", *(value(f).alias(f) for f in fields))


def listed_items(df: DataFrame, body: str, schema: str, order: str, key: str) -> DataFrame:
    """Items of paged JSON lists (an object or an array under ``list``); of items with one key the last page's counts."""
    many, one = F.from_json(F.col(body), f"list array<struct<{schema}>>")["list"], F.from_json(F.col(body), f"list struct<{schema}>")["list"]
    items = df.select(order, F.posexplode(F.coalesce(many, F.array(one))).alias("_pos", "_i")).where("_i is not null").select("_i.*", order, "_pos")
    return newest(items, [key], [F.col(order), F.col("_pos")]).drop(order, "_pos")


def latest_objects(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Newest version of each stored object below a folder, by number: ``…/key/name__v12.ext``. Contents are read only for
    columns that are selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    named = files.withColumn("name", F.regexp_extract("path", r"^(.*)__v\d+\.[^./]+$", 1)).withColumn("version", F.regexp_extract("path", r"__v(\d+)\.[^./]+$", 1).cast("int"))
    return newest(named.where("version is not null").select("name", "version", "path", "length"), ["name"], [F.col("version")])


def day_spans(first: Column, last: Column, days: int = 28) -> Column:
    """``array<struct<start, end>>``: stretches of at most ``days`` days that cover first to last."""
    starts = F.sequence(first, last, F.make_interval(days=F.lit(days)))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.date_add(s, days - 1), last).alias("end")))
