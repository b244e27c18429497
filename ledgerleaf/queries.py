"""One query per operator over the input tables, and the SQL that gives the same rows."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import text as t
from .functions.unicode import comparable_name, nfkc, source_key
from .operators import aggregates as a
from .operators import conversion as cv
from .operators import grounding as g
from .operators import intervals as iv
from .operators import joins as j
from .operators import layout as ly
from .operators import lines as ln
from .operators import matching as mc
from .operators import metrics as mt
from .operators import rematch as rm
from .operators import rules as r
from .operators import standards as sd
from .operators import storage as st
from .plans import loading as ld
from .plans import replies as rp
from .sources import collect as co
from .sources import payloads as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


# Scalar functions ---------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, CASE WHEN starts_with(bare, 'small') THEN 'size' WHEN starts_with(bare, 'red') THEN 'colour' ELSE 'other' END AS kind,
starts_with(name, '[') AS is_correction FROM (SELECT p_partkey, name, regexp_replace(name, '^(\\[[^\\]]*\\])+', '') AS bare FROM (
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '[x][y]' ELSE '' END || p_name AS name FROM part))""")
def p1_report_kind(spark, d):
    parts = read(spark, d, "part").select("p_partkey", F.concat(F.when(F.col("p_partkey") % 3 == 0, "[x][y]").otherwise(""), "p_name").alias("name"))
    return parts.select("p_partkey", t.report_kind(F.col("name"), [("small", "size"), ("red", "colour")]).alias("k")).select("p_partkey", "k.*")


@query("""SELECT p_type, CASE WHEN contains(lower(p_type), 'economy') THEN 'economy' WHEN contains(lower(p_type), 'standard') THEN 'standard'
WHEN contains(lower(p_type), 'promo') THEN 'promo' ELSE 'other' END AS family, count(*) AS n FROM part GROUP BY ALL""")
def p2_first_contained(spark, d):
    return read(spark, d, "part").groupBy("p_type", t.first_contained(F.col("p_type"), ("economy", "standard", "promo")).alias("family")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, strlen(text) >= 0 AND length(text) < 500 AS short, length(regexp_replace(text, '\\s', '', 'g')) < 100 AS ocr,
CASE WHEN length(text) >= 500 THEN 'AVAILABLE' ELSE 'PARTIAL' END AS structure FROM documents WHERE text IS NOT NULL""")
def p3_p5_text_quality(spark, d):
    docs = read(spark, d, "documents").where("text is not null")
    ok = F.when(F.length("text") >= t.SHORT_TEXT_CHARS, "OK").otherwise("FAILED")
    return docs.select("doc_id", F.array_contains(t.quality_flags(F.col("text")), "SHORT_TEXT").alias("short"), t.needs_ocr(F.col("text")).alias("ocr"), t.structure_status(F.lit(True), ok).alias("structure"))


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN doc_id % 7 = 0 THEN 'REUSED' WHEN lang = 'es' THEN 'UNSUPPORTED'
WHEN doc_id % 11 = 0 THEN 'EXTRACT_FAILED' WHEN length(regexp_replace(text, '\\s', '', 'g')) < 100 THEN 'OCR_REQUIRED' ELSE 'EXTRACT_OK' END AS status FROM documents) GROUP BY status""")
def p6_extract_status(spark, d):
    status = t.extract_status(F.col("doc_id") % 7 == 0, F.col("lang") != "es", F.when(F.col("doc_id") % 11 == 0, "x"), F.col("text"), F.lit(0))
    return read(spark, d, "documents").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate::DATE::VARCHAR END AS day FROM orders""")
def p7_date_from_key(spark, d):
    key = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    kind = F.when(F.col("o_orderkey") % 3 > 0, "dated").otherwise("other")
    return read(spark, d, "orders").select("o_orderkey", t.date_of_key(key, kind, "dated").cast("string").alias("day"))


@query(r"""SELECT doc_id, substr(text, 11) AS piece, regexp_replace(regexp_replace(text, '^[\s\x0B\x85\p{Z}]+|[\s\x0B\x85\p{Z}]+$', '', 'g'), '\d+', '#', 'g') AS mask,
regexp_replace(text, '[^0-9A-Za-z가-힣]', '', 'g') AS normal FROM documents WHERE text IS NOT NULL""")
def p9_p16_p17_slices(spark, d):
    text = F.col("text")
    docs = read(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", t.text_slice(text, F.lit(10), F.greatest(F.length(text), F.lit(10))).alias("piece"), t.digit_mask(text).alias("mask"), t.normal_title(text).alias("normal"))


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN (1000 * 0.3 + o_orderkey * 2.5) / 1e6 WHEN '2-HIGH' THEN (1000 * 0.8 + o_orderkey * 3.2) / 1e6 END AS cost FROM orders""")
def p14_call_cost(spark, d):
    prices = {"1-URGENT": (0.3, 2.5), "2-HIGH": (0.8, 3.2)}
    return read(spark, d, "orders").select("o_orderkey", t.call_cost(F.col("o_orderpriority"), F.lit(1000), F.col("o_orderkey"), prices).alias("cost"))


@query("""WITH c AS (SELECT p_partkey, p_partkey % 3 AS kind, (p_partkey % 256) / 255 AS a, (p_partkey * 7 % 256) / 255 AS b, (p_partkey * 3 % 256) / 255 AS c, (p_partkey % 5) / 5 AS k FROM part),
v AS (SELECT p_partkey, CASE kind WHEN 0 THEN [a, a, a] WHEN 1 THEN [a, b, c] ELSE [(1 - a) * (1 - k), (1 - b) * (1 - k), (1 - c) * (1 - k)] END AS x FROM c)
SELECT p_partkey, '#' || array_to_string(list_transform(x, lambda y: lpad(lower(to_hex(round_even(y * 255, 0)::INT)), 2, '0')), '') AS color FROM v""")
def p15_hex_color(spark, d):
    a, b, c, k = (F.col("p_partkey") % 256) / 255, (F.col("p_partkey") * 7 % 256) / 255, (F.col("p_partkey") * 3 % 256) / 255, (F.col("p_partkey") % 5) / 5
    parts = F.when(F.col("p_partkey") % 3 == 0, F.array(a)).when(F.col("p_partkey") % 3 == 1, F.array(a, b, c)).otherwise(F.array(a, b, c, k))
    return read(spark, d, "part").select("p_partkey", t.hex_color(parts).alias("color"))


@query(r"""SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '[\s\x0B\x85\p{Z}]+'), lambda w: w <> ''), ' ') AS title FROM documents
WHERE len(list_filter(string_split_regex(text, '[\s\x0B\x85\p{Z}]+'), lambda w: w <> '')) > 1""")
def p18_undoubled(spark, d):
    words = F.filter(F.split("text", r"(?U)\s+"), lambda w: w != "")
    twice = F.array_join(F.transform(words, lambda w: F.regexp_replace(w, "(?s)(.)", "$1$1")), " ")
    return read(spark, d, "documents").where(F.size(words) > 1).select("doc_id", t.undoubled(twice).alias("title"))


@query("""SELECT p_partkey, upper(regexp_replace(p_name, '[^0-9A-Za-z]', '', 'g')) AS name, p_name AS nfkc FROM part""")
def p19_comparable_names(spark, d):
    return read(spark, d, "part").select("p_partkey", comparable_name("p_name").alias("name"), nfkc("p_name").alias("nfkc"))


@query("""SELECT scheme, count(*) AS n FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN 'K55' WHEN 1 THEN 'KR5' WHEN 2 THEN 'KRM' ELSE 'OTHER' END AS scheme FROM part) GROUP BY scheme""")
def p20_code_scheme(spark, d):
    code = F.concat(F.element_at(F.array(F.lit("K55"), F.lit("KR5"), F.lit("KRM"), F.lit("US0")), (F.col("p_partkey") % 4 + 1).cast("int")), F.col("p_partkey").cast("string"))
    return read(spark, d, "part").groupBy(t.code_scheme(code).alias("scheme")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, 'a%2Fb~' || replace(c_name, '~', '%7E') AS source_key FROM customer""")
def k2_source_key(spark, d):
    return read(spark, d, "customer").select("c_custkey", source_key(F.array(F.lit("a/b"), "c_name")).alias("source_key"))


@query("""SELECT o_orderkey, sha256('[' || o_orderkey || ',"' || o_orderstatus || '\\n",null]') AS key FROM orders""")
def x2_canonical_key(spark, d):
    status = F.concat("o_orderstatus", F.lit("\n"))
    return read(spark, d, "orders").select("o_orderkey", t.canonical_key(F.col("o_orderkey"), status, F.lit(None).cast("string")).alias("key"))


@query("""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN s = 200 THEN 'SUCCESS' WHEN s = 429 THEN 'RATE_LIMITED' WHEN s >= 500 THEN 'RETRYABLE_FAILED'
WHEN s IN (401, 403) THEN 'CONFIG_ERROR' ELSE 'PERMANENT_FAILED' END AS outcome FROM (SELECT 200 + event_id % 400 AS s FROM events)) GROUP BY outcome""")
def s6_http_outcome(spark, d):
    return read(spark, d, "events").groupBy(t.http_outcome(200 + F.col("event_id") % 400).alias("outcome")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, 'a+b ' || c_custkey AS name, CASE c_custkey % 4 WHEN 0 THEN '요약정보' WHEN 1 THEN '표지' WHEN 2 THEN '제2부 ' || c_custkey || '절' END AS label, c_custkey % 10 = 7 AS mentions, (c_custkey % 6 + 1)::INT AS grade FROM customer""")
def p8_p10_p11_p22_labels(spark, d):
    k = F.col("c_custkey")
    name = t.percent_decode(F.concat(F.lit("a+b%20"), k))
    kind = F.when(k % 4 == 0, "summary").when(k % 4 == 1, "other").when(k % 4 == 2, "body").otherwise("other")
    seq, part = F.when(k % 4 == 1, 1).otherwise(2), F.lit(2)
    words = t.contains_any(F.concat(F.lit("x"), k % 10), ["x7", "zz"])
    return read(spark, d, "customer").select("c_custkey", name.alias("name"), t.section_label(kind, part, seq, k.cast("string")).alias("label"), words.alias("mentions"), t.risk_grade(F.concat((k % 6 + 1).cast("string"), F.lit("등급 (다음 9등급)"))).alias("grade"))


@query("""SELECT p_partkey, p_partkey % 2 = 0 AS pdf, p_partkey % 2 = 1 AS zip FROM part""")
def h8_s2_magic(spark, d):
    content = F.when(F.col("p_partkey") % 2 == 0, F.encode(F.lit("%PDF-1.4"), "UTF-8")).otherwise(F.unhex(F.lit("504B030400")))
    return read(spark, d, "part").select("p_partkey", t.is_magic(content, "pdf").alias("pdf"), t.is_magic(content, "zip").alias("zip"))


@query("""SELECT page_id, nullif(regexp_extract(replace(html, '&amp;', '&'), '(?i)href\\s*=\\s*["'']([^"'']*[.]pdf[^"'']*)["'']', 1), '') AS link FROM (SELECT page_id, html || '<a href="f?a=1&amp;b=' || page_id || '.pdf">' AS html FROM pages)""")
def s5_first_link(spark, d):
    html = F.concat("html", F.lit('<a href="f?a=1&amp;b='), "page_id", F.lit('.pdf">'))
    return read(spark, d, "pages").select("page_id", src.first_link(html).alias("link"))


@query("""SELECT o_orderkey FROM orders WHERE o_custkey % 100 >= 90""")
def j5_orphans(spark, d):
    customers = read(spark, d, "customer").where("c_custkey % 100 < 90").select("c_custkey")
    return j.orphans(read(spark, d, "orders"), customers, F.col("o_custkey"), F.col("c_custkey")).select("o_orderkey")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate + INTERVAL 30 DAY""")
def j6_j7_disagreements(spark, d):
    tables = {"l": read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o": read(spark, d, "orders")}
    early = F.col("l_shipdate") < F.col("o_orderdate") + F.expr("interval 30 days")
    return r.agreement_rule("late", "l", "o", ["o_orderkey"], early).violations(tables).select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber")


# Sources ------------------------------------------------------------------------------------------------------------


@query("""SELECT page_id, link, min(pos) - 1 AS no FROM (SELECT page_id, unnest(l) AS link, unnest(range(1, len(l) + 1)) AS pos FROM (
SELECT page_id, regexp_extract_all(html, '(?i)href\\s*=\\s*["'']([^"'']*)["'']', 1) AS l FROM pages)) GROUP BY page_id, link""")
def s20_page_links(spark, d):
    return src.links(read(spark, d, "pages"), "page_id").select("page_id", "link", F.col("no").cast("long").alias("no"))


@query("""SELECT c_custkey, c_custkey::VARCHAR AS "eleId", c_name AS text, c_name AS named FROM customer""")
def s3_s4_tree_nodes(spark, d):
    page = F.concat(F.lit("var node1 = {};\nnode1['text'] = \"x\";\nvar node2 = {};\nnode2['text'] = \" 본 문 \";\nnode2['eleId'] = \""), F.col("c_custkey").cast("string"), F.lit("\";\nnode2['dtd'] = \""), "c_name", F.lit('";'))
    nodes = read(spark, d, "customer").select("c_custkey", src.tree_nodes(page).alias("nodes"))
    named = nodes.withColumn("named", src.node_named(F.col("nodes"), "본문")["dtd"])
    return named.select("c_custkey", "named", F.explode("nodes").alias("m")).select("c_custkey", F.col("m")["eleId"].alias("eleId"), F.col("m")["dtd"].alias("text"), "named")


@query("""SELECT o_custkey, 0 AS no, 'F' || o_custkey AS code, NULL::VARCHAR AS name FROM (SELECT DISTINCT o_custkey FROM orders)""")
def s14_xml_records(spark, d):
    xml = F.concat(F.lit("<root><list><code>F"), F.col("o_custkey").cast("string"), F.lit("</code></list></root>"))
    bodies = read(spark, d, "orders").select("o_custkey").distinct().withColumn("xml", xml)
    return src.xml_records(bodies, "o_custkey", "xml", "list", ("code", "name"), "</root>")


@query("""SELECT o_custkey AS id, max_by(o_orderstatus, o_orderkey) AS name FROM orders GROUP BY o_custkey""")
def s10_listed_items(spark, d):
    body = F.to_json(F.struct(F.array(F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("name"))).alias("list")))
    return src.listed_items(read(spark, d, "orders").select("o_orderkey", body.alias("body")), "body", "id long, name string", "o_orderkey", "id")


@query("""SELECT o_orderkey, a::DATE::VARCHAR AS start, least(a + INTERVAL 27 DAY, b)::DATE::VARCHAR AS "end" FROM (SELECT o_orderkey, o_orderdate::DATE::TIMESTAMP AS b, unnest(generate_series(o_orderdate::DATE - INTERVAL 60 DAY, o_orderdate::DATE::TIMESTAMP, INTERVAL 28 DAY)) AS a FROM orders)""")
def s19_day_spans(spark, d):
    day = F.to_date("o_orderdate")
    return read(spark, d, "orders").select("o_orderkey", F.explode(src.day_spans(F.date_sub(day, 60), day)).alias("s")).select("o_orderkey", F.col("s.start").cast("string").alias("start"), F.col("s.end").cast("string").alias("end"))


# Lines, runs and ranges ----------------------------------------------------------------------------------------------

_LINES = """l AS (SELECT doc_id, unnest(range(len(p))) AS no, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)),
o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l)"""


def _lines(spark, d):
    return ln.text_lines(read(spark, d, "documents").where("text is not null"), "doc_id")


@query(f"""WITH {_LINES} SELECT doc_id, no::INT AS no, start, start + length(line) AS "end" FROM o""")
def t1_text_lines(spark, d):
    return _lines(spark, d).drop("line")


@query("""SELECT event_id, sum(n) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run FROM (
SELECT event_id, user_id, CASE WHEN value > lag(value) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS n FROM events)""")
def t3_ascending_runs(spark, d):
    return ln.ascending_runs(read(spark, d, "events"), ["user_id"], "event_id", "value").select("event_id", "run")


@query("""SELECT event_id FROM (SELECT *, max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM events) WHERE m IS NULL OR value > m""")
def t4_ascending_picks(spark, d):
    return ln.ascending_picks(read(spark, d, "events"), ["user_id"], "event_id", "value").select("event_id")


@query(f"""WITH {_LINES} SELECT o.doc_id, start, coalesce(lead(start) OVER (PARTITION BY o.doc_id ORDER BY start), length(text)) AS "end" FROM o JOIN documents USING (doc_id) WHERE length(line) < 60""")
def t14_heading_ranges(spark, d):
    sizes = read(spark, d, "documents").select("doc_id", F.length("text").cast("long").alias("n"))
    heads = _lines(spark, d).where(F.length("line") < 60).select("doc_id", "start").join(sizes, "doc_id")
    return ln.until_next(heads, ["doc_id"], "start", F.col("n")).select("doc_id", "start", "end")


@query("""SELECT o_orderkey, coalesce((SELECT min(b.o_orderkey) FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderkey > a.o_orderkey
AND (CASE b.o_orderstatus WHEN 'O' THEN 2 ELSE 1 END) <= (CASE a.o_orderstatus WHEN 'O' THEN 2 ELSE 1 END)), -1)::BIGINT AS "end" FROM orders a""")
def t20_level_ranges(spark, d):
    rows = read(spark, d, "orders").withColumn("level", F.when(F.col("o_orderstatus") == "O", 2).otherwise(1))
    return ln.until_level(rows, ["o_custkey"], "o_orderkey", "level", F.lit(-1)).select("o_orderkey", F.col("end").cast("long").alias("end"))


@query("""WITH p AS (SELECT lang, doc_id // 50 AS book, doc_id AS page, coalesce(text, '') AS body, coalesce(sum(length(coalesce(text, '')) + 1) OVER (PARTITION BY lang, doc_id // 50 ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ps FROM documents),
l AS (SELECT lang, book, page, ps, unnest(range(len(s))) AS no, unnest(s) AS line FROM (SELECT *, string_split(body, chr(10)) AS s FROM p)),
o AS (SELECT *, ps + coalesce(sum(length(line) + 1) OVER (PARTITION BY lang, book, page ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM l),
e AS (SELECT *, row_number() OVER (PARTITION BY lang, book, page ORDER BY no) AS f, row_number() OVER (PARTITION BY lang, book, page ORDER BY no DESC) AS z,
regexp_replace(trim(line, E' \\t\\n\\r'), '\\d+', '#', 'g') AS mask FROM o WHERE trim(line, E' \\t\\n\\r') <> ''),
c AS (SELECT lang, book, mask FROM e JOIN (SELECT lang, book, count(*) AS n FROM p GROUP BY lang, book) USING (lang, book) WHERE (f = 1 OR z = 1) GROUP BY lang, book, mask, n HAVING count(DISTINCT page) >= greatest(2, 0.02 * n))
SELECT DISTINCT lang, book, start, start + length(rtrim(line, E' \\t\\n\\r')) AS "end" FROM e WHERE (f = 1 OR z = 1) AND ((lang, book, mask) IN (SELECT (lang, book, mask) FROM c) OR (z = 1 AND regexp_matches(trim(line, E' \\t\\n\\r'), '^[-\\s]*\\d+(\\s*/\\s*\\d+)?[-\\s]*$')))""")
def t17_page_furniture(spark, d):
    """Books of the documents of one language whose ids are in one fifty; a document is a page."""
    body = F.coalesce("text", F.lit(""))
    before = Window.partitionBy("lang", "book").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    pages = read(spark, d, "documents").select("lang", F.floor(F.col("doc_id") / 50).alias("book"), F.col("doc_id").alias("page"), body.alias("page_text"))
    starts = pages.select("lang", "book", "page", (F.length("page_text") + 1).alias("n")).withColumn("page_start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ln.furniture(pages.join(starts.drop("n"), ["lang", "book", "page"]), ["lang", "book"], share=0.02, least=2)


def _ranges(spark, d):
    """Order lines as ranges on a part's axis."""
    return read(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")).alias("start")).withColumn("end", F.col("start") + 30).select("k", F.col("start").cast("long"), F.col("end").cast("long"))


_RANGES = "r AS (SELECT l_partkey AS k, date_diff('day', DATE '1990-01-01', l_shipdate::DATE) AS start, date_diff('day', DATE '1990-01-01', l_shipdate::DATE) + 30 AS \"end\" FROM lineitem)"
_UNION = """u AS (SELECT k, min(start) AS start, max("end") AS "end" FROM (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS i FROM (
SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY k ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS n FROM r)) GROUP BY k, i)"""


@query(f"WITH {_RANGES}, {_UNION} SELECT * FROM u")
def t19_union_ranges(spark, d):
    return iv.union_ranges(_ranges(spark, d), ["k"])


@query(f"""WITH {_RANGES}, {_UNION}, h AS (SELECT *, lead(start) OVER (PARTITION BY k ORDER BY start) AS nx, row_number() OVER (PARTITION BY k ORDER BY start) AS n FROM u)
SELECT * FROM (SELECT k, 0 AS start, start AS "end" FROM h WHERE n = 1 UNION ALL SELECT k, "end", coalesce(nx, 5000) FROM h) WHERE start < "end" AND start < 5000""")
def t31_subtract_ranges(spark, d):
    holes = _ranges(spark, d)
    whole = holes.select("k").distinct().select("k", F.lit(0).cast("long").alias("start"), F.lit(5000).cast("long").alias("end"))
    return iv.subtract_ranges(whole, holes, ["k"])


@query("""SELECT o_orderkey, o_custkey, n FROM (SELECT o.o_orderkey, o.o_custkey, count(*) AS n FROM orders o JOIN (SELECT c_custkey, DATE '1995-01-01' + (c_custkey % 900)::INT AS a, DATE '1995-01-01' + (c_custkey % 900)::INT + 200 AS b FROM customer) c
ON o.o_custkey = c.c_custkey AND o.o_orderdate::DATE >= a AND o.o_orderdate::DATE < b GROUP BY ALL)""")
def j12_points_in_ranges(spark, d):
    day = lambda c: F.datediff(c, F.lit("1990-01-01").cast("date"))
    base = F.datediff(F.lit("1995-01-01").cast("date"), F.lit("1990-01-01").cast("date")) + F.col("o_custkey") % 900
    periods = read(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey").select("o_custkey", base.alias("start"), (base + 200).alias("end"))
    points = read(spark, d, "orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("at"))
    return iv.points_in_ranges(points, periods, ["o_custkey"], "at", bin_size=365).groupBy("o_orderkey", "o_custkey").agg(F.count("*").alias("n"))


@query(f"""WITH {_RANGES} SELECT a.k, a.start, a."end", b.start AS r_start, b."end" AS r_end, count(*) AS n FROM r a JOIN r b ON a.k = b.k AND a.start < b."end" AND b.start < a."end" WHERE a.start < b.start GROUP BY ALL""")
def j11_overlapping(spark, d):
    mine = _ranges(spark, d)
    other = mine.select("k", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    return iv.overlapping(mine, other, ["k"], bin_size=60).where("start < r_start").groupBy("k", "start", "end", "r_start", "r_end").agg(F.count("*").alias("n"))


@query(f"""WITH {_RANGES}, n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY start, "end") AS seq FROM r), w AS (SELECT *, coalesce(max("end") OVER (PARTITION BY k ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach FROM n)
SELECT k, seq::BIGINT AS seq, CASE WHEN "end" > 2500 THEN 'OUT_OF_BOUNDS' ELSE 'OVERLAP' END AS problem FROM w WHERE "end" > 2500 OR start < reach""")
def t16_range_violations(spark, d):
    rows = _ranges(spark, d).withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("start", "end"))).withColumn("length", F.lit(2500))
    return iv.range_violations(rows, ["k"]).select("k", F.col("seq").cast("long").alias("seq"), F.explode("problems").alias("problem"))


# Joins --------------------------------------------------------------------------------------------------------------


@query("""SELECT p.p_partkey, w.word FROM part p JOIN (SELECT DISTINCT string_split(p_name, ' ')[1] AS word FROM part) w ON contains(p.p_name, w.word)""")
def j13_containing(spark, d):
    parts = read(spark, d, "part").select("p_partkey", "p_name")
    words = parts.select(F.substring_index("p_name", " ", 1).alias("word")).distinct()
    return j.containing(parts, words, "p_name", "word").select("p_partkey", "word")


@query("""SELECT o_orderkey, event_id FROM (SELECT o.o_orderkey, (SELECT max_by(e.event_id, (e.ts, e.event_id)) FROM events e WHERE e.user_id = o.o_custkey AND e.ts <= o.o_orderdate + INTERVAL 11000 DAY) AS event_id FROM orders o)""")
def j20_as_of(spark, d):
    left = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), (F.col("o_orderdate") + F.expr("interval 11000 days")).alias("at"))
    return j.as_of(left, read(spark, d, "events").select("user_id", "ts", "event_id"), ["user_id"], "at", "ts", ["event_id"]).select("o_orderkey", "event_id")


@query("""SELECT c_custkey, CASE WHEN n = 1 THEN one END AS s_suppkey, CASE WHEN n = 1 THEN 'MATCHED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'NO_CANDIDATE' END AS match
FROM customer LEFT JOIN (SELECT s_nationkey, count(DISTINCT s_suppkey) AS n, min(s_suppkey) AS one FROM supplier GROUP BY s_nationkey) ON c_nationkey = s_nationkey""")
def j17_unique_match(spark, d):
    left = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return j.unique_match(left, read(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation")), ["nation"], "nation", "s_suppkey").drop("nation")


@query("""SELECT c_custkey, coalesce(n.n_name, r.r_name) AS name, CASE WHEN n.n_name IS NOT NULL THEN 'nation' WHEN r.r_name IS NOT NULL THEN 'region' END AS step FROM customer
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) n ON c_nationkey = n.n_nationkey LEFT JOIN region r ON c_nationkey % 7 = r.r_regionkey""")
def j18_first_hit(spark, d):
    nations = read(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    regions = read(spark, d, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    rows = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("a"), (F.col("c_nationkey") % 7).alias("b"))
    return j.first_hit(rows, [("nation", nations, "a", "key"), ("region", regions, "b", "key")], "name").select("c_custkey", "name", "step")


@query("""SELECT l_orderkey, l_linenumber, score, second FROM (SELECT l_orderkey, max(CASE WHEN n = 1 THEN l_linenumber END) AS l_linenumber, max(CASE WHEN n = 1 THEN l_quantity END) AS score, max(CASE WHEN n = 2 THEN l_quantity END) AS second
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS n FROM lineitem) WHERE n <= 2 GROUP BY l_orderkey) WHERE score >= 20 AND (second IS NULL OR score - second >= 5)""")
def j15_best_with_margin(spark, d):
    return j.best_with_margin(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], F.col("l_quantity"), "l_linenumber", 20, 5)


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) AS similarity FROM
(SELECT p_partkey, p_brand, p_type, list_distinct(string_split(p_name, ' ')) AS x FROM part) a JOIN (SELECT p_partkey, p_brand, p_type, list_distinct(string_split(p_name, ' ')) AS y FROM part) b USING (p_brand, p_type) WHERE a.p_partkey < b.p_partkey""")
def j19_name_similarity(spark, d):
    parts = read(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return j.group_similarity(parts, ["p_brand", "p_type"], "p_partkey", "p_name")


# Aggregations, windows, order -----------------------------------------------------------------------------------------


@query("""SELECT l_returnflag, l_extendedprice AS p10 FROM (SELECT l_returnflag, l_extendedprice, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS r, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) WHERE r = least(n, floor(0.1 * n)::BIGINT + 1)""")
def a2_nearest_rank(spark, d):
    return a.nearest_rank(read(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.1, "p10")


@query("""SELECT count(*) AS n, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') / count(*) AS ok_share,
min(o_totalprice) FILTER (o_orderstatus = 'O') AS least, median(o_totalprice) FILTER (o_orderstatus = 'O') AS median, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS total FROM orders""")
def a1_status_summary(spark, d):
    return a.status_summary(read(spark, d, "orders"), "o_orderstatus", "o_totalprice", ("O", "F")).withColumn("total", F.round("total", 2))


@query("""SELECT p_brand, count(*) AS n, round(median(p_retailprice), 3) AS median FROM part WHERE p_size > 10 GROUP BY p_brand""")
def a5_group_median(spark, d):
    return read(spark, d, "part").where("p_size > 10").groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.median("p_retailprice"), 3).alias("median"))


@query("""SELECT left(string_split(reason, ':')[1], 60) AS reason, count(*) AS count FROM (SELECT event_type || ': ' || event_id AS reason FROM events) GROUP BY 1""")
def a7_reason_histogram(spark, d):
    return a.reason_histogram(read(spark, d, "events").select(F.concat("event_type", F.lit(": "), "event_id").alias("reason")), "reason")


@query("""WITH h AS (SELECT sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS h FROM orders),
s AS (SELECT count(*) AS n, sum(('0x' || substr(h, 1, 15))::BIGINT) AS a, sum(('0x' || substr(h, 16, 15))::BIGINT) AS b, sum(('0x' || substr(h, 31, 15))::BIGINT) AS c, sum(('0x' || substr(h, 46, 15))::BIGINT) AS d FROM h)
SELECT n::BIGINT AS n, sha256(n || '|' || a || '|' || b || '|' || c || '|' || d) AS checksum FROM s""")
def a12_table_checksum(spark, d):
    return a.table_checksum(read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")).select(F.col("n").cast("long").alias("n"), "checksum")


@query("""SELECT o_custkey, sha256(string_agg(o_orderstatus, chr(10) || chr(10) ORDER BY o_orderkey)) AS sha256 FROM orders GROUP BY o_custkey""")
def a15_joined_text(spark, d):
    return a.joined_text(read(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_orderstatus").select("o_custkey", "sha256")


@query("""SELECT user_id, i AS group_no, event_type, count(*) AS size, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS members FROM (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS i FROM (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS n FROM events)) GROUP BY ALL""")
def a16_consecutive_groups(spark, d):
    return a.consecutive_groups(read(spark, d, "events"), ["user_id"], "event_id", ["event_type"], "event_id").withColumn("members", F.array_join("members", ","))


@query("""SELECT count(*) AS groups, max(size) AS largest, avg(size) AS mean_size FROM (SELECT count(*) AS size FROM lineitem GROUP BY l_partkey, l_suppkey)""")
def a19_group_sizes(spark, d):
    return a.group_sizes(read(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""SELECT c_mktsegment, c_nationkey, count(DISTINCT c_custkey) AS units, count(DISTINCT c_custkey) >= 30 AS usable FROM customer GROUP BY ALL""")
def a25_strata(spark, d):
    return a.strata(read(spark, d, "customer"), ["c_mktsegment", "c_nationkey"], "c_custkey")


@query("""SELECT o_custkey, 0.4 * a + 0.6 * b AS score FROM (SELECT o_custkey, avg(o_totalprice) AS a, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS b FROM orders GROUP BY o_custkey)""")
def a26_weighted(spark, d):
    axes = read(spark, d, "orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("a"), F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice"))).alias("b"))
    return axes.select("o_custkey", a.weighted([F.col("a"), F.col("b")], [0.4, 0.6]).alias("score"))


@query("""SELECT o_custkey, CASE WHEN bool_and(s = 'OK') THEN 'OK' WHEN bool_and(s = 'FAILED') THEN 'FAILED' WHEN bool_or(s = 'FAILED') THEN 'PARTIAL' ELSE 'PENDING' END AS status
FROM (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'FAILED' ELSE 'WAIT' END AS s FROM orders) GROUP BY o_custkey""")
def a27_combined_status(spark, d):
    s = F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "FAILED").otherwise("WAIT")
    return read(spark, d, "orders").withColumn("s", s).groupBy("o_custkey").agg(a.combined_status("s").alias("status"))


@query("""SELECT c_custkey, percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS percentile FROM customer""")
def w3_stratum_percentile(spark, d):
    return read(spark, d, "customer").select("c_custkey", F.percent_rank().over(Window.partitionBy("c_mktsegment").orderBy("c_acctbal")).alias("percentile"))


@query("""SELECT o_custkey, max_by(o_orderkey, (o_orderstatus <> 'F', o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey""")
def o1_last_usable(spark, d):
    return st.last_usable(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderstatus", "o_orderkey", "F").select("o_custkey", "o_orderkey")


@query("""SELECT n_name AS name FROM nation EXCEPT SELECT n_name FROM nation WHERE n_regionkey = 1""")
def u4_set_difference(spark, d):
    names = read(spark, d, "nation").select(F.col("n_name").alias("name"), "n_regionkey")
    return names.select("name").subtract(names.where("n_regionkey = 1").select("name"))


@query("""WITH RECURSIVE e(child, parent) AS (VALUES ('lineitem', 'orders'), ('lineitem', 'part'), ('orders', 'customer'), ('customer', 'nation'), ('supplier', 'nation'), ('nation', 'region')),
c(name) AS (SELECT 'customer' UNION SELECT e.child FROM e JOIN c ON e.parent = c.name) SELECT name FROM c""")
def u2_reachable_tables(spark, d):
    edges = [("lineitem", "orders"), ("lineitem", "part"), ("orders", "customer"), ("customer", "nation"), ("supplier", "nation"), ("nation", "region")]
    return st.reachable_tables(spark, spark.createDataFrame(edges, "child string, parent string"), ["customer"])


# Storage, increments --------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey, sum(n) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INT AS version, n = 0 AS reused FROM (SELECT *, CASE WHEN o_orderstatus = lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) THEN 0 ELSE 1 END AS n FROM orders)""")
def k1_assign_versions(spark, d):
    return st.assign_versions(read(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], "o_orderstatus").select("o_orderkey", "o_custkey", "version", "reused")


@query("""SELECT c_custkey, row_number() OVER (ORDER BY md5(c_custkey::VARCHAR), c_custkey) AS id FROM customer""")
def k6_surrogate_ids(spark, d):
    return st.surrogate_ids(read(spark, d, "customer").select("c_custkey"), ["c_custkey"], "id")


_DAYS = "d AS (SELECT event_type AS source, ts::DATE AS day, count(*) > 2 AS complete FROM events GROUP BY ALL)"


def _days(spark, d):
    return read(spark, d, "events").groupBy(F.col("event_type").alias("source"), F.to_date("ts").alias("day")).agg((F.count("*") > 2).alias("complete"))


@query(f"""WITH {_DAYS}, g AS (SELECT *, coalesce(date_diff('day', lag(day) OVER (PARTITION BY source ORDER BY day), day), 1) = 1 AS nx FROM d), w AS (SELECT *, bool_and(complete AND nx) OVER (PARTITION BY source ORDER BY day) AS ok FROM g)
SELECT source, min(day)::VARCHAR AS first_day, (max(day) FILTER (ok))::VARCHAR AS watermark FROM w GROUP BY source""")
def m1_complete_until(spark, d):
    found = st.complete_until(_days(spark, d), "source", "day", "complete")
    return found.select("source", F.col("first_day").cast("string").alias("first_day"), F.col("watermark").cast("string").alias("watermark"))


@query(f"""WITH {_DAYS}, g AS (SELECT *, coalesce(date_diff('day', lag(day) OVER (PARTITION BY source ORDER BY day), day), 1) = 1 AS nx FROM d), w AS (SELECT *, bool_and(complete AND nx) OVER (PARTITION BY source ORDER BY day) AS ok FROM g)
SELECT source, greatest((max(day) FILTER (ok)) - 3, min(day))::DATE::VARCHAR AS restart FROM w GROUP BY source HAVING count(*) FILTER (ok) > 0""")
def m2_restart_day(spark, d):
    marks = st.complete_until(_days(spark, d), "source", "day", "complete").where("watermark is not null")
    return marks.select("source", st.restart_day(F.col("watermark"), F.col("first_day")).cast("string").alias("restart"))


@query("""SELECT user_id, ts::DATE::VARCHAR AS day FROM events WHERE event_type = 'signup' EXCEPT SELECT user_id, ts::DATE::VARCHAR FROM events WHERE event_type = 'purchase'""")
def m4_unseen(spark, d):
    events = read(spark, d, "events").select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type")
    return st.unseen(events.where("event_type = 'signup'").drop("event_type"), events.where("event_type = 'purchase'"), ["user_id", "day"])


@query("""SELECT event_id, s <= 100 AS admitted FROM (SELECT event_id, sum(event_id % 13) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events)""")
def e20_within_budget(spark, d):
    events = read(spark, d, "events").withColumn("cost", F.col("event_id") % 13)
    return st.within_budget(events, ["user_id"], ["ts", "event_id"], "cost", 100).select("event_id", "admitted")


@query("""WITH g AS (SELECT DISTINCT ts::DATE AS day, user_id FROM events), o AS (SELECT day, lead(day) OVER (ORDER BY day) AS nx FROM (SELECT DISTINCT day FROM g))
SELECT nx::VARCHAR AS gone_on, user_id FROM g JOIN o USING (day) WHERE nx IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g h WHERE h.day = o.nx AND h.user_id = g.user_id)""")
def x5_snapshot_leavers(spark, d):
    days = read(spark, d, "events").select(F.to_date("ts").alias("day"), "user_id", F.lit(True).alias("complete"))
    return st.snapshot_leavers(days, "day", "user_id", "complete").select(F.col("gone_on").cast("string").alias("gone_on"), "user_id")


@query("""SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def j1_joined_or_error(spark, d):
    customers = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return ld.joined_or_error(read(spark, d, "orders").select("o_orderkey", "o_custkey"), customers, ["o_custkey"], "customer")


@query("""SELECT c_custkey, 'NO_EXTRACTION' AS reason FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def j2_skipped_bodies(spark, d):
    attempts = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return ld.loadable(read(spark, d, "customer").select("c_custkey"), attempts, ["c_custkey"])[1]


@query("""WITH i AS (SELECT c_mktsegment, c_nationkey, row_number() OVER (ORDER BY md5(c_mktsegment || chr(31) || c_nationkey), c_mktsegment, c_nationkey) AS id FROM (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer))
SELECT c_custkey, id FROM customer JOIN i USING (c_mktsegment, c_nationkey)""")
def j3_parent_ids(spark, d):
    customers = read(spark, d, "customer")
    return ld.with_parent_ids(customers.select("c_custkey", "c_mktsegment", "c_nationkey"), customers, ["c_mktsegment", "c_nationkey"], "id").select("c_custkey", "id")


@query("""SELECT 'orders' AS "table", count(*) AS n FROM orders WHERE o_orderstatus <> 'F'""")
def k7_foreign_rows(spark, d):
    orders = read(spark, d, "orders").withColumnRenamed("o_orderstatus", "source")
    return ld.foreign_rows({"orders": orders, "closed": orders.where("source = 'F'")}, "F")


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'MISSING' WHEN doc_id % 5 = 1 THEN 'SIZE' ELSE 'DIGEST' END AS problem FROM documents WHERE text IS NOT NULL AND doc_id % 5 < 3""")
def q5_changed_contents(spark, d):
    docs = read(spark, d, "documents").where("text is not null")
    k, raw = F.col("doc_id") % 5, F.encode("text", "UTF-8")
    rows = docs.select("doc_id", F.when(k == 2, F.sha2(F.lit("other"), 256)).otherwise(F.sha2(raw, 256)).alias("sha256"), (F.octet_length("text") + F.when(k == 1, 1).otherwise(0)).alias("byte_size"))
    return ld.changed_contents(rows, docs.where(k != 0).select("doc_id", raw.alias("content")), "doc_id", "sha256", "byte_size")


@query("""SELECT doc_id FROM documents WHERE text IS NOT NULL AND doc_id % 3 = 0""")
def q14_changed_slices(spark, d):
    docs = read(spark, d, "documents").where("text is not null")
    right = F.substring("text", 3, 20)
    sections = docs.select("doc_id", F.lit(2).alias("char_start"), F.lit(22).alias("char_end"), F.when(F.col("doc_id") % 3 == 0, F.concat(right, F.lit("x" * 21))).otherwise(right).alias("section_text"))
    return ld.changed_slices(sections, docs, "doc_id").select("doc_id")


@query("""SELECT o_orderkey, u.c AS "column" FROM orders, (VALUES ('a', 2), ('b', 3)) u(c, k) WHERE o_orderkey % u.k = 0""")
def q13_missing_values(spark, d):
    key = F.col("o_orderkey")
    rows = read(spark, d, "orders").select("o_orderkey", F.when(key % 2 > 0, "x").alias("a"), F.when(key % 3 > 0, "y").otherwise("  ").alias("b"))
    return ld.missing_values(rows, "o_orderkey", ["a", "b"])


@query("""SELECT event_id FROM events WHERE user_id NOT IN (SELECT o_custkey FROM orders)""")
def u5_unclaimed_hits(spark, d):
    claimed = read(spark, d, "orders").select(F.col("o_custkey").alias("user_id"))
    return ld.unclaimed_hits(read(spark, d, "events").select("event_id", "user_id"), claimed, ["user_id"]).select("event_id")


# Rules, grounding -----------------------------------------------------------------------------------------------------


def _rules():
    return [
        r.parent_rule("orders_customer", "orders", "o_custkey", "customer", "c_custkey"),
        r.unique_rule("lineitem_key", "lineitem", ["l_orderkey", "l_linenumber"]),
        r.unique_rule("orders_per_customer", "orders", ["o_custkey"]),
        r.row_rule("discount", "discounts are below 8 %", "lineitem", F.col("l_discount") >= 0.08),
        r.one_value_rule("one_status", ["orders"], "o_orderstatus"),
    ]


@query("""SELECT rule, violations, violations = 0 AS ok FROM (
SELECT 'orders_customer' AS rule, count(*) AS violations FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem_key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders_per_customer', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)
UNION ALL SELECT 'discount', count(*) FROM lineitem WHERE l_discount >= 0.08
UNION ALL SELECT 'one_status', count(DISTINCT o_orderstatus) - 1 FROM orders)""")
def q_rule_report(spark, d):
    return r.report(_rules(), {n: read(spark, d, n) for n in ("orders", "customer", "lineitem")}).drop("description")


@query(f"""WITH {_RANGES} SELECT k, start, "end" FROM (SELECT *, max("end") OVER (PARTITION BY k ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM r) WHERE start < m""")
def w1_q9_overlap_rule(spark, d):
    return r.overlap_rule("overlap", "r", ["k"], "start", "end", ["end"]).violations({"r": _ranges(spark, d)}).select("k", "start", "end")


@query()
def e5_ground(spark, d):
    """A quote from the middle of every text: as it stands, reflowed, without white space, or with one letter altered."""
    docs = read(spark, d, "documents").where("text is not null").select("doc_id", "text", F.substring(F.col("text"), (F.length("text") / 2).cast("int") + 1, F.lit(60)).alias("q"))
    altered = F.concat(F.substring("q", 1, 30), F.lit("휘"), F.substring("q", 32, 29))
    kinds = [F.col("q"), F.regexp_replace("q", r"\s+", "\n  "), F.regexp_replace("q", r"\s+", ""), altered]
    return g.ground(docs.select("doc_id", "text", F.element_at(F.array(*kinds), (F.col("doc_id") % 4 + 1).cast("int")).alias("quote"))).select("doc_id", "quote", "place.*")


@query("""SELECT o_orderkey, o_orderkey % 2 = 0 AS numbers, o_orderkey % 3 = 0 AS negations FROM orders""")
def e6_guards(spark, d):
    key = F.col("o_orderkey")
    x = F.concat(F.lit("1,0"), key, F.lit(".50 없다"))
    y = F.concat(F.lit("10"), key, F.when(key % 2 == 0, ".5").otherwise(".51"), F.when(key % 3 == 0, " 없다").otherwise(" 있다"))
    padded = read(spark, d, "orders").select("o_orderkey", x.alias("x"), y.alias("y"))
    return padded.select("o_orderkey", g.same_numbers(F.col("x"), F.col("y")).alias("numbers"), g.same_negations(F.col("x"), F.col("y")).alias("negations"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 5 IN (0, 1) THEN 'FOUND' WHEN turn % 5 = 2 THEN 'NOT_FOUND' WHEN turn % 5 = 3 THEN 'MAYBE' END AS status, u.error, CASE turn % 5 WHEN 0 THEN 'OK' WHEN 2 THEN 'NOT_FOUND' END AS stored
FROM conversations, (VALUES (0, 'NO_EVIDENCE'), (1, 'NO_VALUE'), (1, 'NO_EVIDENCE'), (2, 'NO_REASON'), (3, 'BAD_STATUS'), (3, 'NO_REASON'), (4, 'NOT_AN_OBJECT')) u(kind, error) WHERE turn % 5 = kind""".replace("CASE turn % 5 WHEN 0 THEN 'OK' WHEN 2", "CASE turn % 5 WHEN 0 THEN 'OK' WHEN 1 THEN 'OK' WHEN 2"))
def e1_e2_replies(spark, d):
    kinds = ['```json\n{"status": "FOUND", "value": 1}\n```', '{"status": "FOUND"}', '{"status": "NOT_FOUND"}', '{"status": "MAYBE"}', "[1]"]
    reply = F.element_at(F.array(*map(F.lit, kinds)), (F.col("turn") % 5 + 1).cast("int"))
    rows = read(spark, d, "conversations").select("conv_id", "turn", g.parsed_reply(reply).alias("v")).withColumn("status", F.try_variant_get("v", "$.status", "string"))
    return rows.select("conv_id", "turn", "status", F.explode(g.reply_errors(F.col("v"))).alias("error"), g.result_status(F.col("status")).alias("stored"))


@query("""SELECT event_id, CASE WHEN k = 0 THEN 'FAILED' WHEN k = 1 THEN 'FAILED' WHEN k = 2 THEN 'FAILED' WHEN k = 3 THEN 'FAILED' WHEN k = 4 THEN 'FOUND' WHEN k = 5 THEN 'UNDETERMINED' WHEN k = 6 THEN 'NOT_FOUND' ELSE 'NOT_APPLICABLE' END AS status,
CASE k WHEN 0 THEN 'CALL_FAILED' WHEN 1 THEN 'PARSE_FAILED' WHEN 2 THEN 'SCHEMA_INVALID' WHEN 3 THEN 'EVIDENCE_NOT_LOCATED' WHEN 5 THEN 'SOURCE_SECTION_MISSING' WHEN 6 THEN 'NOT_IN_DOCUMENT' WHEN 7 THEN 'OUT_OF_SCOPE' END AS reason FROM (SELECT event_id, event_id % 8 AS k FROM events)""")
def e3_e12_e14_outcomes(spark, d):
    k = F.col("event_id") % 8
    status = F.when(k <= 4, "FOUND").when(k <= 6, "NOT_FOUND").otherwise("NOT_APPLICABLE")
    value = F.when(k == 2, '{"tiers": [{"period": 1}]}').otherwise('{"tiers": [{"period": "90", "basis": null, "rate": {"amount": 1.5, "unit": "%"}, "applies_to": null}]}')
    errors = F.when(status == "FOUND", cv.value_errors(F.lit("redemption_terms"), value, F.lit(1))).otherwise(F.array().cast("array<string>"))
    missing = F.when(k == 5, F.array(F.lit("제2부 11절"))).otherwise(F.array().cast("array<string>"))
    found = cv.outcome(F.when(k == 0, "timeout"), k != 1, errors, status, k != 3, missing, F.lit(1))
    return read(spark, d, "events").select("event_id", found.alias("o")).select("event_id", "o.*")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || ' x y' ELSE 'quoted' END AS value FROM customer""")
def e13_source_value(spark, d):
    value = F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, " x y").otherwise(" z"))
    return read(spark, d, "customer").select("c_custkey", cv.source_value(value, F.lit("quoted"), F.concat(F.lit("a\n"), "c_name", F.lit("\nxy"))).alias("value"))


_PHRASES = "p AS (SELECT l_orderkey AS document_id, l_linenumber * 10 AS start, l_linenumber * 10 + 8 AS \"end\", l_tax > 0.07 AS lost FROM lineitem), c AS (SELECT o_orderkey AS document_id, (o_orderkey % 50)::INT AS start, (o_orderkey % 50)::INT + 15 AS \"end\" FROM orders)"
_KEPT = "k AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.document_id = p.document_id AND p.start < c.\"end\" AND c.start < p.\"end\"))"


def _unclaimed(spark, d):
    n = F.col("l_linenumber") * 10
    phrases = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("document_id"), n.alias("start"), (n + 8).alias("end"), (F.col("l_tax") > 0.07).alias("lost")).distinct()
    at = (F.col("o_orderkey") % 50).cast("int")
    return cv.unclaimed(phrases, read(spark, d, "orders").select(F.col("o_orderkey").alias("document_id"), at.alias("start"), (at + 15).alias("end")), ["document_id"])


@query(f"""WITH {_PHRASES}, {_KEPT} SELECT DISTINCT document_id, start, "end", lost FROM k""")
def e15_unclaimed_phrases(spark, d):
    return _unclaimed(spark, d)[0]


@query(f"""WITH {_PHRASES}, {_KEPT} SELECT document_id, CASE WHEN bool_or(lost) THEN 'FAILED' ELSE 'NOT_FOUND' END AS status FROM p WHERE document_id NOT IN (SELECT document_id FROM k) GROUP BY document_id""")
def e15_emptied_documents(spark, d):
    return _unclaimed(spark, d)[1]


# Layout, matching, metrics ----------------------------------------------------------------------------------------------


@query(r"""SELECT doc_id, words, sentences, words / sentences AS asl FROM (SELECT doc_id, len(regexp_extract_all(text, '[^\s\x0B\x85\p{Z}]+'))::BIGINT AS words,
greatest(len(regexp_extract_all(text, '[.!?。](\s|$)')) - len(regexp_extract_all(text, '[0-9][.!?。](\s|$)')), 1)::BIGINT AS sentences FROM documents WHERE regexp_matches(text, '[^\s\x0B\x85\p{Z}]'))""")
def a22_sentence_length(spark, d):
    return mt.sentence_length(read(spark, d, "documents").where(F.col("text").rlike(r"(?U)\S")), "doc_id", "text")


@query("""SELECT doc_id, count(DISTINCT w) AS kinds, count(DISTINCT CASE WHEN length(w) > 9 THEN w END) AS hard_kinds, count(DISTINCT CASE WHEN length(w) > 9 THEN w END) / count(DISTINCT w) AS density
FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) GROUP BY doc_id""")
def a23_term_density(spark, d):
    tokens = read(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)).alias("w"))
    hard = tokens.where(F.length("w") > 9).select(F.col("w").alias("term")).distinct()
    return mt.term_density(tokens, "doc_id", "w", hard)


@query("""SELECT o_custkey, len(list_filter(['F', 'O', 'P'], lambda x: NOT list_contains(s, x))) / 3 AS missing FROM (SELECT o_custkey, list(DISTINCT o_orderstatus) AS s FROM orders GROUP BY o_custkey)""")
def a24_missing_share(spark, d):
    found = read(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s"))
    return found.select("o_custkey", mt.missing_share(F.col("s"), F.array(F.lit("F"), F.lit("O"), F.lit("P"))).alias("missing"))


@query("""SELECT c_custkey, w AS weight, w * c_acctbal + (1 - w) * c_nationkey AS score FROM customer, (VALUES (0.3::DOUBLE), (0.4), (0.5), (0.6), (0.7)) v(w)""")
def a26_sensitivity(spark, d):
    return mt.sensitivity(read(spark, d, "customer"), "c_custkey", "c_acctbal", "c_nationkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'CONFIRMED_ACTIVE' WHEN e <= b OR s > b THEN 'CONFIRMED_INACTIVE' WHEN s <= b AND b < e THEN 'CONFIRMED_ACTIVE' ELSE 'UNKNOWN' END AS status
FROM (SELECT o_orderkey, DATE '1997-01-01' AS b, o_orderdate::DATE AS s, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate::DATE + 300 END AS e FROM orders)""")
def x6_sale_status(spark, d):
    start = F.to_date("o_orderdate")
    end = F.when(F.col("o_orderkey") % 3 > 0, F.date_add(start, 300))
    return read(spark, d, "orders").select("o_orderkey", mc.sale_status(F.lit("1997-01-01").cast("date"), start, end, F.col("o_orderkey") % 5 == 0).alias("status"))


@query("""SELECT confidence, CASE confidence WHEN 'KRX_CONFIRMED' THEN true WHEN 'NOT_ETF' THEN false END AS is_etf, count(*) AS n FROM (
SELECT CASE WHEN p_size < 10 THEN 'KRX_CONFIRMED' WHEN p_size < 20 THEN 'NOT_ETF' WHEN p_size < 30 THEN 'NAME_ONLY' ELSE 'PENDING' END AS confidence FROM part) GROUP BY ALL""")
def x3_etf_confidence(spark, d):
    size = F.col("p_size")
    state = mc.etf_confidence(size < 10, size < 20, F.when(size < 30, "가상장지수").otherwise("x"))
    return read(spark, d, "part").select(state.alias("confidence")).groupBy("confidence", mc.is_etf(F.col("confidence")).alias("is_etf")).agg(F.count("*").alias("n"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN text IS NULL THEN 'NO_TEXT' WHEN length(text) < 500 THEN 'SHORT' WHEN lang <> 'en' THEN 'LANGUAGE' ELSE 'KEPT' END AS reason FROM documents) GROUP BY reason""")
def x8_exclusions(spark, d):
    reasons = [("NO_TEXT", F.col("text").isNull()), ("SHORT", F.length("text") < 500), ("LANGUAGE", F.col("lang") != "en")]
    kept, out = mc.exclusions(read(spark, d, "documents"), "doc_id", reasons)
    return out.select("reason").unionByName(kept.select(F.lit("KEPT").alias("reason"))).groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, 'PROSPECTUS' AS role, n_chars AS scope FROM documents UNION ALL SELECT doc_id, 'SIMPLE', 100 FROM documents WHERE n_chars > 1000""")
def x9_roles(spark, d):
    return mc.roles(read(spark, d, "documents").select("doc_id", "n_chars"), F.when(F.col("n_chars") > 1000, F.lit(100).cast("long")), F.col("n_chars")).drop("n_chars")


@query("""SELECT o_orderkey, u.item, CASE WHEN u.item = 'paid' THEN (CASE WHEN o_orderstatus = 'F' THEN 'MET' ELSE 'UNMET' END) ELSE (CASE WHEN o_orderstatus = 'P' THEN 'NOT_APPLICABLE' WHEN o_totalprice > 100000 THEN 'MET' ELSE 'UNDETERMINED' END) END AS verdict
FROM orders, (VALUES ('paid'), ('large')) u(item)""")
def x11_checklist(spark, d):
    items = {"paid": (F.lit(True), F.col("o_orderstatus") == "F"), "large": (F.col("o_orderstatus") != "P", F.when(F.col("o_totalprice") > 100000, True))}
    return mc.checklist(read(spark, d, "orders"), "o_orderkey", items)


@query("""SELECT c_custkey, (SELECT max(d) FROM (VALUES (DATE '1994-06-01'), (DATE '1996-01-01'), (DATE '1997-07-01')) v(d) WHERE d <= day)::VARCHAR AS edition FROM (SELECT o_custkey AS c_custkey, min(o_orderdate)::DATE AS day FROM orders GROUP BY o_custkey)""")
def x10_applicable_edition(spark, d):
    first = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.min("o_orderdate")).alias("day")).withColumn("form", F.lit("x"))
    editions = spark.createDataFrame([("x", "1994-06-01"), ("x", "1996-01-01"), ("x", "1997-07-01")], "form string, d string").select("form", F.col("d").cast("date").alias("since"))
    return j.newest_edition(first, editions, ["form"], "day", "since").select("c_custkey", F.col("since").cast("string").alias("edition"))


@query("""SELECT p_partkey, upper(p_brand) AS base, p_size::VARCHAR AS series FROM part""")
def p21_product_name(spark, d):
    names = read(spark, d, "part").select("p_partkey", F.concat(F.lit("(주) "), F.upper("p_brand"), F.lit(" 제"), F.col("p_size").cast("string"), F.lit("호 [주식형]")).alias("name"))
    return mc.product_name(names, "name").select("p_partkey", "base", "series")


@query("""SELECT l_orderkey % 50 AS page, b.box, min(i) AS start, max(i) + 1 AS "end" FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey % 50 ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) AS i FROM lineitem) l
JOIN (SELECT unnest(range(4)) AS box) b ON l_quantity >= b.box * 13 AND l_quantity < b.box * 13 + 10 AND l_tax * 1000 >= 0 AND l_tax * 1000 < 40 GROUP BY ALL""")
def t25_glyphs_in_boxes(spark, d):
    number = F.row_number().over(Window.partitionBy(F.col("l_orderkey") % 50).orderBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"))
    glyphs = read(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("page"), number.alias("idx"), F.col("l_quantity").alias("x0"), F.col("l_quantity").alias("x1"), (F.col("l_tax") * 1000).alias("top"), (F.col("l_tax") * 1000).alias("bottom"))
    boxes = spark.range(50).select(F.col("id").alias("page"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("box"))
    boxes = boxes.select("page", "box", (F.col("box") * 13.0).alias("x0"), F.lit(0.0).alias("top"), (F.col("box") * 13.0 + 10).alias("x1"), F.lit(40.0).alias("bottom"))
    return ly.glyphs_in_boxes(glyphs, boxes, ["page"], 7.0)


@query("""SELECT o_orderkey, 1 AS start, 6 + (o_orderkey % 2)::INT AS "end", o_orderkey % 2 = 1 AS has_sentences FROM orders""")
def t18_table_blocks(spark, d):
    tables = read(spark, d, "orders").select("o_orderkey", F.lit("x표이다 다. 끝").alias("text"), F.lit(1).alias("start"), (6 + F.col("o_orderkey") % 2).cast("int").alias("end"))
    return ly.table_blocks(tables, "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, (l_linenumber * 10)::INT AS start FROM lineitem WHERE l_orderkey % 3 > 0 AND l_linenumber * 10 >= 20 AND l_linenumber * 10 < 20 + l_orderkey % 40""")
def t21_label_blocks(spark, d):
    cells = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_linenumber") * 10).cast("int").alias("start"))
    key = F.col("o_orderkey")
    sections = read(spark, d, "orders").select(key.alias("l_orderkey"), F.when(key % 3 > 0, "summary").otherwise("body").alias("kind"), F.lit(20).alias("start"), (20 + key % 40).cast("int").alias("end"))
    return ly.label_blocks(cells, sections, "l_orderkey")


@query("""SELECT c_custkey, 0 AS start, 5 AS "end", c_custkey % 2 = 0 AS bold, CASE WHEN c_custkey % 2 = 0 THEN 'font' END AS bold_method, '#ff0000' AS color FROM customer""")
def t22_emphasis_blocks(spark, d):
    runs = read(spark, d, "customer").select("c_custkey", F.lit(0).alias("start"), F.lit(5).alias("end"), F.when(F.col("c_custkey") % 2 == 0, "font").alias("bold_method"), F.lit("#ff0000").alias("color"))
    return ly.emphasis_blocks(runs, "c_custkey")


@query("""SELECT count(*) AS docs, sum(p_partkey % 3) / sum(3) AS part_recall, sum(p_partkey % 3) / sum(4) AS part_precision, sum(p_size) / sum(p_size + 5) AS section_recall, sum(p_size) / sum(p_size * 2) AS section_precision FROM part""")
def a6_bookmark_recall(spark, d):
    k = F.col("p_size")
    counts = read(spark, d, "part").select((F.col("p_partkey") % 3).alias("matched_parts"), F.lit(3).alias("bookmark_parts"), F.lit(4).alias("rule_parts"), k.alias("matched_sections"), (k + 5).alias("bookmark_sections"), (k * 2).alias("rule_sections"))
    return ly.bookmark_recall(counts)


@query("""SELECT event_type || ':' || CASE WHEN user_id % 2 = 0 THEN user_id::VARCHAR ELSE '-' END AS key, count(*) AS n FROM events GROUP BY 1""")
def a11_joint_counts(spark, d):
    return a.joint_counts(read(spark, d, "events"), F.col("event_type"), F.when(F.col("user_id") % 2 == 0, F.col("user_id")))


@query("""SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey""")
def a14_first_of_each(spark, d):
    return a.first_of_each(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], "o_orderkey")


# Collecting over a transport -----------------------------------------------------------------------------------------


class Replies:
    """A transport without a network: what it answers depends on the parameters and on how often it was asked for them."""

    def __init__(self) -> None:
        self.asked: Counter[str] = Counter()

    def __call__(self, endpoint: str, params: dict[str, str]) -> tuple[int, bytes]:
        key = json.dumps(params, sort_keys=True)
        self.asked[key] += 1
        return getattr(self, endpoint)(params, self.asked[key])

    def single(self, params: dict[str, str], n: int) -> tuple[int, bytes]:
        kind = int(params["id"]) % 6
        if kind == 3:
            raise TimeoutError
        status = {0: 200, 1: 200 if n > 2 else 503, 2: 404, 4: 401, 5: 429}[kind]
        return status, f"token-7 of {params['id']}".encode()

    def paged(self, params: dict[str, str], n: int) -> tuple[int, bytes]:
        day, page = int(params["bgn_de"]), int(params["page_no"])
        if day % 5 == 4:
            return 200, b'{"status": "013"}'
        if day % 7 == 3 and page == 2:
            return 200, b'{"status": "020"}'
        return 200, json.dumps({"status": "000", "total_page": day % 4 + 1, "list": [{"no": k} for k in range(day % 3 + 1)]}).encode()


def _fetched(spark, d):
    id_ = F.col("c_custkey").cast("string")
    requests = read(spark, d, "customer").select(id_.alias("request_key"), F.lit("single").alias("endpoint"), F.create_map(F.lit("id"), id_).alias("params"))
    requests = requests.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "request_key")  # a small file is one partition, however many rows it has
    return co.fetched(requests, Replies, secret="token-7", backoff=0.0, interval=0.0)


@query("""SELECT c_custkey::VARCHAR AS request_key, CASE c_custkey % 6 WHEN 2 THEN 'PERMANENT_FAILED' WHEN 3 THEN 'RETRYABLE_FAILED' WHEN 4 THEN 'CONFIG_ERROR' WHEN 5 THEN 'RATE_LIMITED' ELSE 'SUCCESS' END AS outcome,
CASE c_custkey % 6 WHEN 1 THEN 3 WHEN 3 THEN 6 ELSE 1 END AS n, CASE WHEN c_custkey % 6 < 2 THEN '*** of ' || c_custkey END AS body FROM customer""")
def s6_s7_fetched(spark, d):
    return _fetched(spark, d).select("request_key", "outcome", F.size("tries").alias("n"), F.col("content").cast("string").alias("body"))


@query("""SELECT c_custkey::VARCHAR AS request_key, n::INT AS attempt_no, CASE WHEN c_custkey % 6 = 0 OR (c_custkey % 6 = 1 AND n = 3) THEN 200 WHEN c_custkey % 6 = 1 THEN 503 WHEN c_custkey % 6 = 2 THEN 404 WHEN c_custkey % 6 = 4 THEN 401 WHEN c_custkey % 6 = 5 THEN 429 END AS http_status,
CASE WHEN c_custkey % 12 = 0 THEN 'EMPTY' WHEN c_custkey % 6 = 0 OR (c_custkey % 6 = 1 AND n = 3) THEN 'SUCCESS' WHEN c_custkey % 6 IN (1, 3) THEN 'RETRYABLE_FAILED' WHEN c_custkey % 6 = 2 THEN 'PERMANENT_FAILED' WHEN c_custkey % 6 = 4 THEN 'CONFIG_ERROR' ELSE 'RATE_LIMITED' END AS outcome,
CASE WHEN c_custkey % 12 = 0 THEN 'no rows' WHEN c_custkey % 6 = 0 OR (c_custkey % 6 = 1 AND n = 3) THEN NULL WHEN c_custkey % 6 = 1 THEN 'HTTP 503' WHEN c_custkey % 6 = 2 THEN 'HTTP 404' WHEN c_custkey % 6 = 3 THEN 'TimeoutError' WHEN c_custkey % 6 = 4 THEN 'HTTP 401' ELSE 'HTTP 429' END AS error_reason,
n = CASE c_custkey % 6 WHEN 1 THEN 3 WHEN 3 THEN 6 ELSE 1 END AS is_last FROM customer, range(1, 7) t(n) WHERE n <= CASE c_custkey % 6 WHEN 1 THEN 3 WHEN 3 THEN 6 ELSE 1 END""")
def k4_attempt_rows(spark, d):
    empty = F.col("request_key").cast("long") % 12 == 0
    return co.attempt_rows(_fetched(spark, d), ("request_key",), F.when(empty, "EMPTY"), F.when(empty, "no rows"))


@query("""SELECT o AS outcome, (SELECT count(*) FROM customer WHERE CASE c_custkey % 6 WHEN 2 THEN 'PERMANENT_FAILED' WHEN 3 THEN 'RETRYABLE_FAILED' WHEN 4 THEN 'CONFIG_ERROR' WHEN 5 THEN 'RATE_LIMITED' ELSE 'SUCCESS' END = o) AS n
FROM (VALUES ('SUCCESS'), ('EMPTY'), ('RETRYABLE_FAILED'), ('RATE_LIMITED'), ('CONFIG_ERROR'), ('PERMANENT_FAILED')) v(o)""")
def a21_outcome_counts(spark, d):
    nothing = F.lit(None).cast("string")
    return co.outcome_counts(co.attempt_rows(_fetched(spark, d), ("request_key",), nothing, nothing))


@query("""SELECT o_custkey::VARCHAR AS day, CASE WHEN o_custkey % 5 <> 4 AND o_custkey % 7 = 3 AND o_custkey % 4 > 0 THEN 'RATE_LIMITED' ELSE 'SUCCESS' END AS outcome,
CASE WHEN o_custkey % 5 = 4 THEN 0 WHEN o_custkey % 7 = 3 THEN o_custkey % 3 + 1 ELSE (o_custkey % 3 + 1) * (o_custkey % 4 + 1) END AS rows FROM (SELECT DISTINCT o_custkey FROM orders)""")
def s1_listed_days(spark, d):
    days = read(spark, d, "orders").select(F.col("o_custkey").alias("day")).distinct()
    return co.day_outcomes(co.listed_days(days, Replies, "paged", {}, ("bgn_de", "end_de"), backoff=0.0, interval=0.0))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'EMPTY_BODY' WHEN 1 THEN 'NOT_A_ZIP' WHEN 2 THEN 'NOT_A_PDF' WHEN 3 THEN 'NO_NODES' END AS problem FROM part""")
def s2_body_problem(spark, d):
    k = F.col("p_partkey") % 5
    role = F.when(k <= 1, "cover_xml").when(k == 3, "viewer_tree").otherwise("body_pdf")
    body = F.when(k == 0, "").when(k == 4, "%PDF-1.7").otherwise(F.concat(F.lit("%PDF"), F.col("p_name")))
    return read(spark, d, "part").select("p_partkey", co.body_problem(role, body.cast("binary"), F.lit(0)).alias("problem"))


@query("""SELECT user_id, 'https://x' AS endpoint, map_keys(m)[1] AS kept, len(map_keys(m)) AS n FROM (SELECT user_id, MAP {'page': count(*)} AS m FROM events GROUP BY user_id)""")
def s6_redacted(spark, d):
    params = F.create_map(F.lit("crtfc_key"), F.lit("k"), F.lit("page"), F.count("*").cast("string"))
    left = F.map_keys(co.redacted(F.col("p")))
    return read(spark, d, "events").groupBy("user_id").agg(params.alias("p")).select("user_id", F.lit("https://x").alias("endpoint"), left[0].alias("kept"), F.size(left).cast("long").alias("n"))


@query("""SELECT p_brand, sha256('text of ' || p_brand) AS sha256, strlen('text of ' || p_brand) AS size, count(*) AS listed FROM part GROUP BY p_brand""")
def s16_stored_once(spark, d):
    return co.stored_once(read(spark, d, "part").select("p_brand", F.concat(F.lit("text of "), "p_brand").cast("binary").alias("content")), "p_brand", "content")


@query("""SELECT n_nationkey, n_name AS name, k::INT AS k FROM nation, range(2) t(k)""")
def s18_daily_items(spark, d):
    item = lambda k: F.struct(F.col("n_name").alias("name"), F.lit(k).alias("k"))
    reply = F.to_json(F.struct(F.array(item(0), item(1)).alias("OutBlock_1")))
    return read(spark, d, "nation").select("n_nationkey", F.inline(co.daily_items(reply, "struct<name:string,k:int>")))


@query("""SELECT n_nationkey, unnest(range(2, (n_nationkey * 7 + 9) // 10 + 1))::INT AS page FROM nation""")
def s17_pages_left(spark, d):
    return read(spark, d, "nation").select("n_nationkey", F.explode(co.pages_left(F.col("n_nationkey") * 7, F.lit(1), 10)).alias("page"))


# Asking a model ------------------------------------------------------------------------------------------------------


@query("""SELECT c_custkey, f AS field_name, c_custkey % 3 = 0 AND f = 'redemption_terms' AS excluded FROM customer, (VALUES ('principal_loss_notice'), ('key_risk_phrases'), ('fee_structure'), ('redemption_terms')) v(f)""")
def e17_field_inputs(spark, d):
    asked, left_out = rp.field_inputs(read(spark, d, "customer").select("c_custkey"), F.col("c_custkey") % 3 == 0)
    return asked.withColumn("excluded", F.lit(False)).unionByName(left_out.withColumn("excluded", F.lit(True)))


@query("""SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) [1] AS least, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1""")
def a17_mixed_sources(spark, d):
    return rp.mixed_sources(read(spark, d, "lineitem"), "l_orderkey", "l_suppkey").select("l_orderkey", F.col("sources")[0].alias("least"), F.size("sources").cast("long").alias("n"))


@query("""SELECT o_orderkey, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' AND c_nationkey IN (1, 2, 3)""")
def j4_s13_section_inputs(spark, d):
    sections = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("raw_object_id"), F.col("o_orderstatus").alias("parser_version"))
    objects = read(spark, d, "customer").select(F.col("c_custkey").alias("raw_object_id"), F.col("c_nationkey").alias("document_id"))
    return rp.section_inputs(sections, objects, [1, 2, 3], "F").select("o_orderkey", F.col("document_id").alias("c_nationkey"))


@query("""WITH a AS (SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'OK' ELSE 'FAILED' END AS s, o_orderkey % 2 = 0 AS located FROM orders),
p AS (SELECT o_custkey, arg_max(o_orderkey, (s <> 'FAILED', o_orderkey)) AS id FROM a WHERE s = 'OK' OR located GROUP BY o_custkey)
SELECT c_custkey, id AS extraction_id, CASE WHEN c_custkey % 4 = 0 THEN 'NO_INPUT' WHEN id IS NOT NULL AND id % 3 > 0 THEN 'REUSE' ELSE 'CALL' END AS plan,
id IS NOT NULL AND id % 3 = 0 AND c_custkey % 4 > 0 AS prior_missing FROM customer LEFT JOIN p ON c_custkey = o_custkey""")
def e18_planned(spark, d):
    path, same = F.col("o_orderkey").cast("string"), [F.lit("x").alias(k) for k in rp.PRIOR_KEYS[1:]]
    status = F.when(F.col("o_orderstatus") == "F", "OK").otherwise("FAILED")
    reason = F.when(F.col("o_orderkey") % 2 == 0, "EVIDENCE_NOT_LOCATED").otherwise("CALL_FAILED")
    orders = read(spark, d, "orders")
    attempts = orders.select(F.col("o_custkey").alias("document_id"), *same, F.col("o_orderkey").alias("extraction_id"), F.lit("r").alias("run_id"), status.alias("result_status"), reason.alias("error_reason"), path.alias("raw_response_path"), F.sha2(path, 256).alias("response_sha256"))
    files = orders.where("o_orderkey % 3 > 0 or o_orderkey % 2 > 0").select(path.alias("raw_response_path"), F.when(F.col("o_orderkey") % 3 > 0, path).otherwise("changed").cast("binary").alias("content"))
    wanted = rp.prior_replies(read(spark, d, "customer").select(F.col("c_custkey").alias("document_id"), *same), attempts)
    found = rp.planned(wanted, files, F.col("document_id") % 4)
    return found.select(F.col("document_id").alias("c_custkey"), "prior.extraction_id", "plan", "prior_missing")


def _asked(spark, d):
    def client():
        times = Counter()

        def converse(prompt: str, text: str) -> tuple[str | None, str | None]:
            times[text] += 1
            return (None, "timeout") if int(text) % 3 == 0 or (int(text) % 3 == 1 and times[text] == 1) else (prompt, None)

        return converse

    wanted = read(spark, d, "customer").select(F.col("c_custkey").alias("document_id"), F.lit("f").alias("field_name"), F.lit("p").alias("prompt"), F.col("c_custkey").cast("string").alias("input_text"))
    return rp.asked(wanted, client, lambda reply, error: ("FAILED", "CALL_FAILED") if error else ("OK", None))


@query("""SELECT c_custkey AS document_id, 'f' AS field_name, n::INT AS attempt_no, CASE WHEN ok THEN 'p' END AS reply, CASE WHEN ok THEN 'OK' ELSE 'FAILED' END AS result_status, CASE WHEN NOT ok THEN 'CALL_FAILED' END AS error_reason
FROM (SELECT c_custkey, n, c_custkey % 3 = 2 OR (c_custkey % 3 = 1 AND n = 2) AS ok FROM customer, range(1, 3) t(n) WHERE c_custkey % 3 < 2 OR n = 1)""")
def e19_asked(spark, d):
    return _asked(spark, d)


@query("""SELECT c_custkey AS document_id, n::INT AS attempt_no, n = CASE WHEN c_custkey % 3 = 2 THEN 1 ELSE 2 END AS is_selected FROM customer, range(1, 3) t(n) WHERE c_custkey % 3 < 2 OR n = 1""")
def k10_selected(spark, d):
    return rp.selected(_asked(spark, d), ("document_id", "field_name")).select("document_id", "attempt_no", "is_selected")


@query("""SELECT event_id, unnest(CASE event_id % 8 WHEN 1 THEN ['STATUS'] WHEN 2 THEN ['CONTRACT_VERSION', 'REASON_CODE'] WHEN 3 THEN ['EVIDENCE'] WHEN 4 THEN ['VALUE_NOT_NULL', 'EVIDENCE_NOT_EMPTY'] WHEN 5 THEN ['CHECKED_SECTIONS'] WHEN 6 THEN ['RAW_TEXT', 'VALUE'] WHEN 7 THEN ['1 pieces of evidence for 2'] ELSE []::VARCHAR[] END) AS problem FROM events""")
def e16_envelope_problems(spark, d):
    k = F.col("event_id") % 8
    piece = lambda n: F.struct(F.lit(1).alias("section_id"), F.lit(0).alias("char_start"), F.lit(n).alias("char_end"), F.lit("q").alias("quote"))
    found, none = ~k.isin(4, 5), F.lit(None).cast("string")
    rows = read(spark, d, "events").select(
        "event_id", F.when(k == 1, "LOST").when(k == 4, "UNDETERMINED").when(k == 5, "NOT_FOUND").otherwise("FOUND").alias("status"),
        F.when(k == 2, 2).otherwise(1).alias("contract_version"), F.lit("key_risk_phrases").alias("field_name"),
        F.when(k == 2, "AMBIGUOUS").when(k == 4, "AMBIGUOUS").when(k == 5, "NOT_IN_DOCUMENT").alias("reason_code"),
        F.when(k == 6, none).when(k == 7, '["a", "b"]').when(found | (k == 4), '["a"]').alias("value"), F.when(found & (k != 6), "a").alias("raw_text"),
        F.when(k == 5, F.array().cast("array<struct<section_id:int,char_start:int,char_end:int,quote:string>>")).when(k == 3, F.array(piece(0))).otherwise(F.array(piece(1))).alias("evidence"),
        F.array().cast("array<int>").alias("checked_section_ids"),
    )
    return rp.envelope_problems(rows).select("event_id", F.explode("problems").alias("problem"))


@query("""SELECT c_custkey AS document_id, 'f' AS field_name, CASE WHEN p <> 'SELECTED' THEN 1 END AS attempt_no, p AS problem FROM (SELECT c_custkey, CASE c_custkey % 7 WHEN 1 THEN 'INPUT_SHA256' WHEN 2 THEN 'EVIDENCE_COLUMNS' WHEN 3 THEN 'NO_REASON' WHEN 4 THEN 'RESPONSE_SHA256' WHEN 5 THEN 'FOREIGN_INPUT' WHEN 6 THEN 'SELECTED' END AS p FROM customer) WHERE p IS NOT NULL""")
def q15_run_problems(spark, d):
    id_, k = F.col("c_custkey"), F.col("c_custkey") % 7
    name = id_.cast("string")
    keys = [id_.alias("document_id"), F.lit("f").alias("field_name"), F.lit(1).alias("attempt_no")]
    rows = read(spark, d, "customer")
    evidence = F.array(F.struct(F.lit(1).alias("section_id"), F.lit(0).alias("char_start"), F.lit(5).alias("char_end")))
    attempts = rows.select(
        *keys, F.when(k == 3, "FAILED").otherwise("OK").alias("result_status"), F.lit(None).cast("string").alias("error_reason"), F.sha2(name, 256).alias("input_sha256"), name.alias("raw_response_path"),
        F.sha2(name, 256).alias("response_sha256"), (k != 6).alias("is_selected"), evidence.alias("evidence"), F.lit(1).alias("evidence_section_id"), F.when(k == 2, 1).otherwise(0).alias("evidence_char_start"), F.lit(5).alias("evidence_char_end"),
    )
    requests = rows.select(*keys, F.when(k == 1, "other").otherwise(name).alias("input_text"), F.sha2(name, 256).alias("stated_sha256"), F.array(id_).alias("raw_object_ids"))
    files = rows.where(k != 4).select(name.alias("raw_response_path"), name.cast("binary").alias("content"))
    objects = rows.select(id_.alias("raw_object_id"), F.when(k == 5, -1).otherwise(id_).alias("document_id"))
    return rp.run_problems(attempts, requests, files, objects)


# Names, standards and runs -------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT p_partkey, upper(replace(p_name, ' ', '')) AS v FROM part), n AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN v || '증권' WHEN 1 THEN 'X' || v WHEN 2 THEN v || 'X' ELSE v END AS t FROM supplier JOIN l ON s_suppkey = p_partkey),
h AS (SELECT p_partkey, count(DISTINCT s_suppkey) AS n, min(s_suppkey) AS fund FROM l JOIN n ON contains(t, v) AND regexp_matches(substr(t, strpos(t, v) + length(v)), '^(증권|$)') GROUP BY p_partkey)
SELECT p_partkey AS code, CASE WHEN n = 1 THEN 'MATCHED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'NO_CANDIDATE' END AS status, coalesce(n, 0) AS n, CASE WHEN n = 1 THEN fund END AS fund FROM part LEFT JOIN h USING (p_partkey)""")
def j14_rematched(spark, d):
    listed = read(spark, d, "part").select(F.col("p_partkey").alias("code"), F.col("p_name").alias("name"))
    k = F.col("s_suppkey") % 4
    named = F.when(k == 0, F.concat("name", F.lit("증권"))).when(k == 1, F.concat(F.lit("x"), "name")).when(k == 2, F.concat("name", F.lit("x"))).otherwise(F.col("name"))
    funds = read(spark, d, "supplier").join(listed, F.col("s_suppkey") == F.col("code")).select(F.col("s_suppkey").alias("fund"), named.alias("name"))
    return rm.rematched(listed, funds)


@query()
def j15_similar(spark, d):
    parts = read(spark, d, "part").select("p_partkey", "p_brand", "p_type", rm.core_name(F.col("p_name")).alias("core"))
    listed, funds = parts.where("p_partkey % 2 = 0"), parts.where("p_partkey % 2 = 1")
    return rm.similar(listed.withColumnRenamed("p_partkey", "code"), funds.withColumnRenamed("p_partkey", "fund"), ["p_brand", "p_type"], 0.6, 0.05)


@query("""SELECT *, CASE WHEN miss_rate >= 0.01 THEN 'REDESIGN' WHEN false_high >= 0.01 THEN 'LIST_DECIDES' ELSE 'KEEP' END AS verdict FROM (SELECT listed, matched, missed, hits, leftover, missed / matched AS miss_rate, leftover / hits AS false_high, greatest(leftover - (listed - matched), 0) / hits AS false_low
FROM (SELECT count(*) AS listed, count_if(c_nationkey > 2) AS matched, count_if(c_nationkey > 2 AND c_custkey % 40 = 0) AS missed FROM customer), (SELECT count(*) AS hits, count_if(o_orderstatus = 'F') AS leftover FROM orders))""")
def a20_rule_bounds(spark, d):
    listed = read(spark, d, "customer").select((F.col("c_nationkey") > 2).alias("matched"), (F.col("c_custkey") % 40 == 0).alias("missed"))
    return rm.rule_bounds(listed, read(spark, d, "orders").select((F.col("o_orderstatus") != "F").alias("claimed")))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'CLAIMED' WHEN o_orderdate > DATE '1997-01-01' THEN 'PENDING' ELSE 'FALSE_POSITIVE' END AS status FROM orders""")
def x4_unclaimed_status(spark, d):
    return read(spark, d, "orders").select("o_orderkey", rm.unclaimed_status(F.col("o_orderstatus") == "O", F.col("o_orderdate"), F.lit("1997-01-01").cast("date")).alias("status"))


@query("""SELECT c_custkey, n_nationkey % 6 AS fund_grade, CASE WHEN c_custkey % 6 <> n_nationkey % 6 THEN 'CLASS_GRADE_MISMATCH' END AS flag FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def x7_grade_flags(spark, d):
    classes = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"), (F.col("c_custkey") % 6).alias("grade"))
    funds = read(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") % 6).alias("grade"))
    return rm.grade_flags(classes, funds, "k").select("c_custkey", "fund_grade", "flag")


@query("""SELECT reason, retry, counts, count(*) AS n, count_if(due) AS due FROM (SELECT *, CASE retry WHEN 'DAILY_FOR_30_DAYS' THEN age BETWEEN 1 AND 30 WHEN 'WEEKLY' THEN age > 0 AND age % 7 = 0 WHEN 'WITH_EXTRACTION' THEN true WHEN 'WITH_MASTER' THEN false ELSE false END AS due FROM (
SELECT r.*, datediff('day', o_orderdate::DATE, DATE '1995-03-15') AS age FROM orders JOIN (VALUES (0, 'PENDING_MASTER', 'DAILY_FOR_30_DAYS', true), (1, 'AMBIGUOUS', 'BY_HAND', true), (2, 'NO_CANDIDATE', 'WEEKLY', true), (3, 'NO_CODE_IN_SOURCE', 'NEVER', true), (4, 'BELOW_THRESHOLD', 'NEVER', true),
(5, 'NORMALIZE_FAILED', 'WITH_EXTRACTION', true), (6, 'CLASS_GRADE_MISMATCH', 'NEVER', true), (7, 'OUT_OF_SCOPE_SECTOR', 'NEVER', false), (8, 'NOT_IN_MASTER', 'WITH_MASTER', false)) r(k, reason, retry, counts) ON o_orderkey % 10 = r.k)) GROUP BY ALL""")
def x17_failure_log(spark, d):
    reason = F.get(F.array(*map(F.lit, rm.RETRY)), (F.col("o_orderkey") % 10).cast("int"))
    log = rm.failure_log(read(spark, d, "orders").select("o_orderkey", "o_orderdate"), reason, F.col("o_orderdate").cast("date"))
    again = rm.due(log, F.lit("1995-03-15").cast("date"), F.lit(True), F.lit(False)).select("o_orderkey", F.lit(True).alias("due"))
    return log.join(again, "o_orderkey", "left").groupBy("reason", "retry", "counts").agg(F.count("*").alias("n"), F.count_if("due").alias("due"))


_ITEMS = ("a", "b", "c", "d")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'MET' ELSE 'UNMET' END AS status, CASE c_custkey % 4 WHEN 1 THEN 3 WHEN 3 THEN 0 ELSE 4 END AS found, 4 AS required, CASE c_custkey % 4 WHEN 1 THEN 'c' WHEN 3 THEN 'a,b,c,d' ELSE '' END AS missing, CASE c_custkey % 4 WHEN 2 THEN 'b,c' ELSE '' END AS moved,
CASE c_custkey % 4 WHEN 3 THEN 'UNMET' ELSE 'MET' END AS place FROM customer""")
def x12_standard_difference(spark, d):
    k = F.col("c_custkey") % 4
    items = lambda s: F.array(*map(F.lit, s)) if s else F.array().cast("array<string>")
    found = F.when(k == 0, items("axbcd")).when(k == 1, items("abd")).when(k == 2, items("acbd")).otherwise(items(""))
    rows = read(spark, d, "customer").select("c_custkey", sd.standard_difference(items(_ITEMS), found).alias("d"), sd.position_check(found, "a", 1).alias("place"))
    return rows.select("c_custkey", "d.status", "d.found", "d.required", F.array_join("d.missing_items", ",").alias("missing"), F.array_join("d.order_differs_items", ",").alias("moved"), "place")


@query("""SELECT c_custkey, sha256('{"anchor":' || c_custkey || ',"contract_version":3,"selection_policy_version":"v1","target_type":"FUND"}') AS target_key FROM customer""")
def x13_target_key(spark, d):
    return read(spark, d, "customer").select("c_custkey", sd.target_key(F.lit("FUND"), F.col("c_custkey"), F.lit("v1")).alias("target_key"))


@query("""SELECT n_nationkey, '{"part_a_disclosure":{"items":[{"item_key":"' || n_name || '","status":"MET"}]},"part_b_readability":{"axes":[{"axis":1,"result":{"status":"OK","value":' || n_nationkey || ',"reason":null}}],"metric_key":"m","weights_version":"w","result":{"status":"OK","value":1,"reason":null},"normalization":null,"fix_locations":[]},"drafting_standard_check":{"prospectus":null,"summary_prospectus":null}}' AS envelope FROM nation""")
def x15_dashboard_envelope(spark, d):
    none, ok = F.lit(None).cast("string"), F.lit("OK")
    items = F.array(F.struct(F.col("n_name").alias("item_key"), F.lit("MET").alias("status")))
    axes = F.array(F.struct(F.lit(1).alias("axis"), sd.result(ok, F.col("n_nationkey"), none).alias("result")))
    empty = F.array().cast("array<string>")
    whole = sd.dashboard_envelope(items, axes, F.lit("m"), F.lit("w"), sd.result(ok, F.lit(1), none), none, empty, none, none)
    return read(spark, d, "nation").select("n_nationkey", whole.alias("envelope"))


@query("""SELECT source, count(*) AS sections, count_if(both_) AS shared, count_if(both_) / count(*) AS rate FROM (SELECT source, min(source) OVER (PARTITION BY text) <> max(source) OVER (PARTITION BY text) AS both_ FROM (SELECT source, regexp_replace(text, '[\\s\\x0B\\x85\\p{Z}]', '', 'g') AS text FROM documents WHERE text IS NOT NULL)) GROUP BY source""")
def x16_shared_sections(spark, d):
    return sd.shared_sections(read(spark, d, "documents"), "source", "text")


@query("""SELECT event_type, count_if(event_id % 5 = 0 AND user_id <= 50) AS late FROM events GROUP BY event_type""")
def m3_late_arrivals(spark, d):
    events = read(spark, d, "events")
    marks = events.select("event_type").distinct().withColumn("watermark", F.lit(50))
    return st.late_arrivals(events.where("event_id % 5 = 0").select("event_type", "user_id"), marks, "event_type", "user_id")


@query("""SELECT o_orderkey AS run_id, o_orderdate AS started_at FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def o2_j8_newest_run(spark, d):
    runs = read(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"))
    return st.newest_run(runs, read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("created_run_id")))


@query("""SELECT max(lpad(o_orderkey::VARCHAR, 9, '0')) AS run_id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey % 2 = 1 AND o_orderstatus = 'F'""")
def s11_picked_run(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "SUCCEEDED").otherwise("FAILED")
    runs = read(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("run_id"), F.col("o_orderpriority").alias("parser_version"), F.when(F.col("o_custkey") % 2 == 0, 10).alias("limit"), status.alias("status"))
    return ld.picked_run(runs, "1-URGENT")


@query("""SELECT 'orders' AS "table", (SELECT count(*) FROM orders) AS loaded, (SELECT count(*) + 1 FROM orders) AS expected UNION ALL SELECT 'gone', NULL, 3""")
def q1_count_differences(spark, d):
    orders, nation = read(spark, d, "orders"), read(spark, d, "nation")
    expected = orders.agg((F.count("*") + 1).alias("expected")).select(F.lit("orders").alias("table"), "expected")
    expected = expected.unionByName(nation.agg(F.count("*").alias("expected")).select(F.lit("nation").alias("table"), "expected")).unionByName(spark.createDataFrame([("gone", 3)], "table string, expected long"))
    return ld.count_differences({"orders": orders, "nation": nation}, expected)


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND (o_orderkey % 5 = 0 OR o_orderkey % 7 = 0)""")
def q11_unwanted_manifests(spark, d):
    k, kind = F.col("o_orderkey"), F.when(F.col("o_orderstatus") == "O", "EXTRACT").otherwise("SCORE")
    runs = read(spark, d, "orders").select("o_orderkey", kind.alias("run_kind"), F.when(k % 5 == 0, "p").alias("selection_manifest_path"), F.when(k % 7 == 0, "s").alias("selection_manifest_sha256"))
    return ld.unwanted_manifests(runs).select("o_orderkey")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, (row_number() OVER (PARTITION BY l_orderkey ORDER BY floor(l_quantity / 3), l_linenumber, l_quantity, l_suppkey, l_partkey) - 1)::INT AS idx FROM lineitem""")
def t28_reading_order(spark, d):
    glyphs = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", F.col("l_quantity").alias("top"), F.col("l_linenumber").alias("x0"), F.struct("l_suppkey", "l_partkey").alias("x1"))
    return ly.reading_order(glyphs, ["l_orderkey"]).drop("top", "x0", "x1")


@query("""SELECT c_custkey, 1 AS box, 1 AS start, 9 AS "end", 'b c ' || 'fg' AS label FROM customer""")
def t26_cell_labels(spark, d):
    rows = read(spark, d, "customer").select("c_custkey")
    hits = rows.select("c_custkey", F.lit(1).alias("box"), F.explode(F.array(*map(F.lit, (1, 3, 7, 8)))).alias("idx"))
    return ly.cell_labels(hits, rows.withColumn("text", F.lit("ab cd\nefgh\n")), ["c_custkey"])


@query("""WITH s AS (SELECT o_custkey, count_if(o_orderstatus <> 'P' AND o_orderkey % 3 > 0 AND o_orderkey % 2 = 0) AS body_found, count_if(o_orderstatus <> 'P' AND o_orderkey % 3 > 0 AND o_orderkey % 2 > 0) AS body_only,
count_if(o_orderstatus = 'F' AND o_orderkey % 3 > 0) AS short_text, 0 AS broken_chars, bool_or(o_orderstatus = 'P') AS has_summary FROM orders GROUP BY o_custkey), b AS (SELECT user_id, count(*) AS blocks, count_if(event_type = 'click') AS tables, count_if(event_type = 'click' AND event_id % 2 = 0) AS tables_with_sentences, 4 * count_if(event_type = 'click') AS table_chars FROM events GROUP BY user_id)
SELECT o_custkey, body_found, body_only, short_text, broken_chars, has_summary, blocks, coalesce(tables, 0) AS tables, coalesce(tables_with_sentences, 0) AS tables_with_sentences, coalesce(table_chars, 0) AS table_chars FROM s LEFT JOIN b ON o_custkey = user_id""")
def a8_document_digest(spark, d):
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    flags = F.when(status == "F", F.array(F.lit("SHORT_TEXT"))).otherwise(F.array().cast("array<string>"))
    sections = read(spark, d, "orders").select("o_custkey", F.when(status == "P", "summary").otherwise("body").alias("section_kind"), F.when(k % 3 > 0, 1).alias("char_start"), (k % 2 == 0).alias("in_toc"), flags.alias("quality_flags"))
    kind = F.when(F.col("event_type") == "click", "table").otherwise(F.col("event_type"))
    blocks = read(spark, d, "events").select(F.col("user_id").alias("o_custkey"), kind.alias("kind"), F.lit(1).alias("start"), F.lit(5).alias("end"), (F.col("event_id") % 2 == 0).alias("has_sentences"))
    blocks_of = F.aggregate(F.map_values("block_counts"), F.lit(0).cast("long"), lambda x, y: x + y)
    return ly.document_digest(sections, blocks, "o_custkey").withColumn("blocks", blocks_of).drop("block_counts")


def entry(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: short lines of each document as headings, with the ranges that they open."""
    return t14_heading_ranges(spark, d)
