"""Operators on small tables with known answers."""

from datetime import date

from pyspark.sql import functions as F

from ledgerleaf.functions import text as t
from ledgerleaf.functions.unicode import encode_key
from ledgerleaf.operators import aggregates, intervals, joins, rules, storage
from ledgerleaf.operators import lines as ln


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_offsets_count_code_points(spark):
    df = spark.createDataFrame([(1, "a😀b\n\nc")], "id int, text string")
    assert rows(ln.text_lines(df, "id"), "no") == [(1, 0, 0, 3, "a😀b"), (1, 1, 4, 4, ""), (1, 2, 5, 6, "c")]


def test_report_kind(spark):
    df = spark.createDataFrame([("[fix]annual A",), ("annual B",), ("x",)], "n string")
    got = rows(df.select("n", t.report_kind(F.col("n"), [("annual", "A")]).alias("k")).select("n", "k.*"), "n")
    assert got == [("[fix]annual A", "A", True), ("annual B", "A", False), ("x", "other", False)]


def test_colors_round_half_to_even_and_cmyk(spark):
    df = spark.createDataFrame([([0.5],), ([1.0, 0.0, 0.0],), ([0.0, 0.0, 0.0, 1.0],), ([],)], "c array<double>")
    assert [r[0] for r in df.select(t.hex_color(F.col("c"))).collect()] == ["#808080", "#ff0000", "#000000", None]


def test_undoubled(spark):
    df = spark.createDataFrame([("제제 33 부부",), ("aab bb",), ("aa",)], "x string")
    assert [r[0] for r in df.select(t.undoubled(F.col("x"))).collect()] == ["제 3 부", "aab bb", "aa"]


def test_page_furniture(spark):
    text = "\f".join(f"Head\nbody {'x' * n}\n- {n} -" for n in range(1, 7))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    found = rows(ln.page_furniture(df, "id"), "start")
    assert len(found) == 12 and {text[s:e] for _, s, e in found} == {"Head", *(f"- {n} -" for n in range(1, 7))}


def test_union_and_subtract(spark):
    r = spark.createDataFrame([(1, 0, 3), (1, 3, 5), (1, 8, 9), (2, 1, 2)], "k int, start int, end int")
    assert rows(intervals.union_ranges(r, ["k"])) == [(1, 0, 5), (1, 8, 9), (2, 1, 2)]
    whole = spark.createDataFrame([(1, 0, 10), (2, 0, 10), (3, 0, 10)], "k int, start int, end int")
    assert rows(intervals.subtract_ranges(whole, r, ["k"])) == [(1, 5, 8), (1, 9, 10), (2, 0, 1), (2, 2, 10), (3, 0, 10)]


def test_range_joins_agree_with_brute_force(spark):
    import random

    rnd = random.Random(1)
    a = [(rnd.randint(0, 2), s := rnd.randint(0, 50), s + rnd.randint(0, 30)) for _ in range(80)]
    b = [(rnd.randint(0, 2), s := rnd.randint(0, 50), s + rnd.randint(0, 30)) for _ in range(80)]
    left = spark.createDataFrame(a, "k int, start int, end int").withColumn("i", F.monotonically_increasing_id())
    right = spark.createDataFrame(b, "k int, r_start int, r_end int").withColumn("j", F.monotonically_increasing_id())
    got = rows(intervals.overlapping(left, right, ["k"], bin_size=7).select("k", "start", "end", "r_start", "r_end"))
    assert got == sorted((k, s, e, rs, re) for k, s, e in a for k2, rs, re in b if k == k2 and s < re and rs < e and e > s and re > rs)
    points = spark.createDataFrame([(k, s) for k, s, _ in a], "k int, at int")
    ranges = spark.createDataFrame(b, "k int, start int, end int")
    got = rows(intervals.points_in_ranges(points, ranges, ["k"], "at", bin_size=7).select("k", "at", "start", "end"))
    assert got == sorted((k, p, s, e) for k, p, _ in a for k2, s, e in b if k == k2 and s <= p < e)


def test_range_violations(spark):
    df = spark.createDataFrame([(1, 1, 0, 5), (1, 3, 4, 8), (1, 4, None, 9), (1, 5, 8, 99)], "k int, seq int, start int, end int").withColumn("length", F.lit(20))
    got = {r.seq: r.problems for r in intervals.range_violations(df, ["k"]).collect()}
    assert got == {3: ["SEQUENCE", "OVERLAP"], 4: ["SEQUENCE", "HALF_RANGE"], 5: ["SEQUENCE", "OUT_OF_BOUNDS"]}


def test_containing_needs_no_cross_join(spark):
    a = spark.createDataFrame([(1, "KODEX200 ETF"), (2, "ab"), (3, "TIGER")], "i int, name string")
    b = spark.createDataFrame([("KODEX200",), ("IGE",), ("ab",)], "part string")
    joined = joins.containing(a, b, "name", "part")
    assert rows(joined.select("i", "part")) == [(1, "KODEX200"), (2, "ab"), (3, "IGE")]  # parts below three characters too
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_unique_match_and_margin(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "k string, v string")
    assert rows(joins.unique_match(left, right, ["k"], "k", "v")) == [("a", "x", "MATCHED"), ("b", None, "AMBIGUOUS"), ("c", None, "NO_CANDIDATE")]
    scored = spark.createDataFrame([(1, "p", 0.9), (1, "q", 0.88), (2, "p", 0.9), (2, "q", 0.5), (3, "p", 0.7)], "k int, c string, s double")
    assert rows(joins.best_with_margin(scored, ["k"], F.col("s"), "c", 0.85, 0.05).select("k", "c")) == [(2, "p")]


def test_nearest_rank_is_not_percentile_disc(spark):
    df = spark.range(1, 11).withColumn("g", F.lit(1))
    assert aggregates.nearest_rank(df, ["g"], "id", 0.1, "p").first().p == 2


def test_checksum_ignores_layout_but_not_content(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    same = df.repartition(7).orderBy(F.desc("id"))
    other = df.withColumn("x", F.when(F.col("id") == 5, 1).otherwise(F.col("x")))
    one, two, three = (aggregates.table_checksum(x).first().checksum for x in (df, same, other))
    assert one == two != three


def test_versions_continue_over_batches(spark):
    arrivals = spark.createDataFrame([("k", 1, "a"), ("k", 2, "a"), ("k", 3, "b"), ("k", 4, "a")], "k string, n int, sha string")
    got = rows(storage.assign_versions(arrivals, ["k"], ["n"], "sha").select("n", "version", "reused"))
    assert got == [(1, 1, False), (2, 1, True), (3, 2, False), (4, 3, False)]
    latest = spark.createDataFrame([("k", "a", 7)], "k string, sha string, version int")
    got = rows(storage.assign_versions(arrivals, ["k"], ["n"], "sha", latest).select("n", "version", "reused"))
    assert got == [(1, 7, True), (2, 7, True), (3, 8, False), (4, 9, False)]


def test_watermark_stops_at_the_first_gap(spark):
    days = [("a", date(2026, 1, d), ok) for d, ok in ((1, True), (2, True), (3, False), (4, True))] + [("b", date(2026, 1, d), True) for d in (1, 3)] + [("c", date(2026, 1, 1), False)]
    df = spark.createDataFrame(days, "s string, d date, ok boolean")
    assert rows(storage.complete_until(df, "s", "d", "ok")) == [("a", date(2026, 1, 1), date(2026, 1, 2)), ("b", date(2026, 1, 1), date(2026, 1, 1)), ("c", date(2026, 1, 1), None)]


def test_encode_key():
    assert encode_key(["a/b", "c~%"]) == "a%2Fb~c%7E%25"
    long = encode_key(["가" * 100])
    assert len(long.encode()) <= 200 and long.startswith("가") and "-h" in long


def test_rules_find_what_was_broken(spark):
    parent, child = spark.createDataFrame([(1,), (2,)], "p int"), spark.createDataFrame([(1, 5), (3, -1), (None, 2)], "p int, v int")
    found = rules.report(
        [rules.parent_rule("parent", "c", "p", "t", "p"), rules.row_rule("positive", "v > 0", "c", F.col("v") < 0), rules.unique_rule("key", "t", ["p"]), rules.count_rule("count", "t", 2)],
        {"c": child, "t": parent},
    )
    assert {r.rule: (r.violations, r.ok) for r in found.collect()} == {"parent": (1, False), "positive": (1, False), "key": (0, True), "count": (0, True)}


def test_all_tables_have_rules_that_hold_on_empty_tables(spark):
    from ledgerleaf.plans.schemas import TABLES, create_tables, table_rules

    tables = {n: spark.createDataFrame([], x.columns) for n, x in TABLES.items()}
    assert len(TABLES) == 17
    assert all(r.ok for r in rules.report(table_rules()[17:], tables).collect())
    assert len(create_tables(spark)) == 17


def test_streaming_sink_takes_a_batch_twice(spark, tmp_path):
    from ledgerleaf.streaming.intake import idempotent_sink

    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, ids in enumerate(([1, 2, 2], [2, 3])):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("id long").parquet(folder)
        idempotent_sink(stream, out, str(tmp_path / "checkpoint"), ["id"]).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == [[1, 2], [1, 2, 3]][n]


def test_layout(spark):
    from ledgerleaf.operators import layout

    df = spark.createDataFrame([("\n a  \nb\r \n\n",), ("  \n",)], "x string")
    assert [r[0] for r in df.select(layout.trimmed_page(F.col("x"))).collect()] == [" a\nb\n", ""]
    text, styles = "ab cd\ne", "BB-BBBB"
    chars = spark.createDataFrame([(1, i, c, None if i == 4 else s) for i, (c, s) in enumerate(zip(text, styles, strict=True))], "p int, i int, c string, s string")
    assert rows(layout.style_runs(chars, ["p"], "i", "c", "s").select("start", "end")) == [(0, 4), (6, 7)]
    marks = spark.createDataFrame([(1, 0, "제1부 가"), (1, 1, "1. 나"), (1, 2, "note"), (2, 0, "note")], "k int, no int, title string")
    sections = spark.createDataFrame([(1, 1, "1"), (1, 2, "7")], "k int, part int, number string")
    got = {r.k: (r.bookmark_parts, r.bookmark_sections, r.matched_parts, r.matched_sections, r.rule_parts, r.rule_sections) for r in layout.bookmark_agreement(marks, sections, "k").collect()}
    assert got == {1: (1, 1, 1, 1, 2, 2), 2: (0, 0, 0, 0, 0, 0)}
    both = layout.blocks({"table": spark.createDataFrame([(1, 0, 5, True)], "k int, start int, end int, t boolean"), "label": spark.createDataFrame([(1, 2, 3, "x")], "k int, start int, end int, l string")}, "k")
    assert [r.kind for r in both.orderBy("start", "end", "kind").collect()] == ["table", "label"]


def test_names_and_held_matches(spark):
    from ledgerleaf.operators import matching

    names = spark.createDataFrame([("㈜ 가나 은행 강남지점",), ("옛이름(주)",)], "n string")
    former = spark.createDataFrame([("옛이름 주식회사", "새이름")], "former string, current string")
    assert sorted(r.entity for r in matching.entity_name(names, "n", former).collect()) == ["가나은행", "새이름"]
    found = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), ("d", "z"), ("e", "w")], "k string, t string")
    earlier = spark.createDataFrame([("b", "q", "person"), ("other", "x", "rule")], "k string, t string, by string")
    got = {r.k: (r.t, r.status) for r in matching.held_matches(found, earlier, "k", "t").collect()}
    assert got == {"a": (None, "HELD"), "b": ("q", "CONFIRMED"), "c": (None, "HELD"), "d": (None, "HELD"), "e": ("w", "MATCHED")}


def test_notices_collapse_only_when_ad_hoc(spark):
    from ledgerleaf.operators import matching

    df = spark.createDataFrame([(True, "f", "A"), (True, "f", "C"), (False, "g", "A"), (False, "g", "C")], "ad boolean, file string, cls string")
    assert rows(matching.collapsed_notices(df, F.col("ad"), ["file"], "cls").select("file", "classes")) == [("f", ["A", "C"]), ("g", ["A"]), ("g", ["C"])]


def test_binary_sources(spark):
    import io
    import zipfile

    from ledgerleaf.sources import binary

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.xml", "abc")
    df = spark.createDataFrame([(bytearray(buffer.getvalue()),), (bytearray("가나".encode("euc-kr")),), (None,)], "c binary")
    got = df.select(binary.archive_entries("c").alias("z"), binary.document_text("c").alias("t"), binary.korean_text("c").alias("k")).collect()
    assert [tuple(x) for x in got[0].z] == [("a.xml", 3)] and got[1].z is None and got[1].k == "가나" and got[2].k is None
    assert all(r.t is None for r in got)


def compound_file(name: str, content: bytes) -> bytes:
    """A compound file of one large stream: header, table, directory, content."""
    import struct

    sectors = -(-len(content) // 512)
    table = [0xFFFFFFFD, 0xFFFFFFFE] + [*range(3, 2 + sectors), 0xFFFFFFFE]
    head = bytes.fromhex("d0cf11e0a1b11ae1") + b"\0" * 22 + struct.pack("<HH", 9, 6) + b"\0" * 10
    head += struct.pack("<II", 1, 1) + struct.pack("<IIIIII", 0, 0, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)
    head = head[:44] + struct.pack("<II", 1, 1) + struct.pack("<IIIIII", 0, 0, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0) + struct.pack("<109I", 0, *[0xFFFFFFFF] * 108)

    def entry(n: str, kind: int, start: int, size: int) -> bytes:
        raw = n.encode("utf-16-le")
        return raw.ljust(64, b"\0") + struct.pack("<HB", len(raw) + 2, kind) + b"\0" * 49 + struct.pack("<IQ", start, size)

    directory = entry("Root Entry", 5, 0xFFFFFFFE, 0) + entry(name, 2, 2, len(content))
    return head.ljust(512, b"\0") + struct.pack(f"<{len(table)}I", *table).ljust(512, b"\xff") + directory.ljust(512, b"\0") + content.ljust(512 * sectors, b"\0")


def test_word_processor_text():
    import struct
    import zlib

    from ledgerleaf.sources import binary

    text = "가나다\x05라".encode("utf-16-le")
    record = struct.pack("<I", 67 | len(text) << 20) + text + struct.pack("<I", 1 | 4 << 20) + b"abcd"
    packer = zlib.compressobj(wbits=-15)
    raw = packer.compress(record) + packer.flush()
    assert binary.word_processor_text(compound_file("Section0", raw)) == "가나다라"
