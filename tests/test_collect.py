"""Collecting, names, releases and replies, on cases that the queries don't have."""

import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from ledgerleaf.operators import rematch as rm
from ledgerleaf.operators.sections import Splitter
from ledgerleaf.plans import loading as ld
from ledgerleaf.plans import release, replies
from ledgerleaf.sources import collect


def test_waits_grow_and_failures_end_the_tries(monkeypatch):
    waits = []
    monkeypatch.setattr(collect.time, "sleep", lambda s: waits.append(s))

    def send(endpoint, params):
        raise TimeoutError

    body, tries = collect.Caller(send, retries=3, interval=0.0)("x", {})
    assert body is None and len(tries) == 4 and [w for w in waits if w] == [1, 2, 4]
    assert len(collect.Caller(lambda e, p: (429, b""), interval=0.0)("x", {})[1]) == 1
    assert len(collect.Caller(lambda e, p: (429, b""), retries=1, interval=0.0, again=("RATE_LIMITED",))("x", {})[1]) == 2


def test_variants_come_in_order_and_hedges_must_agree(spark):
    listed = spark.createDataFrame([(1, "ACE 미국S&P500(H)"), (2, "ACE 미국S&P500"), (3, "RISE 채권TR"), (4, "없음"), (5, None)], "code int, name string")
    funds = spark.createDataFrame([("a", "한국 KINDEX 미국S&P500(H)"), ("b", "한국 KINDEX 미국S&P500증권"), ("c", "KB KBSTAR 채권 Total Return"), ("d", None)], "fund string, name string")
    got = {r.code: (r.status, r.fund) for r in rm.rematched(listed, funds).collect()}
    assert got[1][1] != "b" and got[2] == ("MATCHED", "b") and got[3] == ("MATCHED", "c") and got[4] == got[5] == ("NO_CANDIDATE", None)


def test_similar_names_against_all_pairs(spark):
    names = ["small blue lamp", "small blue lamps", "large red box", "large red", "tiny"]
    listed = spark.createDataFrame([(k, "x", n) for k, n in enumerate(names)], "code int, brand string, core string")
    funds = spark.createDataFrame([(f"f{k}", "x", n + "s") for k, n in enumerate(names)], "fund string, brand string, core string")
    want = set()
    for k, n in enumerate(names):
        best = sorted(((SequenceMatcher(None, n, m + "s").ratio(), f"f{j}") for j, m in enumerate(names)), reverse=True)
        if best[0][0] >= 0.85 and best[0][0] - best[1][0] >= 0.05:
            want.add((k, best[0][1]))
    assert {(r.code, r.fund) for r in rm.similar(listed, funds, ["brand"]).collect()} == want and want


def test_unknown_reasons_and_missing_runs_are_errors(spark):
    rows = spark.createDataFrame([("WHATEVER",)], "r string")
    with pytest.raises(Exception, match="unknown reason"):
        rm.failure_log(rows, F.col("r"), F.current_date()).collect()
    runs = spark.createDataFrame([], "run_id string, parser_version string, limit int, status string")
    with pytest.raises(Exception, match="no whole run"):
        ld.picked_run(runs, "p").collect()
    with pytest.raises(Exception, match="daily list: 400"):
        spark.createDataFrame([('{"respCode": "400"}',)], "j string").select(collect.daily_items(F.col("j"), "struct<a:int>")).collect()


def test_the_last_line_of_a_key_wins(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"k": f"k{n % 3}", "v": n}) + "\n" for n in range(50)))
    got = {r.k: r.v for r in ld.last_lines(spark, str(tmp_path / "a.jsonl"), "k string, v int", "k").collect()}
    assert got == {"k0": 48, "k1": 49, "k2": 47}


def test_releases_are_written_once_and_prompts_stay(spark, tmp_path):
    tables = {"documents": spark.range(5), "excluded": spark.range(0)}
    got = {r.name: r.n for r in release.released(spark, tables, str(tmp_path / "r"), "run-1").collect()}
    assert got == {"documents": 5, "excluded": 0}
    with pytest.raises(Exception, match="(?i)already exists"):
        release.released(spark, tables, str(tmp_path / "r"), "run-1")
    prompts = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "name string, text string")
    for _ in range(2):
        paths = {r.name: r.path for r in release.installed(spark, prompts, str(tmp_path / "p")).collect()}
    assert paths["a"] == paths["b"] != paths["c"] and spark.read.parquet(str(tmp_path / "p")).count() == 2
    assert spark.read.parquet(paths["c"]).first().text == "y"


def test_single_companies_stand_for_a_combined_title():
    text = "\n".join([
        "제1부. 하나의 일", "1. 이름", "제2부. 둘의 일", "1. 개요", "제3부. 셋의 일", "1. 재무", "제4부. 관련회사의 일", "1. 회사의 개요", "2. 기타 집합투자재산 관련회사",
        "제1부. 하나의 일", "1. 이름", "글", "제2부. 둘의 일", "1. 개요", "글", "제3부. 셋의 일", "1. 재무", "글", "제4부. 관련회사의 일", "1. 회사의 개요", "글",
        "2. 신탁회사에 관한 사항", "3. 아무 목록", "2. 일반사무관리회사", "3. 채권평가회사", "글",
    ])
    rows = [(r[4], text[r[5] : r[6]]) for r in Splitter(text).split() if r[2] == 4]
    assert [title for title, _ in rows] == ["1. 회사의 개요", "2. 신탁회사에 관한 사항", "3. 채권평가회사"]
    assert rows[1][1].endswith("2. 일반사무관리회사\n") and rows[2][1] == "3. 채권평가회사\n글"


def test_a_combined_title_without_companies_stays_missing():
    text = "\n".join(["제1부. 가", "1. 이름", "제2부. 나", "1. 개요", "제3부. 다", "1. 기타 집합투자기구 관련회사", "제1부. 가", "1. 이름", "제2부. 나", "1. 개요", "제3부. 다", "글"])
    assert [r[5] for r in Splitter(text).split() if r[2] == 3] == [None]


def test_sections_without_use(spark):
    rows = spark.createDataFrame([("OK", "t", 1), ("OK", None, 1), (None, "t", 1), ("LOST", "t", 1), ("OK", "t", None)], "s string, t string, c int")
    assert [r[0] for r in rows.select(replies.usable(F.col("s"), F.col("t"), F.col("c"))).collect()] == [True, False, False, False, False]
