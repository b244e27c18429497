"""Steps whose work must not grow with the square of repeated names, and batches of bounded size."""

import random
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerleaf.operators import joins
from ledgerleaf.operators import lines as ln
from ledgerleaf.operators import rematch as rm
from ledgerleaf.sources import collect as co


def test_containing_streams_the_rows_of_equal_texts(spark):
    longer = spark.createDataFrame([(i, t) for i, t in enumerate(["large ring", "ab", "a", "", None, "large ring", "abab"])], "i int, t string")
    shorter = spark.createDataFrame([(p,) for p in ["large", "ring", "b", "a", "ab", "", None, "ring!", "b"]], "p string")
    joined = joins.containing(longer, shorter, "t", "p")
    want = Counter((r.i, s.p) for r in longer.collect() for s in shorter.collect() if r.t and s.p and s.p in r.t)
    assert Counter((r.i, r.p) for r in joined.select("i", "p").collect()) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Generate" in plan


def test_rematched_compares_each_name_once(spark, monkeypatch):
    sizes = []

    def counted(longer, shorter, *names):
        sizes.append((longer.count(), shorter.count()))
        return joins.containing(longer, shorter, *names)

    monkeypatch.setattr(rm, "containing", counted)
    listed = spark.createDataFrame([(i, "ACE one" if i < 40 else "two") for i in range(60)] + [(7, "two"), (99, None)], "code int, name string")
    funds = spark.createDataFrame([(i, "KINDEX one증권" if i < 30 else "two") for i in range(31)] + [(30, "x two"), (None, "two")], "fund int, name string")
    got = {r.code: (r.status, r.n, r.fund) for r in rm.rematched(listed, funds).collect()}
    assert sizes == [(3, 3)] or sizes == [(3, 4)]  # the null name is a variant too
    assert got[0] == ("AMBIGUOUS", 30, None) and got[59] == ("MATCHED", 1, 30) and got[99] == ("NO_CANDIDATE", 0, None)
    assert got[7] == ("MATCHED", 1, 30)  # of its two names the one found at place 0


def test_similar_compares_each_name_once_and_gives_what_all_pairs_give(spark, monkeypatch):
    calls, plain, each = spark.sparkContext.accumulator(0), rm.ratio, rm.ratio.func

    @F.pandas_udf(DoubleType())
    def counted(left: pd.Series, right: pd.Series) -> pd.Series:
        calls.add(len(left))
        return each(left, right)

    rng = random.Random(3)
    names = ["large ring", "large bolt", "old plate", "cold plate", "large rings", None]
    sides = [[(i, rng.choice("ab"), rng.choice(names)) for i in rng.choices(range(80), k=90)] for _ in range(2)]
    listed = spark.createDataFrame(sides[0], "code int, brand string, core string")
    funds = spark.createDataFrame(sides[1], "fund int, brand string, core string")
    for least, margin in ((0.6, 0.0), (0.6, 0.05), (0.9, 0.01)):
        pairs = listed.join(funds.withColumnRenamed("core", "_core"), "brand").select("code", "fund", plain("core", "_core").alias("r"))
        want = joins.best_with_margin(pairs, ["code"], F.col("r"), "fund", least, margin)
        monkeypatch.setattr(rm, "ratio", counted)
        got = rm.similar(listed, funds, ["brand"], least, margin)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), (least, margin)
    assert 0 < calls.value <= 3 * 2 * 5 * 5


def test_group_similarity_gives_every_pair(spark):
    rows = [(0, "a", "x y"), (1, "a", "y x"), (2, "a", "x x z"), (2, "a", "q"), (3, "b", "x y"), (4, "a", None), (5, None, "x"), (6, None, "x"), (7, "a", "")]
    got = joins.group_similarity(spark.createDataFrame(rows, "i int, g string, n string"), ["g"], "i", "n")
    want = []
    for i, g, n in rows:
        for k, h, m in rows:
            if g is not None and g == h and i < k:
                x, y = (None if s is None else set(s.split(" ")) for s in (n, m))
                want.append((i, k, None if x is None or y is None else len(x & y) / len(x | y)))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_replies_go_to_spark_in_batches():
    schema = pa.schema([("k", pa.int64()), ("body", pa.binary())])
    many = list(co._batched(((i, b"x") for i in range(2500)), schema, lambda r: len(r[1])))
    assert [b.num_rows for b in many] == [1000, 1000, 500] and [v for b in many for v in b.column(0).to_pylist()] == list(range(2500))
    large = list(co._batched(((i, bytes(co.MOST_BYTES // 2)) for i in range(5)), schema, lambda r: len(r[1])))
    assert [b.num_rows for b in large] == [2, 2, 1] and not list(co._batched(iter(()), schema, len))


def test_texts_are_cut_in_slices_of_bounded_size():
    texts = ["a" * 1_500_000, None, "b", "é" * 1_500_000, "", "c" * 5_000_000, "d"]
    batch = pa.RecordBatch.from_pydict({"k": list(range(7)), "t": pa.array(texts, pa.string())})
    slices = list(ln._slices(batch, 1))
    assert [v for s in slices for v in s.column(1).to_pylist()] == texts and len(slices) > 2
    sizes = [[len((t or "").encode()) for t in s.column(1).to_pylist()] for s in slices]
    assert all(sum(n) - max(n) <= ln.SLICE_BYTES for n in sizes)
    assert sum(s.num_rows for s in ln._slices(batch.slice(0, 0), 1)) == 0
