"""The methods behind the operators against plain versions of the same thing."""

import os
import random
from collections import Counter

import numpy as np
import public_tokenizers as p
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerleaf.llm import bpe, graph, html, jpeg, langid, lines, rules, simhash, suffix, token_counts
from ledgerleaf.llm.suffixsort import deep_shallow

ODD = [" ", "  ", "\n", "\t", "▁", "a", "the", "é", "ß", "12", "'s", "!", "\x00", "\xa0", "　", "\r\n", "日本", "🎉", "\x1c", "\x85", "</s>", "<0x0A>", "ﬁ", "²"]
TEXT = st.lists(st.sampled_from(ODD) | st.text(max_size=3), max_size=12).map("".join).filter(lambda t: t.isascii() or "\ud800" not in t)


@pytest.fixture(scope="module")
def encoder():
    return bpe.TextEncoder(p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


@pytest.fixture(scope="module")
def tik(encoder):
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    path = p.path("piece_bpe_32k.model")
    words = ["the", "a", "\na", "the\t", "é"]
    return token_counts.TokenCounter(path, token_counts.FrequentLengths.of(dict(zip(words, token_counts.TokenCounter(path).lengths(words)))), limit=50)


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_encoding_agrees_with_the_library(encoder, tik, text):
    ids = encoder.encode(text)
    assert ids == tik.encode_ordinary(text) and encoder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_counts_agree_with_the_library(counter, text):
    assert counter.counts([text]) == [len(counter.model.encode(text))]


def test_appends_and_edits_are_exact(encoder):
    rnd, v = random.Random(1), encoder.vocabulary
    for _ in range(200):
        s = "".join(rnd.choice("abcdeth ") for _ in range(rnd.randint(0, 60))).encode()
        e = bpe.PrefixEncoder(v, s[:20]).append(s[20:])
        assert e.tokens() == v.merge(s)
        a = rnd.randint(0, len(s))
        b = rnd.randint(a, len(s))
        new = "".join(rnd.choice("abth") for _ in range(rnd.randint(0, 5))).encode()
        assert e.edit(a, b, new).last == bpe.PrefixEncoder(v, s[:a] + new + s[b:]).last


def test_frequent_table():
    table = token_counts.FrequentLengths.of({f"w{i}": i for i in range(500)})
    assert all(table.get(f"w{i}") == i for i in range(500)) and table.get("x") is None
    assert table.expanded() == {f"w{i}": i for i in range(500)}


@pytest.mark.parametrize("sampling", [(1, 1), (2, 1), (1, 2), (2, 2)])
@pytest.mark.parametrize("density", [0.05, 0.5, 1.0])
def test_jpeg_round_trip_of_coefficients(sampling, density):
    rnd = np.random.default_rng(0)
    for components in ([(1, *sampling), (2, 1, 1), (3, 1, 1)], [(1, 1, 1)]):
        parts = [jpeg.Component(i, x, y, 0) for i, x, y in components]
        image = jpeg.Image(int(rnd.integers(1, 60)), int(rnd.integers(1, 60)), parts, {0: np.full(64, 2)}).layout()
        for c in parts:
            v = rnd.integers(-300, 300, c.blocks.shape) * (rnd.random(c.blocks.shape) < density)
            v[c.own_high :, :, 1:] = 0
            v[:, c.own_wide :, 1:] = 0
            c.blocks[:] = v
        read = jpeg.Reader().read(jpeg.Writer().write(image))
        assert all((a.blocks == b.blocks).all() for a, b in zip(parts, read.components, strict=True))
        assert jpeg.to_rgb(read).shape == (image.height, image.width, 3)


def test_inverse_transform_is_exact_enough():
    x = np.random.default_rng(1).integers(-128, 128, (8, 8)).astype(float)
    n = np.arange(8)
    c = np.cos((2 * n[None, :] + 1) * n[:, None] * np.pi / 16) * np.where(n == 0, np.sqrt(0.5), 1)[:, None] / 2
    assert np.abs(((c @ x @ c.T).reshape(64)[jpeg.ZIGZAG] @ jpeg.BASIS / (8 << 13)).reshape(8, 8) - x).max() < 0.05


def test_deep_shallow_orders_and_counts_prefixes():
    rnd = random.Random(5)
    for _ in range(1500):
        base = bytes(rnd.choice(b"ab") for _ in range(60))
        s = [base[: rnd.randint(0, 60)] + bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 12))]
        order, shared = deep_shallow(s + s[:1], 0, rnd.choice([0, 2, 24]))
        s += s[:1]
        assert [s[k] for k in order] == sorted(s)
        assert shared == [0] + [len(os.path.commonprefix([s[a], s[b]])) for a, b in zip(order, order[1:])]


def test_repeated_bytes_agree_with_brute_force(spark):
    rnd = random.Random(2)
    base = ["".join(rnd.choice("abcdefgh") for _ in range(80)) for _ in range(5)]
    texts = []
    for _ in range(40):
        t = list(rnd.choice(base) + rnd.choice(base)[: rnd.randint(0, 80)])
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = "Z"
        texts.append("".join(t))
    texts += ["a" * 70, "é" * 30, "abc" * 20]
    length, gram = 30, 8
    count = Counter(r[i : i + length] for r in (t.encode() for t in texts) for i in range(len(r) - length + 1))
    for most in 1000, 2:
        keyed = suffix._keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
        got = {k: set() for k in range(len(texts))}
        for r in suffix.repeated_bytes(keyed, length, gram, most).collect():
            got[r.doc].update(range(r["from"], r["to"]))
        for k, t in enumerate(texts):
            raw = t.encode()
            want = {i for s in range(len(raw) - length + 1) if count[raw[s : s + length]] > 1 for i in range(s, s + length)}
            assert got[k] == want, (k, most)


def _distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_distance_and_segments_miss_nothing():
    rnd = random.Random(3)

    def edited(s: str, k: int) -> str:
        t = list(s)
        for _ in range(k):
            i = rnd.randint(0, len(t))
            t[i : i + rnd.randint(0, 1)] = rnd.choice(["", "a", "b"])
        return "".join(t)

    for k in (1, 2, 3):
        for _ in range(40):
            base = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(8, 40))) for _ in range(6)]
            words = sorted({*base, *(edited(b, rnd.randint(1, k)) for b in base for _ in range(3))})
            words = [w for w in words if len(w) > k]
            buffer, starts, sizes, _, _ = lines._lines(["\n".join(words)])
            meet: dict[int, list] = {}
            for at, keys, entered in lines.entries(buffer, starts, sizes, k):
                for a, key in zip(at.tolist(), keys.tolist(), strict=True):
                    meet.setdefault(key, []).append((a, entered))
            pairs = {frozenset((a, b)) for v in meet.values() for a, x in v for b, y in v if a != b and (x or y)}
            for i, a in enumerate(words):
                for j, b in enumerate(words[:i]):
                    d = _distance(a.encode(), b.encode())
                    assert lines.banded_distance(a.encode(), b.encode(), k) == min(d, k + 1)
                    assert d > k or frozenset((i, j)) in pairs


@pytest.mark.parametrize(("distance", "parts", "split"), [(3, 4, 1000), (3, 3, 1000), (5, 4, 1000), (3, 4, 20)])
def test_links_connect_what_brute_force_connects(spark, distance, parts, split):
    rnd = np.random.default_rng(0)
    base = rnd.integers(0, 2**63, 40, dtype=np.int64).view(np.uint64)
    x = [base]
    for _ in range(6):
        y = base.copy()
        for _ in range(rnd.integers(1, 5)):
            y ^= np.uint64(1) << rnd.integers(0, 64, 40).astype(np.uint64)
        x.append(y)
    dense = np.full(200, 987654321, np.uint64)
    for _ in range(3):
        dense ^= np.uint64(1) << rnd.integers(0, 64, 200).astype(np.uint64)
    x = np.unique(np.concatenate([*x, dense]).view(np.int64))
    root = {int(v): int(v) for v in x}

    def find(v: int) -> int:
        while root[v] != v:
            v = root[v]
        return v

    for i in range(len(x)):
        for k in np.flatnonzero(np.bitwise_count((x[i + 1 :] ^ x[i]).view(np.uint64)) <= distance):
            a, b = sorted((find(int(x[i])), find(int(x[i + 1 + k]))))
            root[b] = a
    found = simhash.links(spark.createDataFrame([(int(v),) for v in x], "fp long"), distance, parts, split)
    got = {r.node: r.root for r in graph.components(found).collect()}
    assert all(got.get(v, v) == find(v) for v in root)


def test_long_chains_settle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500)], "a long, b long")
    got = graph.components(edges).collect()
    assert {r.root for r in got} == {0} and len(got) == 201


def test_fingerprint_of_few_words():
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    import xxhash

    assert simhash.fingerprint("One\ttwo") == xxhash.xxh64_intdigest(b"one two", 42)


def test_language_models_are_distributions_and_tell_languages_apart():
    words = {"en": Counter("the of and to in that with from they this".split()), "de": Counter("der die und das ist nicht mit von ein auf".split())}
    models = langid.LanguageModels.train({k: dict(v) for k, v in words.items()})
    # After the start mark, the probabilities of all characters sum to nearly 1.
    start = models.word_scores(["t"])[0] - models.word_scores(["tq"])[0]
    assert start.shape == (2,)
    scorer = langid.Scorer(models)
    assert scorer.predict("The and they THIS")[0] == "en" and scorer.predict("das ist die und der")[0] == "de"
    assert scorer.predict("12 !")[0] == "und"
    models.calibrate([("en", "that with from"), ("de", "mit von ein")])
    assert scorer.predict("Привет мир")[2] and not scorer.predict("they and this")[2]


def test_repeated_words_agree_with_brute_force():
    rnd = random.Random(0)
    for _ in range(1500):
        words = [rnd.choice("ab") if rnd.random() < 0.9 else rnd.choice("cdef") for _ in range(rnd.randint(0, 60))]
        runs = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {k for i in range(len(words) - 7) if runs[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
        assert rules.repeated_words(words) == len(covered)


def test_decision_list_finds_planted_rules():
    rnd = np.random.default_rng(0)
    x = {"a": rnd.random(3000), "b": rnd.random(3000), "noise": rnd.random(3000)}
    bad = (x["a"] > 0.8) & (x["b"] < 0.5) | (x["b"] > 0.95)
    learned = rules.learn(x, bad)
    hit = np.zeros(3000, bool)
    for r in learned:
        hit |= r.covers(x)
    assert (hit & ~bad).sum() <= 30 and (bad & ~hit).sum() <= 60
    assert rules.learn(x, np.zeros(3000, bool)) == []


PAGE = "<html><head><title>t &amp; x</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>home</a></li></ul></nav><div class='ad'>buy this now please</div><article><h1>Head</h1><p>One  two&nbsp;three.<br>four<p><b>Five</b>six &lt;7&gt;</article><div id=comments>I disagree with all of this, really</div><footer>&copy; us</footer></body></html>"


def test_main_text():
    weights = html.learn([PAGE] * 5)
    assert html.main_text(PAGE, weights) == "Head\nOne two three. four\nFivesix <7>"
    assert html.main_text(PAGE[: PAGE.index("six")], weights) == "Head\nOne two three. four\nFive"
    assert html.main_text(PAGE.replace("article", "div"), weights).startswith("Head\nOne two")


def test_best_region_is_the_best_of_all():
    rnd = random.Random(4)
    for _ in range(300):
        items = [(rnd.choice(["p", "nav"]), "") if rnd.random() < 0.6 else ("word", "x " * rnd.randint(1, 4)) for _ in range(rnd.randint(0, 12))]
        weights = {"word": 1.0, "p": -0.5, "nav": -2.0}
        score = lambda a, b: sum(len(t.split()) if k == "word" else weights[k] for k, t in items[a:b])
        best = max((score(a, b) for a in range(len(items) + 1) for b in range(a, len(items) + 1)), default=0)
        assert abs(score(*html.best_region(items, weights)) - best) < 1e-9
