"""Language identification by interpolated Kneser-Ney models of characters, one per language.

A text is scored as its runs of letters, lower-cased, each read between two boundary marks; a model gives each
character the probability that follows from the up to three characters before it. The n-grams of all languages
stand in one sorted hash array per order, beside a matrix with one column per language. The language with the
lowest cross-entropy per character wins; a text whose best cross-entropy is beyond what the language's own
texts reach is rejected.

Runs repeat, so their scores are kept in a bounded cache of the worker process.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, kept, map_lists, read

LETTERS = re.compile(r"[^\W\d_]+").findall
ORDER = 4
_M = np.uint64(0x9E3779B97F4A7C15)
_START, _END = "\x02", "\x03"
UNKNOWN = "und"


def letter_runs(text: str) -> list[str]:
    return LETTERS(text.lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words between boundary marks, and each position's distance from its word's start."""
    raw = np.frombuffer("".join(f"{_START}{w}{_END}" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.flatnonzero(raw == ord(_START))
    return raw.astype(np.uint64), np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))


def _grams(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n characters that end at each position (of no use where a word has fewer)."""
    mixed, power, out = _mix(codes + np.uint64(1)), np.uint64(1), []
    total = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(order):
            shifted = np.zeros(len(codes), np.uint64)
            shifted[n:] = mixed[: len(mixed) - n]
            total = total + shifted * power
            power *= _M
            out.append(total)
    return out


@dataclass
class _Counts:
    """The n-grams of one language: by order their hashes (sorted), context's and suffix's hash, and count."""

    keys: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    suffixes: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)


def _count(words: list[str], times: np.ndarray, order: int) -> _Counts:
    codes, depth = _codes(words)
    weight = np.repeat(times, [len(w) + 2 for w in words]).astype(np.float64)
    grams, out, longer = _grams(codes, order), _Counts(), None
    for n in range(order, 0, -1):
        # A boundary mark at the start is context only.
        at = np.flatnonzero((depth >= n - 1) & (depth >= 1))
        keys, first, inverse = np.unique(grams[n - 1][at], return_index=True, return_inverse=True)
        first = at[first]
        count = np.bincount(inverse, weight[at], len(keys))
        if longer is not None:
            # Below the highest order: in how many contexts one longer it occurs, but where nothing can stand
            # before it (it starts at the boundary), how often it occurs.
            longer_keys, spread = np.unique(longer, return_counts=True)
            inner = depth[first] >= n
            found = np.clip(np.searchsorted(longer_keys, keys), 0, max(0, len(longer_keys) - 1))
            count = np.where(inner, np.where(longer_keys[found] == keys, spread[found], 0) if len(longer_keys) else 0, count)
        before = np.where(first > 0, first - 1, 0)
        out.keys.insert(0, keys)
        out.contexts.insert(0, grams[n - 2][before] if n > 1 else np.zeros(len(keys), np.uint64))
        out.suffixes.insert(0, grams[n - 2][first] if n > 1 else np.zeros(len(keys), np.uint64))
        out.counts.insert(0, count)
        longer = out.suffixes[0] if n > 1 else None
    return out


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


@dataclass
class LanguageModels:
    """The trained models. ``logs[n]`` has log probabilities (n-grams x languages), ``weights[n]`` the logs of what
    a seen context leaves to the order below."""

    languages: list[str]
    order: int
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    context_keys: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float
    mean: np.ndarray | None = None
    limit: np.ndarray | None = None

    @classmethod
    def train(cls, word_counts: dict[str, dict[str, int]], order: int = ORDER) -> LanguageModels:
        languages = sorted(word_counts)
        if not languages:
            return cls([], order, [], [], [], [], 1.0)
        per = [_count(list(word_counts[x]), np.array(list(word_counts[x].values())), order) for x in languages]
        keys, logs, context_keys, weights = [], [], [], []
        floor = 1.0 / 0x110000  # below the unigrams: any code point
        lower_keys, lower = np.zeros(0, np.uint64), np.zeros((0, len(languages)))
        for n in range(order):
            all_keys, where = np.unique(np.concatenate([p.keys[n] for p in per]), return_index=True)
            contexts = np.concatenate([p.contexts[n] for p in per])[where]
            suffixes = np.concatenate([p.suffixes[n] for p in per])[where]
            all_contexts = np.unique(contexts)
            prob, left = np.zeros((len(all_keys), len(languages))), np.ones((len(all_contexts), len(languages)))
            for k, p in enumerate(per):
                count = p.counts[n]
                once, twice = (count == 1).sum(), (count == 2).sum()
                discount = once / (once + 2 * twice) if once and twice else 0.5
                c_keys, inverse = np.unique(p.contexts[n], return_inverse=True)
                total = np.maximum(np.bincount(inverse, count, len(c_keys)), 1e-9)
                kinds = np.bincount(inverse, np.minimum(count, discount), len(c_keys))
                at, _ = _find(all_contexts, c_keys)
                left[at, k] = kinds / total
                at, _ = _find(all_keys, p.keys[n])
                prob[at, k] = np.maximum(count - discount, 0) / total[inverse]
            if n:
                at, seen = _find(lower_keys, suffixes)
                below = np.where(seen[:, None], lower[at], floor)
            else:
                below = np.full(prob.shape, floor)
            at, _ = _find(all_contexts, contexts)
            prob = np.maximum(prob + left[at] * below, 1e-12)
            lower_keys, lower = all_keys, prob
            keys.append(all_keys)
            logs.append(np.log(prob).astype(np.float32))
            context_keys.append(all_contexts)
            weights.append(np.log(np.maximum(left, 1e-12)).astype(np.float32))
        return cls(languages, order, keys, logs, context_keys, weights, floor)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Summed log probability of each word with its end mark, by language."""
        codes, depth = _codes(words)
        grams = _grams(codes, self.order)
        zero = np.zeros(1, np.uint64)
        at, seen = _find(self.keys[0], grams[0])
        unigram_left = self.weights[0][_find(self.context_keys[0], zero)[0][0]] if len(self.context_keys[0]) else 0
        score = np.where(seen[:, None], self.logs[0][at], np.log(self.floor) + unigram_left)
        for n in range(1, self.order):
            use = np.flatnonzero(depth >= n)
            at, seen = _find(self.keys[n], grams[n][use])
            c_at, c_seen = _find(self.context_keys[n], grams[n - 1][use - 1])
            backed = score[use] + np.where(c_seen[:, None], self.weights[n][c_at], 0)
            score[use] = np.where(seen[:, None], self.logs[n][at], backed)
        score[depth == 0] = 0
        return np.add.reduceat(score, np.flatnonzero(depth == 0), axis=0)

    def calibrate(self, texts: list[tuple[str, str]], slack: float = 1.25, least: float = 1.0) -> None:
        """Set the rejection limits from texts that the models have not been trained on. A text of n characters
        is rejected if its cross-entropy is beyond the language's mean by more than d + 8 / sqrt(n), where d is
        ``slack`` times what the calibration texts need, ``least`` at least. Texts that another language's model wins
        are left out, as their labels are in doubt, unless a language has no others."""
        kinds = len(self.languages)
        self.mean, self.limit = np.full(kinds, np.inf), np.full(kinds, least)
        scorer, by = Scorer(self), {x: [] for x in self.languages}
        for lang, text in texts:
            if (found := scorer.entropy(text)) is not None:
                own = self.languages.index(lang)
                by[lang].append((found[0][own], found[1], found[0].argmin() == own))
        for k, lang in enumerate(self.languages):
            if by[lang]:
                won = [x[:2] for x in by[lang] if x[2]] or [x[:2] for x in by[lang]]
                ce, n = (np.array(x, float) for x in zip(*won, strict=True))
                self.mean[k] = np.average(ce, weights=n)
                self.limit[k] = max(least, slack * (ce - self.mean[k] - 8 / np.sqrt(n)).max())


class Scorer:
    """Scores texts; keeps the scores of at most ``limit`` letter runs."""

    def __init__(self, models: LanguageModels, limit: int = 300_000) -> None:
        self.models, self.limit = models, limit
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.models.languages)), np.float64)

    def _learn(self, words: list[str]) -> None:
        have = len(self.index)
        while have + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[have : have + len(words)] = self.models.word_scores(words)
        self.index.update(zip(words, range(have, have + len(words)), strict=True))

    def entropy(self, text: str | None) -> tuple[np.ndarray, int] | None:
        """Cross-entropy per character by language, and the number of characters; None without letters."""
        words = letter_runs(text) if text else []
        if not words or not self.models.languages:
            return None
        if len(self.index) > self.limit:
            self._reset()
        new = list({w for w in words if w not in self.index})
        if new:
            self._learn(new)
        n = sum(map(len, words)) + len(words)
        return -self.table[list(map(self.index.__getitem__, words))].sum(axis=0) / n, n

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the text is rejected."""
        found = self.entropy(text)
        if found is None:
            return UNKNOWN, 0.0, True
        ce, n = found
        m, best = self.models, int(ce.argmin())
        odds = np.exp(-(ce - ce[best]) * min(n, 40))
        rejected = m.mean is not None and bool(ce[best] > m.mean[best] + m.limit[best] + 8 / np.sqrt(n))
        return m.languages[best], float(1 / odds.sum()), rejected


def _bucket(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def training_documents(docs: DataFrame, per_language: int, id_col: str = "doc_id") -> DataFrame:
    """``lang, text, part`` of at most ``per_language`` documents of each language that may be learnt from, drawn by
    a hash of the id; part 0 is for calibration, parts 1 to 4 for counting."""
    allowed = docs.where(F.col("lang").isNotNull() & (_bucket(id_col) % 4 != 2)).select(
        "lang", "text", F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("place")
    )
    counts = allowed.groupBy("lang").count().collect()  # a row per language, as there is a model per language
    # Twice the wanted share passes the hash first, where the text is read, so that only a bounded number of rows is
    # sorted for the exact cut.
    draw = F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    shares = [F.lit(x) for r in counts for x in (r["lang"], 2.0 * per_language / r["count"])]
    share = F.element_at(F.create_map(*shares), F.col("lang")) if shares else F.lit(0.0)
    return (
        allowed.where(draw < share)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", F.xxhash64("text"))))
        .where(F.col("rank") <= per_language)
        .select("lang", "text", (F.col("rank") % 5).alias("part"))
    )


def fit(docs: DataFrame, per_language: int = 600, order: int = ORDER) -> LanguageModels:
    """Train on a bounded sample of labelled documents: ``per_language`` of each language, drawn by a hash of the
    id. Only the sample's counted letter runs, and its calibration texts, come to the driver."""
    sample = checkpointed(training_documents(docs, per_language))

    def runs(langs, texts):
        from collections import Counter

        found = Counter((x, w) for x, t in zip(langs, texts, strict=True) if t for w in letter_runs(t))
        return [[k[0] for k in found], [k[1] for k in found], list(found.values())]

    counted = map_lists(sample.where("part > 0"), runs, "lang string, word string, n long", "lang", "text")
    words: dict[str, dict[str, int]] = {}
    for row in counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toLocalIterator():
        words.setdefault(row.lang, {})[row.word] = row.n
    models = LanguageModels.train(words, order)
    models.calibrate([(r.lang, r.text) for r in sample.where("part = 0").toLocalIterator() if r.lang in words])
    return models


def predict(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``; one row per input row, from its whole text.

    A text that is null or has no letter gets ``und``, score 0 and is rejected; so does every text if there is
    nothing to learn from. Ids may be null or repeated; other columns are ignored. Map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # a few MB: bounded by the sample
    key = uuid.uuid4().hex

    def run(ids, held, texts):
        scorer = kept(key, lambda: Scorer(shared.value))
        found = [scorer.predict(t) for t in texts]
        return [ids, held, [x[0] for x in found], [x[1] for x in found], [x[2] for x in found]]

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), (_bucket(id_col) % 4 == 2).alias("_held"), F.col(text_col).alias("_text"))
    return map_lists(rows, run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean", "_id", "_held", "_text")


def accepted(docs: DataFrame, per_language: int = 600) -> DataFrame:
    """The rows of ``docs``, all columns as they were, whose text is not rejected by models learnt from ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, per_language))
    key, at = uuid.uuid4().hex, docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scorer = kept(key, lambda: Scorer(shared.value))
            yield batch.filter(pa.array([not scorer.predict(t.as_py())[2] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
