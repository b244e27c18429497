"""Token counts by a two-tier lookup, without shuffling pre-tokens.

The tokenizer's pieces never hold a space mark after another character, nor a line feed, so its merges
never cross the start of a run of spaces or a line feed. A text's token count is therefore the sum of the
counts of its *pre-tokens*. Each is looked up first in a compact broadcast hash table of the frequent ones, then in a
bounded cache that the worker process keeps between tasks; what is in neither is encoded by the library.

Which pre-tokens are frequent is counted on a bounded sample of documents (``SAMPLE``), drawn by a hash; the table holds
the ``FREQUENT`` most frequent of them, of at most ``LONGEST`` bytes, with their lengths in tokens: its size is bounded by
these parameters. It alters speed only, never a count: every text is counted whole, from exact lengths.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_lists, read

MARK = "▁"  # how the tokenizer writes a space
#: Documents of the sample, entries of the broadcast table, and bytes of an entry, at most.
SAMPLE, FREQUENT, LONGEST = 2000, 50_000, 32
_PIECES = re.compile(r" +[^ \n]*|[^ \n]+|\n")


@dataclass
class FrequentLengths:
    """Open-addressing table from pre-token to token count, in three flat arrays and one blob."""

    slots: np.ndarray  # index of an entry plus 1, or 0
    ends: np.ndarray
    counts: np.ndarray
    blob: bytes

    @classmethod
    def of(cls, lengths: dict[str, int]) -> FrequentLengths:
        size = 1 << max(4, (2 * len(lengths)).bit_length())
        slots, ends, counts, blob = np.zeros(size, np.int32), [0], [], []
        for n, (word, count) in enumerate(lengths.items(), 1):
            raw = word.encode()
            at = xxhash.xxh32_intdigest(raw) & (size - 1)
            while slots[at]:
                at = (at + 1) & (size - 1)
            slots[at] = n
            blob.append(raw)
            ends.append(ends[-1] + len(raw))
            counts.append(count)
        return cls(slots, np.array(ends, np.int32), np.array(counts, np.int32), b"".join(blob))

    def get(self, word: str) -> int | None:
        raw, mask = word.encode(), len(self.slots) - 1
        at = xxhash.xxh32_intdigest(raw) & mask
        while n := int(self.slots[at]):
            if self.blob[self.ends[n - 1] : self.ends[n]] == raw:
                return int(self.counts[n - 1])
            at = (at + 1) & mask
        return None

    def expanded(self) -> dict[str, int]:
        """The table as a dictionary, which a worker makes once: it is looked up for every pre-token of every text."""
        return {self.blob[a:b].decode(): int(n) for a, b, n in zip(self.ends, self.ends[1:], self.counts)}


def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def decomposes(model) -> bool:
    """Whether the vocabulary allows counting by pre-tokens: no piece crosses the start of one."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return not any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in pieces)


def pre_tokens(text: str) -> list[str]:
    """The lookup keys of a text. A key that starts with a line feed is a pre-token without a space before it
    (it follows a line feed); other keys had a space before them, which the key leaves out."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " not in text and " \n" not in text and "\n " not in text and text[0] != " " != text[-1]:
        first, *lines = text.split("\n")
        keys = first.split(" ") if first else [""]
        for line in lines:
            keys.append("\n")
            if line:
                head, *rest = line.split(" ")
                keys.append("\n" + head)
                keys += rest
        return keys
    return [p if p == "\n" else p[1:] if p[0] == " " else "\n" + p for p in _PIECES.findall(" " + text)]


class TokenCounter:
    """Counts tokens of whole texts. The cache holds at most ``limit`` pre-tokens and is emptied when full."""

    def __init__(self, path: str, table: FrequentLengths | None = None, limit: int = 400_000) -> None:
        self.model, self.limit = processor(path), limit
        self.frequent = table.expanded() if table else {}
        self.line_feed = self.model.encode("\n")[-1]
        # A single mark, and a line feed, are one token each.
        self.cache: dict[str, int] = {"": 1, "\n": 1}

    def lengths(self, keys: list[str]) -> list[int]:
        """Tokens of each key, from the library, in one call for those after a space and one for those after a line feed:
        a line feed, which is a token of its own, stands before each pre-token."""
        out: dict[str, int] = {}
        after_line = [k for k in keys if k[0] == "\n"]
        after_space = [k for k in keys if k[0] != "\n"]
        for missing, text in (after_space, "".join("\n " + k for k in after_space)), (after_line, "".join(after_line)):
            if missing:
                ids = np.array(self.model.encode(text), np.int32)
                starts = np.append(np.flatnonzero(ids == self.line_feed), len(ids))
                out.update(zip(missing, (np.diff(starts) - 1).tolist(), strict=True))
        return [out[k] for k in keys]

    def counts(self, texts: list[str | None]) -> list[int]:
        out = []
        for text in texts:
            if not text:
                out.append(0)
                continue
            keys = pre_tokens(text)
            found = list(map(self.frequent.get, keys))
            total = sum(filter(None, found))
            if None in found:
                rest = [k for k, n in zip(keys, found) if n is None]
                missing = list({k for k in rest if k not in self.cache})
                if missing:
                    self.cache.update(zip(missing, self.lengths(missing), strict=True))
                total += sum(map(self.cache.__getitem__, rest))
                if len(self.cache) > self.limit:
                    self.cache = {"": 1, "\n": 1}
            out.append(total)
        return out


def frequent_lengths(docs: DataFrame, path: str, sample: int = SAMPLE, most: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text") -> FrequentLengths:
    """The most frequent pre-tokens of about ``sample`` documents with their token counts. Pre-tokens are counted on the
    workers and added up; only the table's ``most`` entries come to the driver."""
    draw = F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(min(1.0, sample / max(1, docs.count())) * (1 << 20))

    def count(texts):
        from collections import Counter

        found = Counter(k for t in texts if t for k in pre_tokens(t) if k not in ("", "\n") and len(k.encode()) <= LONGEST)
        return [list(found), list(found.values())]

    counted = map_lists(docs.where(draw).select(F.col(text_col).alias("text")), count, "word string, n long", "text")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).collect()
    words = [r.word for r in rows]
    return FrequentLengths.of(dict(zip(words, TokenCounter(path).lengths(words), strict=True)))


_counters: dict[str, TokenCounter] = {}  # of this worker process, by table


def token_counts(docs: DataFrame, model_path: str | None = None, max_tokens: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count of every text: ``doc_id, n_bytes, n_tokens, over_limit``; one row per input row.

    A null or empty text has 0 bytes and 0 tokens. Ids may be null or repeated; other columns of ``docs``
    are not looked at. Texts of any length are counted whole. Map-only; no pre-token of the corpus is shuffled.
    """
    import public_tokenizers

    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    model = processor(path)
    if not decomposes(model):
        raise ValueError("this vocabulary has pieces that cross pre-tokens; its texts can't be counted by parts")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, id_col=id_col, text_col=text_col))
    key = uuid.uuid4().hex

    def count(ids, texts):
        counter = _counters.get(key)
        if counter is None:
            _counters.clear()
            counter = _counters[key] = TokenCounter(path, table.value)
        found = counter.counts(texts)
        return [ids, [len(t.encode()) if t else 0 for t in texts], found, [n > max_tokens for n in found]]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_lists(docs, count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", id_col, text_col)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"))
