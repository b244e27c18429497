"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string exactly one vocabulary token can end its encoding. Storing that token for
each prefix gives the whole encoding by walking back, makes appending exact (earlier entries never change)
and lets an edit be re-encoded from the edited place on. A token may follow another if the pair, merged by
rank from its bytes, stays that pair.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

from .common import kept, map_lists, read


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


#: The letters and numbers below U+0250.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
#: Control characters that the two libraries treat otherwise as white space, and all from U+0250.
_NOT_LATIN = re.compile("[\x1c-\x1f\u0250-\U0010ffff]").search


def _classes(pattern: str) -> str:
    """The pattern with its classes for letters and numbers spelt out, in and outside of brackets."""
    inside = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(r"\p{L}", LETTERS).replace(r"\p{N}", NUMBERS), pattern)
    return inside.replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", f"[{NUMBERS}]")


class Vocabulary:
    """Ranks, decoding table and the memo of which pairs of tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int], memo: int = 1_000_000) -> None:
        self.ranks, self.memo = ranks, memo
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.text_of = {rank: str(rank) for rank in self.bytes_of}
        self._pairs: dict[int, bool] = {}
        self._splits: dict[int, tuple[int, int] | None] = {}
        self._spines: dict[int, list[int]] = {}
        self._automaton = None

    def merge(self, raw: bytes) -> list[int]:
        """Merge by rank, lowest first, leftmost first on ties; for short strings only."""
        return self.merge_with(self.ranks, raw)

    @staticmethod
    def merge_with(ranks: dict[bytes, int], raw: bytes) -> list[int]:
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the token's last merge joins; None for a byte."""
        if token not in self._splits:
            raw = self.bytes_of[token]
            others = {k: v for k, v in ((raw[i:j], self.ranks.get(raw[i:j])) for i in range(len(raw)) for j in range(i + 1, len(raw) + 1)) if v is not None and v != token}
            parts = Vocabulary.merge_with(others, raw)
            self._splits[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._splits[token]

    def spine(self, token: int, side: int) -> list[int]:
        """The token and, from large to small, the parts of it that touch its left (0) or right (1) end."""
        key = token << 1 | side
        found = self._spines.get(key)
        if found is None:
            found = [token]
            while len(self.bytes_of[found[-1]]) > 1 and (parts := self.split(found[-1])):
                found.append(parts[side])
            self._spines[key] = found
        return found

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the pair's bytes gives the pair: no merge across the border comes before the merges
        that take the parts beside the border into larger ones. On equal ranks the left merge comes first."""
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is not None:
            return known
        xs, ys, ranks, bytes_of = self.spine(left, 1), self.spine(right, 0), self.ranks, self.bytes_of
        i, j, never = len(xs) - 1, len(ys) - 1, 1 << 40
        while True:
            x_goes, y_goes = xs[i - 1] if i else never, ys[j - 1] if j else never
            across = ranks.get(bytes_of[xs[i]] + bytes_of[ys[j]])
            if across is not None and across < x_goes and across <= y_goes:
                known = False
                break
            if not i and not j:
                known = True
                break
            if x_goes <= y_goes:
                i -= 1
            else:
                j -= 1
        if len(self._pairs) > self.memo:
            self._pairs.clear()
        self._pairs[key] = known
        return known

    @property
    def suffixes(self):
        """Automaton that gives, at each byte, the tokens that end there. Tokens that merging can't give are left out."""
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for token, rank in self.ranks.items():
                if len(token) == 1 or self.merge(token) == [rank]:
                    self._automaton.add_word(token.decode("latin-1"), (rank, len(token)))
            self._automaton.make_automaton()
        return self._automaton


class PrefixEncoder:
    """The encoding of a growing byte string; ``last[i]`` is the token that ends the prefix of length i + 1."""

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b"") -> None:
        self.vocabulary, self.raw, self.last = vocabulary, b"", []
        self.append(raw)

    def append(self, more: bytes) -> PrefixEncoder:
        """Extend the string; only the new prefixes are computed."""
        start, self.raw = len(self.raw), self.raw + more
        last, v = self.last, self.vocabulary
        base = max(0, start - v.longest + 1)
        last.extend([-1] * len(more))
        pairs, may_follow = v._pairs.get, v.may_follow
        for end, (token, size) in v.suffixes.iter(self.raw[base:].decode("latin-1")):
            end += base
            if last[end] < 0 and end >= start:
                if (before := end - size) < 0:
                    last[end] = token
                else:
                    left = last[before]
                    known = pairs(left << 20 | token)
                    if known or (known is None and left >= 0 and may_follow(left, token)):
                        last[end] = token
        if -1 in last[start:]:
            raise ValueError("a byte is not in the vocabulary")
        return self

    def edit(self, begin: int, end: int, new: bytes) -> PrefixEncoder:
        """Replace ``raw[begin:end]``. Prefixes before the edit are kept; behind it they are computed until as
        many as the longest token in a row agree with the old ones, from where all later ones agree too."""
        v, old_raw, old = self.vocabulary, self.raw, self.last
        tail, shift = old_raw[end:], len(new) - (end - begin)
        self.raw, self.last = old_raw[:begin], old[:begin]
        self.append(new)
        same = 0
        for i in range(len(tail)):
            self.append(tail[i : i + 1])
            same = same + 1 if self.last[-1] == old[end + i] and len(v.bytes_of[old[end + i]]) <= i + 1 else 0
            if same >= v.longest:
                at = len(self.raw) - shift
                self.raw += old_raw[at:]
                self.last += old[at:]
                break
        return self

    def tokens(self) -> list[int]:
        out, at, sizes = [], len(self.raw), self.vocabulary.bytes_of
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(sizes[token])
        return out[::-1]


class TextEncoder:
    """Encodes texts piece by piece; at most ``limit`` pieces are remembered, then the cache is emptied."""

    def __init__(self, ranks_path: str, pattern: str, limit: int = 300_000) -> None:
        import regex

        self.vocabulary = Vocabulary(load_ranks(ranks_path))
        self.split_any = regex.compile(pattern).findall
        # In texts of Latin characters only, the classes can be spelt out for the faster standard library.
        self.split_latin = re.compile(_classes(pattern)).findall
        self.limit, self.cache = limit, {}

    def split(self, text: str) -> list[str]:
        return (self.split_any if _NOT_LATIN(text) else self.split_latin)(text)

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        whole = self.vocabulary.ranks.get(raw)
        found = (whole,) if whole is not None else tuple(PrefixEncoder(self.vocabulary, raw).tokens())
        if len(raw) <= 256:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            self.cache[piece] = found
        return found

    def encode(self, text: str) -> list[int]:
        pieces, get = self.split(text), self.cache.get
        return list(chain.from_iterable([get(p) or self.encode_piece(p) for p in pieces]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


def encoder(ranks_path: str, pattern: str) -> TextEncoder:
    """The worker process's encoder, kept between tasks."""
    return kept(("bpe", ranks_path, pattern), lambda: TextEncoder(ranks_path, pattern))


def _defaults(ranks_path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers

    return ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode_texts(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text; a null or empty text has none. One row per input
    row; ids may be null or repeated; other columns are ignored. Map-only."""
    path, pattern = _defaults(ranks_path, pattern)

    def run(ids, texts):
        e = encoder(path, pattern)
        return [ids, [e.encode(t) if t else [] for t in texts]]

    return map_lists(docs, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>", id_col, text_col)


def decode_texts(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """``doc_id, text``: the inverse of ``encode_texts``; null ids give null, an unknown id raises."""
    path, pattern = _defaults(ranks_path, None)

    def run(ids, tokens):
        e = encoder(path, pattern)
        return [ids, [None if t is None else e.decode(t).decode("utf-8", "replace") for t in tokens]]

    return map_lists(encoded, run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string", "doc_id", "ids")


def encode_digests(docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, encoded and decoded again.

    A null or empty text has no tokens and the digests of the empty string. Map-only."""
    path, pattern = _defaults(ranks_path, pattern)

    def run(doc_ids, texts):
        e = encoder(path, pattern)
        counts, ids_sha, decoded_sha = [], [], []
        text_of = e.vocabulary.text_of.__getitem__
        for text in texts:
            ids = e.encode(text) if text else []
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(" ".join(map(text_of, ids)).encode()).hexdigest())
            decoded_sha.append(hashlib.sha256(e.decode(ids)).hexdigest())
        return [doc_ids, counts, ids_sha, decoded_sha]

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_lists(docs, run, schema, "doc_id", "text")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read(spark, sf_dir, "documents"))
