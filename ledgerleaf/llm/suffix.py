"""Repeated passages, found with sorted suffixes.

Every string of ``length`` bytes contains one *anchor*: the place whose ``gram`` bytes hash least among those that
begin in it, the leftmost if several do. Equal strings have equal anchors at equal offsets, so only anchors, one
in some 170 bytes, are gathered, with the run of starting places that they stand for. An anchor whose bytes stand
nowhere else is done with. Runs that are equal as a whole are one from there on: equal BLAKE2b digests of all their bytes
decide that, in a count before the shuffle. For the different runs of an anchor the texts around it are sorted, what
follows the anchor and what stands before it, read backwards, by deep-shallow sorting on the bytes themselves; from
the two orders follows for each starting place whether another text agrees over all ``length`` bytes.

An anchor may have very many different surroundings, as at the edges of a passage that a third of all documents
share. A string that starts d bytes before its anchor, with d between two bounds, shares all bytes from the nearer bound's
distance before the anchor to what the farther bound leaves behind it. Such an anchor's texts are therefore sent once for
each of a few ranges of d, keyed by those shared bytes, and sorted per key. Where even that leaves many, each d is a
range of its own: then the shared bytes are the string, and counting equal ones answers the question. The rows sent
grow in proportion to the texts; no two shares of a group are ever compared with each other.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, read
from .lines import release
from .rolling import Rolling
from .suffixsort import deep_shallow

LENGTH, GRAM = 400, 64
_NO_ID = (1 << 63) - 1


def anchor_places(values: np.ndarray, window: int) -> np.ndarray:
    """For each place, that of the least value among ``window`` from there on, the leftmost on ties."""
    n = len(values) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, width = np.arange(len(values)), 1
    while 2 * width <= window:
        left, right = best[: len(best) - width], best[width:]
        best = np.where(values[left] <= values[right], left, right)
        width *= 2
    left, right = best[:n], best[window - width : window - width + n]
    return np.where(values[left] <= values[right], left, right)


def runs(buffer: np.ndarray, ends: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of starting places of all texts in the buffer (``ends``: where each text ends): by run the text's number,
    anchor, first and last start, the hash of the anchor, and the digest (in two halves) of all bytes that the run's
    strings cover."""
    if len(buffer) < length:
        return {k: np.zeros(0, np.int64) for k in ("text", "anchor", "first", "last", "g", "s1", "s2")}
    one, two = Rolling(buffer, 0), Rolling(buffer, 1)
    every = np.arange(len(buffer) - gram + 1)
    place = anchor_places(one.hashes(every, gram), length - gram + 1)
    starts = np.arange(len(place))
    text = np.searchsorted(ends, starts, side="right")
    valid = starts + length <= ends[np.minimum(text, len(ends) - 1)]
    starts, place, text = starts[valid], place[valid], text[valid]
    new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    first, last = starts[new], starts[np.append(new[1:], len(starts)) - 1] if len(new) else starts[new]
    anchor = place[new]
    view = memoryview(buffer)
    digests = b"".join([blake2b(view[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)])
    halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return {"text": text[new], "anchor": anchor, "first": first, "last": last, "g": two.hashes(anchor, gram), "s1": halves[:, 0], "s2": halves[:, 1]}


def _chunks(batch: pa.RecordBatch, length: int, most: int = 1 << 21) -> Iterator[list[tuple[int, int, bytes]]]:
    """(row, offset, bytes) of some texts at once. A long text comes in pieces of ``most`` starting places, which overlap by
    what a string that begins in one reaches into the next."""
    pieces, have = [], 0
    for k, t in enumerate(batch.column("text")):
        raw = (t.as_py() or "").encode()
        if len(raw) < length:
            continue
        for a in range(0, len(raw) - length + 1, most):
            if pieces and have + min(len(raw) - a, most) > most:
                yield pieces
                pieces, have = [], 0
            piece = raw[a : a + most + length - 1]
            pieces.append((k, a, piece))
            have += len(piece)
    if pieces:
        yield pieces


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc, hash, text``: rows with equal ids but different texts are told apart by the text's hash."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("hash"), "text")


def _anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    schema = pa.schema([("g", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("doc", pa.int64()), ("hash", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("least", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, key = batch.column("doc").to_numpy(), batch.column("hash").to_numpy()
            for pieces in _chunks(batch, length):
                ends = np.cumsum([len(raw) for _, _, raw in pieces])
                found = runs(np.frombuffer(b"".join([raw for _, _, raw in pieces]), np.uint8), ends, length, gram)
                text = found["text"].astype(np.int64)
                row = np.array([k for k, _, _ in pieces], np.int64)[text]
                # Where the text, not the piece, begins in the buffer.
                begin = np.concatenate([[0], ends])[text] - np.array([a for _, a, _ in pieces], np.int64)[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(found[c]).view(np.int64)) for c in ("g", "s1", "s2")]
                    + [pa.array(doc[row]), pa.array(key[row])]
                    + [pa.array(x.astype(np.int32)) for x in (found["anchor"] - begin, found["anchor"] - found["first"], found["anchor"] - found["last"])],
                    schema=schema,
                )

    return docs.mapInArrow(run, "g long, s1 long, s2 long, doc long, hash long, at int, before int, least int")


def repeated_starts(contexts: list[tuple[bytes, int, int, bool]], length: int) -> list[list[tuple[int, int]]]:
    """For texts around one anchor, given as (bytes, anchor's place, least distance of a start, known), the distances
    d from start to anchor (from, to) at which the ``length`` bytes from the start also stand in another text.

    The texts are merged by the length of what they share before the anchor, longest first. In each set the texts are
    kept in the order of what follows the anchor, so that a text's best partner is its neighbour there."""
    rights = [raw[at:] for raw, at, _, _ in contexts]
    lefts = [raw[:at][::-1] for raw, at, _, _ in contexts]
    order, shared = deep_shallow(rights)
    rank = [0] * len(order)
    for n, k in enumerate(order):
        rank[k] = n
    # Least common prefix between two ranks, by powers of two.
    table = [shared]
    while 2 * len(table[-1]) > len(shared) and (step := 1 << (len(table) - 1)) < len(shared):
        table.append([min(a, b) for a, b in zip(table[-1], table[-1][step:], strict=False)])

    def agree(a: int, b: int) -> int:
        low, high = min(a, b) + 1, max(a, b) + 1
        k = (high - low).bit_length() - 1
        return min(table[k][low], table[k][high - (1 << k)])

    left_order, left_shared = deep_shallow(lefts)
    sets: list[list[int] | None] = [[rank[k]] for k in range(len(contexts))]
    owner = list(range(len(contexts)))
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]

    def find(k: int) -> int:
        while owner[k] != k:
            owner[k] = owner[owner[k]]
            k = owner[k]
        return k

    def meet(a: int, b: int, before: int) -> None:
        low = length - agree(a, b)
        if low <= before:
            for k in order[a], order[b]:
                if not found[k] or found[k][-1][0] > low or found[k][-1][1] < before:
                    found[k].append((low, before))

    joins = sorted(range(1, len(left_order)), key=lambda n: -left_shared[n])
    for n in joins:
        a, b = find(left_order[n - 1]), find(left_order[n])
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large, small = sets[a], sets[b]
        for x in small:
            at = bisect_left(large, x)
            if at:
                meet(large[at - 1], x, left_shared[n])
            if at < len(large):
                meet(large[at], x, left_shared[n])
        for x in small:
            insort(large, x)
        owner[b], sets[b] = a, None
    out = []
    for (raw, at, least, known), pieces in zip(contexts, found, strict=True):
        if known:
            out.append([])
            continue
        clipped = sorted((max(a, least), min(b, at)) for a, b in pieces if max(a, least) <= min(b, at))
        merged: list[tuple[int, int]] = []
        for a, b in clipped:
            if merged and a <= merged[-1][1] + 1:
                merged[-1] = (merged[-1][0], max(merged[-1][1], b))
            else:
                merged.append((a, b))
        out.append(merged)
    return out


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes that the strings of each wanted run cover, cut from the texts."""
    per_doc = wanted.groupBy("doc", "hash").agg(F.collect_list(F.struct("g", "at", "before", "least", "known")).alias("wanted"))
    joined = docs.join(per_doc, ["doc", "hash"]).dropDuplicates(["doc", "hash"]).select("doc", "hash", "text", "wanted")
    schema = pa.schema([("g", pa.int64()), ("doc", pa.int64()), ("hash", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("least", pa.int32()), ("known", pa.bool_()), ("raw", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc, key, text, list_ = (batch.column(k)[row].as_py() for k in range(4))
                raw = text.encode()
                cols = [[w[c] for w in list_] for c in ("g", "at", "before", "least", "known")]
                pieces = [raw[w["at"] - w["before"] : w["at"] - w["least"] + length] for w in list_]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip([cols[0], [doc] * len(list_), [key] * len(list_), *cols[1:], pieces], schema, strict=True)], schema=schema
                )

    return joined.mapInArrow(cut, "g long, doc long, hash long, at int, before int, least int, known boolean, raw binary")


def _ranges_of_distances(contexts: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """The rows of ``contexts`` once for each of ``parts`` ranges of distances from start to anchor, cut to what strings at
    those distances cover; ``g`` is then also a hash of the bytes that all of them share."""
    width = -(-(length - gram + 1) // parts)
    low = F.explode(F.array(*(F.lit(k * width) for k in range(parts))))
    rows = contexts.select("*", low.alias("low")).withColumn("high", F.col("low") + width - 1)
    rows = rows.where((F.col("before") >= F.col("low")) & (F.col("least") <= F.col("high")))
    shared = F.substring("raw", F.col("before") - F.col("low") + 1, length - F.col("high") + F.col("low"))
    before, least = F.least("before", "high"), F.greatest("least", "low")
    cut = F.substring("raw", F.col("before") - before + 1, before - least + length)
    return rows.select(F.xxhash64("g", "low", shared).alias("g"), "doc", "hash", "at", before.alias("before"), least.alias("least"), "known", cut.alias("raw"))


def _is_large(contexts: DataFrame, most: int) -> DataFrame:
    """``contexts`` with ``large``: whether more than ``most`` rows have the row's ``g``."""
    large = contexts.groupBy("g").count().where(F.col("count") > most).select("g", F.lit(True).alias("large"))
    return contexts.join(large, "g", "left").withColumn("large", F.coalesce("large", F.lit(False)))


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """``doc, hash, from, to`` as ``_sorted`` has it, for texts of which very many share a key: every string is a key itself
    and those that stand twice are counted."""
    d = F.explode(F.sequence("least", "before"))
    starts = contexts.select("g", "doc", "hash", "at", "before", "known", "raw", d.alias("d"))
    starts = starts.select("doc", "hash", "at", "known", "d", F.md5(F.concat(F.substring("raw", F.col("before") - F.col("d") + 1, length), F.encode(F.concat_ws(",", "g", "d"), "UTF-8"))).alias("string"))
    starts = checkpointed(starts)
    twice = starts.groupBy("string").count().where("count > 1").select("string")
    found = starts.where(~F.col("known")).join(twice, "string", "left_semi").select("doc", "hash", "at", "d").distinct()
    # Neighbouring distances as one range: at most ``length`` rows a partition.
    island = F.col("d") - F.row_number().over(Window.partitionBy("doc", "hash", "at").orderBy("d"))
    merged = found.withColumn("island", island).groupBy("doc", "hash", "at", "island").agg(F.min("d").alias("a"), F.max("d").alias("b"))
    return merged.select("doc", "hash", (F.col("at") - F.col("b")).cast("long").alias("from"), (F.col("at") - F.col("a") + length).cast("long").alias("to"))


def _sorted(contexts: DataFrame, length: int) -> DataFrame:
    """``doc, hash, from, to``: bytes that repeated strings cover, from sorting the texts of each ``g``."""
    schema = pa.schema([("doc", pa.int64()), ("hash", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def solve() -> pa.RecordBatch:
            out: list[tuple[int, int, int, int]] = []
            if len(group) > 1 and not all(x[5] for x in group):
                found = repeated_starts([(x[6], x[3], x[4], x[5]) for x in group], length)
                for x, pieces in zip(group, found, strict=True):
                    out += [(x[0], x[1], x[2] - b, x[2] - a + length) for a, b in pieces]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], schema=schema)

        for batch in batches:
            for here, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != key:
                    if group:
                        yield solve()
                    key, group = here, []
                group.append(rest)
        if group:
            yield solve()

    rows = contexts.select("g", "doc", "hash", "at", "before", "least", "known", "raw")
    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(run, "doc long, hash long, from long, to long")


def repeated_bytes(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = 1000, parts: int = 4) -> DataFrame:
    """``doc, hash, from, to``: all bytes of ``_keyed`` documents that a string standing elsewhere too covers, as
    ranges, which may overlap. An anchor, or a range of distances to it, with more than ``most`` different surroundings
    is split, first into ``parts`` ranges, then into single distances."""
    anchors = checkpointed(_anchors(keyed, length, gram))  # 52 bytes for some 170
    groups = anchors.groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    # Written before they are joined, so that the join's partitions, not the counts', can be split where one is large.
    groups = checkpointed(groups.select(F.col("g").alias("g_")))
    shared = checkpointed(anchors.join(groups, F.col("g") == F.col("g_")).select("g", "s1", "s2", "doc", "hash", "at", "before", "least"))
    del anchors
    release(keyed.sparkSession)
    spans = shared.groupBy("g", "s1", "s2").agg(F.count("*").alias("n"), F.min(F.struct("doc", "hash", "at", "before", "least")).alias("one"))
    spans = checkpointed(spans)
    kinds = checkpointed(spans.groupBy("g").count().where("count > 1").select("g"))
    wanted = spans.join(kinds, "g", "left_semi").select("g", "one.*", (F.col("n") > 1).alias("known"))
    contexts = checkpointed(_contexts(keyed, wanted, length))
    release(keyed.sparkSession)
    marked = _is_large(contexts, most)
    ranged = _is_large(checkpointed(_ranges_of_distances(marked.where("large"), length, gram, parts)), most)
    few = marked.where("not large").unionByName(ranged.where("not large"))
    sorted_ = _sorted(few, length).unionByName(_counted(ranged.where("large"), length))
    whole = shared.join(spans.where("n > 1").select("g", "s1", "s2"), ["g", "s1", "s2"], "left_semi").select(
        "doc", "hash", (F.col("at") - F.col("before")).cast("long").alias("from"), (F.col("at") - F.col("least") + length).cast("long").alias("to")
    )
    return whole.unionByName(sorted_)


def _joined_ranges(ranges: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for r in sorted((r["from"], r["to"]) for r in ranges):
        if out and r[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r[1])
        else:
            out.append(list(r))
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that stay) of every document; one row per input row.

    A null or empty text has no bytes; one shorter than ``length`` loses none. Rows with equal id and text are two
    documents, which repeat each other. Other columns are ignored."""
    keyed = _keyed(docs)
    found = repeated_bytes(keyed, length, gram).groupBy("doc", "hash").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))
    joined = keyed.join(found, ["doc", "hash"], "left").select("doc", "text", "ranges")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for doc, text, ranges in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    raw = (text or "").encode()
                    gone = _joined_ranges(ranges or [])
                    edges = [0, *(x for r in gone for x in r), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    out.append((None if doc == _NO_ID else doc, len(raw), len(raw) - len(kept), len(gone), kept))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the contract's columns: ``n_kept``, the bytes that stay, and ``text``, these bytes as text. A character that a
    removed string cuts in two shows as U+FFFD there; the digest is that of the bytes."""
    kept = without_repeats(read(spark, sf_dir, "documents"))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.octet_length("kept").cast("long").alias("n_kept"), text.alias("text"))
