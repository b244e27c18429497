"""SimHash near-duplicates, joined by the generalised pigeonhole principle.

If two fingerprints differ in at most k bits, and the bits are split into m parts with thresholds t of which the
sum is k - m + 1, then in at least one part they differ in at most that part's t bits. Correlated bits stand in
one part, and the thresholds are not equal: dynamic programming allots them so that the number of candidates,
known from counts of all fingerprints, is least. A part with threshold -1 is not looked at; one with 0 is joined
on equality; one with more is probed with all values so near. Candidates are verified on the full fingerprints.

Equal fingerprints are one node. What a bucket sends on is a spanning forest of its links, never all its pairs;
a bucket with very many fingerprints is split again by the pigeonhole principle on the remaining bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, map_lists, place_of, read
from .graph import components

BITS = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a whole text's word shingles, A-Z lower-cased; 0 without words."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())]
    bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(found), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every document. Map-only."""

    def run(ids, texts):
        return [ids, np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]

    return map_lists(docs, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long", id_col, text_col)


def _bit_matrix(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j set: 64 x 64, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            bits = _bit_matrix(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS), pa.int32()), pa.array(total.ravel().astype(np.int64))], names=["at", "n"])

    rows = fps.select("fp").mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4,096 rows
    out = np.zeros(BITS * BITS)
    for r in rows:
        out[r["at"]] = r["n"]
    return out.reshape(BITS, BITS)


def group_bits(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of equal size: each starts with the bit most correlated to others left and takes,
    one by one, the bit most correlated to those it has."""
    p = np.diag(both) / max(1, total)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(1, total) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def part_keys(fps: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    """The value of each group's bits, by group."""
    u = fps.astype(np.int64).view(np.uint64)
    out = []
    for group in groups:
        key = np.zeros(len(u), np.int64)
        for i, b in enumerate(group):
            key |= ((u >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
        out.append(key)
    return out


def _near(width: int, threshold: int) -> list[int]:
    """Masks of 1 to ``threshold`` of ``width`` bits."""
    return [sum(1 << b for b in c) for t in range(1, threshold + 1) for c in combinations(range(width), t)]


def allot(histograms: list[np.ndarray], distance: int, probe_cost: float = 4.0) -> list[int]:
    """Thresholds, -1 or more, with sum ``distance - parts + 1`` for which pairs to verify plus ``probe_cost`` times rows
    sent are fewest. A histogram counts the fingerprints by value of a part."""
    parts, most = len(histograms), min(2, distance)
    cost = np.full((parts, most + 2), np.inf)
    for i, h in enumerate(histograms):
        n, width = h.sum(), int(len(h)).bit_length() - 1
        values, at = h.astype(np.float64), np.arange(len(h))
        pairs, probes = (values * (values - 1)).sum() / 2, 1.0
        cost[i, 0], cost[i, 1] = 0.0, pairs + probe_cost * n
        for t in range(1, most + 1):
            masks = [m for m in _near(width, t) if bin(m).count("1") == t]
            pairs += sum((values * values[at ^ m]).sum() for m in masks)
            probes += len(masks)
            cost[i, t + 1] = pairs + probe_cost * n * probes
    # best[s]: least cost of the first parts with thresholds that sum to s
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(parts):
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t in range(-1, most + 1):
                here = (c + cost[i, t + 1], [*ts, t])
                if s + t not in new or here[0] < new[s + t][0]:
                    new[s + t] = here
        best = new
    return best[distance - parts + 1][1]


def forest(fps: np.ndarray, distance: int, probes: np.ndarray | None = None, parts: int = 4, brute: int = 4096) -> list[tuple[int, int]]:
    """A spanning forest of the links between distinct fingerprints, or with ``probes`` between each of these and ``fps``."""
    nodes = np.unique(fps if probes is None else np.concatenate([fps, probes]))
    label = np.arange(len(nodes))
    edges: list[tuple[int, int]] = []

    def brute_force(own: np.ndarray, other: np.ndarray) -> None:
        a, b = nodes[own].view(np.uint64), nodes[other].view(np.uint64)
        rows = max(1, 4_000_000 // max(1, len(b)))
        for i in range(0, len(a), rows):
            near = np.bitwise_count(a[i : i + rows, None] ^ b[None, :]) <= distance
            for r in np.flatnonzero(near.sum(axis=1) > (own is other)):
                x = own[i + r]
                hits = other[near[r]]
                found, first = np.unique(label[hits], return_index=True)
                if len(found) > 1 or found[0] != label[x]:
                    edges.extend((int(nodes[x]), int(nodes[hits[k]])) for k, f in zip(first, found, strict=True) if f != label[x])
                    merged = np.append(found, label[x])
                    label[np.isin(label, merged)] = merged.min()

    def split(own: np.ndarray, bits: list[int], depth: int) -> None:
        if len(own) <= brute or depth > 2:
            brute_force(own, own)
            return
        size = max(1, len(bits) // parts)
        for k in range(parts):
            group = bits[k * size : (k + 1) * size if k < parts - 1 else len(bits)]
            key = part_keys(nodes[own], [group])[0]
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            for sub in np.split(own[order], cuts):
                if len(sub) > 1:
                    split(sub, [b for b in bits if b not in group], depth + 1)

    if probes is None:
        split(np.arange(len(nodes)), list(range(BITS)), 0)
    else:
        brute_force(np.searchsorted(nodes, np.unique(fps)), np.arange(len(nodes)))
    return edges


def links(fps: DataFrame, distance: int = 3, parts: int = 4, split_from: int = 1000) -> DataFrame:
    """``a, b``: links between the distinct fingerprints ``fps`` (column fp) that connect all that are within
    ``distance`` bits, in one step or over others; each verified. Fingerprints are never null here."""
    total = fps.count()
    groups = group_bits(bit_counts(fps), total, parts)
    shared_groups = groups

    def count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = part_keys(batch.column(0).to_numpy(zero_copy_only=False), shared_groups)
            part = np.repeat(np.arange(parts, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.concatenate(keys))], names=["part", "key"])

    # At most 65,536 counts for each of the four parts.
    counted = fps.select("fp").mapInArrow(count_keys, "part int, key long").groupBy("part", "key").count().toPandas()
    histograms = []
    for k, group in enumerate(groups):
        h = np.zeros(1 << len(group), np.int64)
        mine = counted[counted["part"] == k]
        h[mine["key"].to_numpy()] = mine["count"].to_numpy()
        histograms.append(h)
    thresholds = allot(histograms, distance)
    masks = [np.array([0, *_near(len(g), t)], np.int64) if t >= 0 else np.zeros(0, np.int64) for g, t in zip(groups, thresholds, strict=True)]
    large = [h >= split_from for h in histograms]
    rest = [[b for g2 in groups if g2 is not g for b in g2] for g in groups]
    seconds = [[r[j :: distance + 1] for j in range(distance + 1)] for r in rest]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            for k, key in enumerate(part_keys(x, groups)):
                if not len(masks[k]):
                    continue
                for m in masks[k]:
                    at = key ^ m
                    hot = large[k][at] if thresholds[k] == 0 else np.zeros(len(x), bool)
                    cold = np.flatnonzero(~hot)
                    shares = [(cold, np.zeros(len(cold), np.int64))]
                    if hot.any():
                        own = np.flatnonzero(hot)
                        shares += [(own, (sub + 1) << 8 | (j + 1)) for j, sub in enumerate(part_keys(x[own], seconds[k]))]
                    for rows, sub in shares:
                        if len(rows):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(rows), k, np.int32)), pa.array(at[rows]), pa.array(sub), pa.array(np.full(len(rows), m != 0)), pa.array(x[rows])],
                                names=["part", "key", "sub", "probe", "fp"],
                            )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def solve(t: pa.Table) -> pa.RecordBatch:
            part, key, sub, probe, x = (t.column(i).to_numpy() for i in range(5))
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(key) != 0) | (np.diff(sub) != 0)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(x)]])
            out: list[tuple[int, int]] = []
            for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
                own = x[a:b][~probe[a:b]]
                if b - a == 2 and len(own):
                    apart = ((int(x[a]) ^ int(x[a + 1])) & (2**64 - 1)).bit_count()
                    if 0 < apart <= distance:
                        out.append((int(x[a]), int(x[a + 1])))
                elif len(own):
                    out += forest(own, distance, x[a:b][probe[a:b]] if probe[a:b].any() else None)
            return pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in range(2)], schema=schema)

        # Batches are sorted: only the rows of the last, perhaps unfinished, bucket wait for the next batch.
        for batch in batches:
            t = pa.Table.from_batches([batch]) if carry is None else pa.concat_tables([carry, pa.Table.from_batches([batch])])
            part, key, sub = (t.column(i).to_numpy() for i in range(3))
            same = (part == part[-1]) & (key == key[-1]) & (sub == sub[-1])
            cut = len(same) - int(same.sum()) if len(same) else 0
            if cut:
                yield solve(t.slice(0, cut))
            carry = t.slice(cut)
        if carry is not None and carry.num_rows:
            yield solve(carry)

    sent = fps.select("fp").mapInArrow(send, "part int, key long, sub long, probe boolean, fp long")
    return sent.repartition("part", "key", "sub").sortWithinPartitions("part", "key", "sub").mapInArrow(join, "a long, b long")


def _rooted(found: DataFrame, distance: int) -> DataFrame:
    """``fp, first, root`` of the distinct fingerprints of ``doc_id, fp`` rows: the least doc_id, and the component."""
    classes = checkpointed(found.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(classes, distance))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, distance: int = 3, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, fingerprint, component_id`` of every document; one row per input row.

    Documents link if their fingerprints differ in at most ``distance`` bits; a component is what links reach, and
    its id the smallest doc_id in it. Null, empty and blank texts have fingerprint 0, which links like any other.
    Null ids count in no minimum, so that a component of null ids only has a null id. Other columns are ignored."""
    found = checkpointed(fingerprints(docs, shingle))  # 16 bytes a document
    rooted = _rooted(found, distance)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("_fp"), "component_id")
    return found.join(named, F.col("fp") == F.col("_fp")).select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, distance: int = 3, shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns as they were, that stay: of each component of ``near_duplicates`` the row at the
    first place (``common.place_of``), that is the smallest doc_id, rows without one last."""
    doc, th = place_of("doc_id", "text")
    found = checkpointed(fingerprints(docs.select(F.struct(doc.alias("doc"), th.alias("th")).alias("doc_id"), "text"), shingle))
    return rows_to_keep(docs, _rooted(found, distance).groupBy("root").agg(F.min("first").alias("p")).select("p.*"))


def rows_to_keep(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``docs`` at the given places (``doc, th``, see ``place_of``); of rows at one place, which have one id and
    one text, one stays, always the same."""
    keep = docs.columns
    doc, th = place_of("doc_id", "text")
    marked = docs.withColumns({"_doc": doc, "_th": th, "_order": F.xxhash64(*(F.col(f"`{c}`") for c in keep))})
    wanted = places.select(F.col("doc").alias("_doc"), F.col("th").alias("_th")).distinct()
    order = F.row_number().over(Window.partitionBy("_doc", "_th").orderBy("_order"))
    return marked.join(wanted, ["_doc", "_th"], "left_semi").withColumn("_place", order).where("_place = 1").select(*(F.col(f"`{c}`") for c in keep))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
