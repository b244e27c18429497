"""Near-duplicate lines by a segment-partition edit join.

A line of n bytes is cut into k + 1 segments, k being the number of edits allowed. A line within k edits of it
must hold one of them unchanged, and only at the few offsets at which k edits can have shifted it; its length
differs by k at most. So every line is entered in an index under (length, segment number, segment) and looks up
the substrings, at those offsets, of its own and the k shorter lengths. Lines that meet are verified by
a banded bit-parallel edit distance.

Equal lines are one entry: a line that a third of all documents share is entered once per task. Keys that only
one line has are dropped where they meet; only the others' lines are fetched, once each. A bit map of ``SIEVE`` bits, set
where the hash of such a line falls, keeps nearly all other lines from being sent; those it lets through drop out in a join.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST, checkpointed, place_of, placed, read
from .rolling import Rolling, mix

EDITS, LEAST_BYTES, SIEVE = 2, 20, 1 << 26


def banded_distance(a: bytes, b: bytes, most: int) -> int:
    """Edit distance of two byte strings, or ``most`` + 1 if it is more: a column of the band is one small integer."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    i, n = 0, len(b)
    while i < n and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    while b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not b or not most:
        return len(a) if len(a) <= most else most + 1
    # Bits of a column: rows j - most .. j + most of the table; differences between neighbouring cells.
    width = 2 * most + 1
    full, rows = (1 << width) - 1, len(a)
    at: dict[int, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus = full & ~((1 << most) - 1), 0
    score = 0
    for j, c in enumerate(b):
        low = j - most
        same = at.get(c, 0)
        same = (same >> low if low >= 0 else same << -low) & full
        diag = ((((same & plus) + plus) ^ plus) | same | minus) & full
        h_plus = (minus | ~(diag | plus)) & full
        h_minus = diag & plus
        if not diag >> most & 1:
            score += 1  # the main diagonal's cell
        shifted = diag >> 1
        plus = (h_minus | ~(shifted | h_plus)) & full
        minus = shifted & h_plus
    # The score is that of row len(b) in the last column; go down to the last row.
    for k in range(len(b), rows):
        bit = k - len(b) + most
        score += (plus >> bit & 1) - (minus >> bit & 1)
    return min(score, most + 1)


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and size of each of ``edits`` + 1 segments of lines of the given lengths, sizes as even as can be."""
    parts, out, start = edits + 1, [], np.zeros_like(length)
    for i in range(parts):
        size = length // parts + (i >= parts - length % parts)
        out.append((start, size))
        start = start + size
    return out


def entries(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray, edits: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """``(lines, keys, indexed)``: for lines given by place in the buffer, the keys under which they are entered or
    look up. Entries also look up, so the lookup of the own length at the own place is left out."""
    rolling = Rolling(buffer)
    every = np.arange(len(starts))
    for behind in range(edits + 1):
        length = sizes - behind
        for i, (start, size) in enumerate(segments(length, edits)):
            tag = mix((length.astype(np.uint64) << np.uint64(8)) + np.uint64(i + 1))
            # Offsets that k edits allow, seen from the left and from the right end of the line.
            low, high = max(-i, behind - (edits - i)), min(i, behind + (edits - i))
            for shift in range(low, high + 1):
                fits = (start + shift >= 0) & (start + shift + size <= sizes) & (length > 0)
                rows = every[fits]
                keys = mix(rolling.hashes(starts[rows] + start[rows] + shift, size[rows]) ^ tag[rows])
                yield rows, keys, behind == 0 and shift == 0


def _lines(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' lines: buffer, starts, sizes, text number, line number."""
    raws = [t.encode() if t else None for t in texts]
    data = b"\n".join(r for r in raws if r is not None)
    buffer = np.frombuffer(data, np.uint8)
    owners = [k for k, r in enumerate(raws) if r is not None]
    counts = np.array([raws[k].count(b"\n") + 1 for k in owners], np.int64)
    if not owners:
        return (buffer, *(np.zeros(0, np.int64) for _ in range(4)))
    breaks = np.flatnonzero(buffer == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(buffer)]])
    numbers = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
    return buffer, starts, ends - starts, np.repeat(np.array(owners, np.int64), counts), numbers


def _chunks(batches: Iterator[pa.RecordBatch], bytes_at_once: int = 1 << 21) -> Iterator[tuple[list, list, list]]:
    """(ids, text hashes, texts) of some texts at once; a long one comes alone."""
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        have = 0
        for i, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            t = t.as_py()
            out[0].append(i), out[1].append(h), out[2].append(t)
            have += len(t or "")
            if have > bytes_at_once:
                yield out
                out, have = ([], [], []), 0
        if out[0]:
            yield out


def _filled(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which lines hold a byte other than ASCII white space."""
    before = np.concatenate([[0], np.cumsum((buffer != 32) & ((buffer < 9) | (buffer > 13)))])
    return before[starts + sizes] > before[starts]


def line_hashes(docs: DataFrame, least: int = LEAST_BYTES, short: bool = False) -> DataFrame:
    """``h1, h2, doc, th, line, size`` of every line of at least ``least`` bytes, with ``short`` also of shorter ones that are
    not blank, and of every document (as ``placed`` has it) one row with h1 null, its number of lines in ``line`` and its
    bytes in ``size``. Written to the shared folder with line and size as one number: 48 bytes a line."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in _chunks(batches):
            buffer, starts, sizes, owner, number = _lines(texts)
            keep = np.flatnonzero((sizes >= least) | _filled(buffer, starts, sizes) if short else sizes >= least)
            h = [Rolling(buffer, f).hashes(starts[keep], sizes[keep]).view(np.int64) for f in (0, 1)]
            ids, hashes = np.array(ids, np.int64), np.array(hashes, np.int64)
            counts = np.bincount(owner, minlength=len(ids))
            nothing = pa.nulls(len(ids), pa.int64())
            size = np.array([len(t.encode()) if t else 0 for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (*h, ids[owner[keep]], hashes[owner[keep]], number[keep] << 32 | sizes[keep]))], schema=schema)
            yield pa.RecordBatch.from_arrays([nothing, nothing, *map(pa.array, (ids, hashes, counts << 32 | size))], schema=schema)

    rows = checkpointed(placed(docs).mapInArrow(run, "h1 long, h2 long, doc long, th long, at long"))
    return rows.select("h1", "h2", "doc", "th", F.shiftright("at", 32).alias("line"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).alias("size"))


def _meeting_keys(docs: DataFrame, edits: int, least: int) -> DataFrame:
    """``key, h1`` of entries and lookups whose key more than one line has, at least one of them as an entry."""
    schema = pa.schema([("key", pa.int64()), ("line", pa.int64())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, _, texts in _chunks(batches):
            buffer, starts, sizes, _, _ = _lines(texts)
            keep = np.flatnonzero(sizes >= max(least, edits + 1))
            h1, first = np.unique(Rolling(buffer).hashes(starts[keep], sizes[keep]), return_index=True)
            if len(seen) > 400_000:
                seen.clear()
            new = [k for k, h in enumerate(h1.tolist()) if h not in seen]
            seen.update(h1[new].tolist())
            h1, keep = h1[new], keep[first[new]]
            for rows, keys, indexed in entries(buffer, starts[keep], sizes[keep], edits):
                # The lowest bit says whether the line is entered; the join on the rest is verified anyway.
                line = (h1[rows] & ~np.uint64(1)) | np.uint64(indexed)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(line.view(np.int64))], schema=schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come by key, entries first. Of a key that goes on in the next batch only its state is kept: its first line,
        # whether that was an entry, and whether a different line has come; so a key of any size needs no memory.
        last = first = None
        entered = met = False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, line = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            h = line >> 1
            starts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1])
            sizes = np.diff(np.append(starts, len(key)))
            differ = np.minimum.reduceat(h, starts) != np.maximum.reduceat(h, starts)
            is_entered = (line[starts] & 1) == 1
            if key[0] == last:
                is_entered[0] = entered
                new = met or differ[0] or h[0] != first
                if new and entered and not met:  # what came before was one line only
                    yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([first])], schema=schema)
                differ[0] = new
                if len(starts) > 1:
                    first = None
            if first is None or key[0] != last:
                first = h[starts[-1]]
            last, entered, met = key[-1], bool(is_entered[-1]), bool(differ[-1])
            rows = np.repeat(differ & is_entered, sizes)
            if rows.any():
                yield pa.RecordBatch.from_arrays([pa.array(key[rows]), pa.array(h[rows])], schema=schema)

    sent = placed(docs).mapInArrow(send, "key long, line long")
    dealt = sent.repartition("key").sortWithinPartitions("key", F.col("line").bitwiseAND(F.lit(1).cast("long")).desc())
    return dealt.mapInArrow(meet, "key long, line long").select("key", F.col("line").alias("h"))


def _sieve(meeting: DataFrame, size: int) -> np.ndarray:
    """A bit map, as words of 64, with a bit for each h of ``meeting``, by its lowest bits; ``size`` is a power of two, 64 or more."""
    at = F.col("h").bitwiseAND(F.lit(size - 1))
    bit = F.expr("shiftleft(1L, cast(h & 63L AS INT))")
    words = meeting.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()  # at most size / 64 rows
    out = np.zeros(size >> 6, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _line_texts(docs: DataFrame, least: int, sieve: np.ndarray) -> DataFrame:
    """``doc, th, line, raw`` of the lines of at least ``least`` bytes that the sieve lets through."""
    schema = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("line", pa.int64()), ("raw", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, texts in _chunks(batches):
            buffer, starts, sizes, owner, number = _lines(texts)
            keep = np.flatnonzero(sizes >= least)
            h = Rolling(buffer).hashes(starts[keep], sizes[keep]).view(np.int64) >> 1
            keep = keep[sieve[h >> 6 & len(sieve) - 1] >> (h & 63) & 1 == 1]
            data = memoryview(buffer)
            raws = [bytes(data[a : a + n]) for a, n in zip(starts[keep].tolist(), sizes[keep].tolist(), strict=True)]
            ids, hashes = np.array(ids, np.int64), np.array(hashes, np.int64)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (ids[owner[keep]], hashes[owner[keep]], number[keep])), pa.array(raws, pa.binary())], schema=schema)

    return placed(docs).mapInArrow(run, "doc long, th long, line long, raw binary")


def _histograms(raws: list[bytes]) -> np.ndarray:
    return np.stack([np.bincount(np.frombuffer(r, np.uint8) & 63, minlength=64) for r in raws]).astype(np.int16)


def later_ones(places: list[tuple[int, int, int]], raws: list[bytes], edits: int) -> list[int]:
    """Which of the lines are within ``edits`` of one with a smaller place. Byte counts go before distances: an edit
    changes them by 2 at most."""
    order = sorted(range(len(places)), key=places.__getitem__)
    counts = _histograms([raws[k] for k in order])
    out = []
    for n, k in enumerate(order):
        near = np.flatnonzero(np.abs(counts[:n] - counts[n]).sum(axis=1) <= 2 * edits)
        if any(places[order[m]] < places[k] and banded_distance(raws[order[m]], raws[k], edits) <= edits for m in near):
            out.append(k)
    return out


def _blocks(meeting: DataFrame, most: int) -> DataFrame:
    """``block, h``: the lines of each key. Where a key has more than ``most``, they are dealt into shares, and each two
    shares are a block, so that every two lines of the key meet while no task gets them all."""
    shares = meeting.groupBy("key").count().where(F.col("count") > most).select("key", F.ceil(F.col("count") / most).alias("n"))
    dealt = meeting.join(shares, "key", "left").withColumn("own", F.when(F.col("n").isNotNull(), F.pmod("h", "n")))
    other = F.explode_outer(F.when(F.col("n").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    block = F.when(F.col("n").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    return dealt.withColumn("other", other).select(block.alias("block"), "h").distinct()


def _near_lines(docs: DataFrame, firsts: DataFrame, edits: int, least: int, most: int = 1000) -> DataFrame:
    """``doc, th, line`` of the first occurrences that are near, but not equal, to an earlier line."""
    meeting = checkpointed(_meeting_keys(docs, edits, least).distinct())
    release(docs.sparkSession)
    wanted = firsts.withColumn("h", F.shiftright("h1", 1)).join(meeting.select("h").distinct(), "h", "left_semi").select("doc", "th", "line", "h")
    texts = _line_texts(docs, least, _sieve(meeting, SIEVE)).join(wanted, ["doc", "th", "line"]).dropDuplicates(["doc", "th", "line"])
    rows = _blocks(meeting, most).join(texts, "h").select("block", "doc", "th", "line", "raw")
    schema = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("line", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, places, raws = None, [], []

        def solve() -> pa.RecordBatch:
            hits = later_ones(places, raws, edits) if len(places) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([places[k][i] for k in hits], pa.int64()) for i in range(3)], schema=schema)

        for batch in batches:
            for k, *place, r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if len(places) > 1:
                        yield solve()
                    key, places, raws = k, [], []
                places.append(tuple(place))
                raws.append(r)
        if len(places) > 1:
            yield solve()

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(verify, "doc long, th long, line long").distinct()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def removed_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST_BYTES, short: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(all, removed)``: every line of at least ``least`` bytes and every document (see ``line_hashes``), and
    ``doc, th, line, near`` of the lines to take out: those within ``edits`` byte edits of a line at an earlier
    place, that is of a smaller (doc_id, text hash, line number). With ``short`` also shorter lines, not blank, that equal
    one."""
    rows = line_hashes(docs, least, short)
    lines = rows.where("h1 is not null")
    place = F.struct("doc", "th", "line")
    firsts = lines.groupBy("h1", "h2").agg(F.min(place).alias("p"), (F.count("*") > 1).alias("again"))
    firsts = checkpointed(firsts.select("h1", "h2", "p.*", "again"))
    near = checkpointed(_near_lines(docs, firsts, edits, least))
    release(docs.sparkSession)
    again = firsts.where("again").select("h1", "h2", F.struct("doc", "th", "line").alias("first"))
    equal = lines.join(again, ["h1", "h2"]).where(place > F.col("first"))
    both = equal.select("doc", "th", "line", F.lit(False).alias("near")).unionByName(near.select("doc", "th", "line", F.lit(True).alias("near")))
    return rows, both.groupBy("doc", "th", "line").agg(F.min("near").alias("near"))


def line_report(docs: DataFrame, edits: int = EDITS, least: int = LEAST_BYTES) -> DataFrame:
    """``doc_id, n_lines, n_bytes, n_removed, n_near, removed_bytes`` of every document; one row per input row.

    Lines are what stands between line feeds; a null or empty text has none. Lines below ``least`` bytes always stay.
    ``n_near`` counts the removed lines that equal no earlier one. Rows with equal ids and unlike texts are different
    documents, in the order of a hash of the text. Rows with equal ids and texts share their places: a line is never
    earlier than the one at the same place of the other row; their removed lines are reported on each. Rows with null
    ids stand last. Other columns are ignored; an empty table gives no rows."""
    rows, removed = removed_lines(docs, edits, least)
    sizes = rows.where("h1 is not null").select("doc", "th", "line", "size").distinct()
    per_doc = removed.join(sizes, ["doc", "th", "line"]).groupBy("doc", "th").agg(
        F.count("*").alias("n_removed"), F.count_if("near").alias("n_near"), F.sum("size").alias("removed_bytes")
    )
    docs_only = rows.where("h1 is null").select("doc", "th", F.col("line").alias("n_lines"), F.col("size").alias("n_bytes"))
    zero = F.lit(0).cast("long")
    return docs_only.join(per_doc, ["doc", "th"], "left").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_lines", "n_bytes",
        *(F.coalesce(c, zero).alias(c) for c in ("n_removed", "n_near", "removed_bytes")),
    )


def without_repeated_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST_BYTES, short: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns as they were but ``text``, from which the repeated lines are gone, and, if there
    is one, ``n_chars``. Every row stays, if with an empty text; a null text stays null. Equal and null ids are as in
    ``line_report``."""
    _, removed = removed_lines(docs, edits, least, short)
    gone = removed.groupBy("doc", "th").agg(F.collect_set("line").alias("_gone")).withColumnsRenamed({"doc": "_line_doc", "th": "_line_th"})
    kept = docs.columns
    doc, th = place_of("doc_id", "text")
    joined = docs.join(gone, (doc == F.col("_line_doc")) & (th == F.col("_line_th")), "left").select(*(docs[f"`{c}`"] for c in kept), "_gone")
    text_at, chars_at = kept.index("text"), kept.index("n_chars") if "n_chars" in kept else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, lost = batch.columns
            texts = columns[text_at].to_pylist()
            changed = {k: set(g) for k, g in enumerate(lost.to_pylist()) if g and texts[k] is not None}
            for k, numbers in changed.items():
                texts[k] = "\n".join(x for n, x in enumerate(texts[k].split("\n")) if n not in numbers)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if chars_at is not None and pa.types.is_integer(columns[chars_at].type):
                counts = columns[chars_at].to_pylist()
                columns[chars_at] = pa.array([len(texts[k]) if k in changed else n for k, n in enumerate(counts)], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=kept)

    return joined.mapInArrow(run, docs.schema)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(doc_id, 9223372036854775807) AS doc, coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, -1) AS th,
         coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS parts FROM documents
), l AS (
  SELECT DISTINCT doc, th, unnest(range(len(parts))) AS line, unnest(parts) AS raw FROM t
), e AS (SELECT doc, th, line, raw, strlen(raw) AS size FROM l WHERE strlen(raw) >= 20
), f AS (SELECT raw, size, min((doc, th, line)) AS place FROM e GROUP BY ALL
), n AS (
  SELECT a.place FROM f a WHERE EXISTS (
    SELECT 1 FROM f b WHERE b.size BETWEEN a.size - 2 AND a.size + 2 AND b.place < a.place AND levenshtein(a.raw, b.raw) <= 2)
), r AS (
  SELECT e.doc, e.th, e.size, (e.doc, e.th, e.line) = f.place AS near FROM e JOIN f USING (raw)
  WHERE (e.doc, e.th, e.line) <> f.place OR f.place IN (SELECT place FROM n)
), s AS (
  SELECT doc, th, count(*) AS n_removed, count(*) FILTER (WHERE near) AS n_near, sum(size)::BIGINT AS removed_bytes FROM r GROUP BY doc, th
)
SELECT doc_id, len(parts)::BIGINT AS n_lines, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_near, 0)::BIGINT AS n_near, coalesce(removed_bytes, 0)::BIGINT AS removed_bytes
FROM t LEFT JOIN s USING (doc, th)
"""
