"""Media columns: byte strings kept as progressive JPEG coefficients, and RGB tensors read from such files.

A payload byte b is stored as the quantised coefficient b + 256 of a 4:2:0 image: six blocks of 64 for each MCU
of 16 x 16 pixels. Entropy coding is lossless, so the bytes come back exactly from the coefficients, while the
pixels are what any decoder would show.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import map_lists, read
from .jpeg import Component, Image, Reader, Writer, to_rgb

UNIT = 192
_FLAT = np.ones(64, np.int64)
_OFFSET = 256


def pad(raw: bytes) -> bytes:
    """The bytes with spaces up to a positive multiple of ``UNIT``."""
    return raw + b" " * (UNIT - len(raw) if not raw else -len(raw) % UNIT)


def encode(payload: bytes) -> bytes:
    """A progressive JPEG that holds the payload. Near-square; what the last row doesn't fill is zero bytes."""
    mcus = max(1, -(-len(payload) // 384))
    wide = math.isqrt(mcus - 1) + 1
    high = -(-mcus // wide)
    values = np.full(384 * wide * high, _OFFSET, np.int32)
    values[: len(payload)] += np.frombuffer(payload, np.uint8)
    grid = values.reshape(high, wide, 6, 64)
    luma = grid[:, :, :4].reshape(high, wide, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(2 * high, 2 * wide, 64)
    parts = [Component(1, 2, 2, 0, blocks=luma), Component(2, 1, 1, 0, blocks=grid[:, :, 4]), Component(3, 1, 1, 0, blocks=grid[:, :, 5])]
    return Writer().write(Image(16 * high, 16 * wide, parts, {0: _FLAT}, b"payload=%d" % len(payload)))


def payload_of(image: Image) -> bytes:
    """The payload of a decoded image that ``encode`` has made; of any other, its coefficients' low bytes."""
    luma, blue, red = (c.blocks for c in image.components)
    high, wide = blue.shape[:2]
    grid = np.empty((high, wide, 6, 64), np.int32)
    grid[:, :, :4] = luma.reshape(high, 2, wide, 2, 64).transpose(0, 2, 1, 3, 4).reshape(high, wide, 4, 64)
    grid[:, :, 4], grid[:, :, 5] = blue, red
    raw = (grid - _OFFSET).astype(np.uint8).tobytes()
    return raw[: int(image.comment.rpartition(b"=")[2])] if image.comment.startswith(b"payload=") else raw


def features(rgb: np.ndarray) -> str:
    """Size, mean of each channel in thousandths (rounded down) and a 16-bin histogram of the luma."""
    flat = rgb.reshape(-1, 3)
    sums = flat.sum(axis=0, dtype=np.int64) * 1000 // len(flat)
    luma = (flat @ np.array([77, 150, 29], np.uint32)) >> np.uint32(12)
    return f"{rgb.shape[1]}x{rgb.shape[0]};mean={','.join(map(str, sums))};luma={','.join(map(str, np.bincount(luma, minlength=16)))}"


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media``: every whole text's padded UTF-8 bytes as a progressive JPEG. A null text is empty;
    an empty one is ``UNIT`` spaces. Ids may be null or repeated; other columns are ignored. Map-only."""

    def run(ids, texts):
        raws = [t.encode() if t else b"" for t in texts]
        return [ids, list(map(len, raws)), [encode(pad(r)) for r in raws]]

    return map_lists(docs, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, media binary", id_col, text_col, rows=64)


def read_rgb(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """``doc_id, height, width, rgb`` of JPEG files: the full-resolution tensor, row by row; nulls for null media."""

    def run(ids, files):
        tensors = [None if f is None else to_rgb(Reader().read(f)) for f in files]
        shape = lambda k: [None if t is None else t.shape[k] for t in tensors]
        return [ids, shape(0), shape(1), [None if t is None else t.tobytes() for t in tensors]]

    schema = f"doc_id {media.schema[id_col].dataType.simpleString()}, height int, width int, rgb binary"
    return map_lists(media, run, schema, id_col, media_col, rows=16)


def decoded(media: DataFrame) -> DataFrame:
    """From ``to_media``'s rows, read back: ``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256`` and the full-resolution tensor as ``height, width, rgb``."""

    def run(ids, sizes, files):
        rows = []
        for data in files:
            image = Reader().read(data)
            payload, rgb = payload_of(image), to_rgb(image)
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(data), hashlib.sha256(data).hexdigest(), *rgb.shape[:2], rgb.tobytes()))
        return [ids, sizes, *([r[k] for r in rows] for k in range(8))]

    schema = (
        f"doc_id {media.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, "
        "tail_crc32 long, media_bytes long, media_sha256 string, height int, width int, rgb binary"
    )
    return map_lists(media, run, schema, "doc_id", "n_bytes", "media", rows=64)


def media_digests(media: DataFrame) -> DataFrame:
    """``decoded`` with ``feature``, computed from the tensor column, in its place. Equal texts give equal values: pixels come
    from exact integer arithmetic."""
    tensors = decoded(media)
    keep = tensors.columns[:7]

    def run(*columns):
        *same, heights, widths, pixels = columns
        return [*same, [features(np.frombuffer(p, np.uint8).reshape(h, w, 3)) for h, w, p in zip(heights, widths, pixels, strict=True)]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tensors.schema.fields[:7]) + ", feature string"
    return map_lists(tensors, run, schema, *keep, "height", "width", "rgb", rows=64)


def op2_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_digests(to_media(read(spark, sf_dir, "documents")))
