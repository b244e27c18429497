"""Binary files as text: compound documents of word processors, archives, legacy encodings. Arrow-batched functions."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# Fixed values of the formats.
_COMPOUND = bytes.fromhex("d0cf11e0a1b11ae1")
_ENDS = (0xFFFFFFFE, 0xFFFFFFFF)
_PARAGRAPH_TEXT = 67


class CompoundFile:
    """Streams of a compound file: sectors chained by a table, small streams in sectors of their own."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != _COMPOUND:
            raise ValueError("not a compound file")
        self.data = data
        self.size, self.small = (1 << x for x in struct.unpack_from("<HH", data, 30))
        tables, directory = struct.unpack_from("<II", data, 44)
        self.limit, small_table, _, more, _ = struct.unpack_from("<IIIII", data, 56)
        places = list(struct.unpack_from("<109I", data, 76))
        while more not in _ENDS and len(places) < tables:
            words = struct.unpack(f"<{self.size // 4}I", self._sector(more))
            places += words[:-1]
            more = words[-1]
        self.next: list[int] = []
        for p in places[:tables]:
            self.next += struct.unpack(f"<{self.size // 4}I", self._sector(p))
        raw = self._follow(directory, self.next, self._sector)
        self.streams: dict[str, tuple[int, int]] = {}
        root = (0, 0)
        for at in range(0, len(raw) - 127, 128):
            length, kind = struct.unpack_from("<HB", raw, at + 64)
            start, size = struct.unpack_from("<IQ", raw, at + 116)
            name = raw[at : at + max(0, length - 2)].decode("utf-16-le", "replace")
            if kind == 5:
                root = (start, size)
            elif kind == 2:
                self.streams[name] = (start, size)
        table = self._follow(small_table, self.next, self._sector)
        self.small_next = list(struct.unpack(f"<{len(table) // 4}I", table[: len(table) // 4 * 4]))
        self.small_data = self._follow(root[0], self.next, self._sector)[: root[1]]

    def _sector(self, n: int) -> bytes:
        return self.data[512 + n * self.size : 512 + (n + 1) * self.size].ljust(self.size, b"\0")

    @staticmethod
    def _follow(start: int, table: list[int], piece) -> bytes:
        out, at, steps = [], start, 0
        while at not in _ENDS and at < len(table) and steps <= len(table):
            out.append(piece(at))
            at, steps = table[at], steps + 1
        return b"".join(out)

    def read(self, name: str) -> bytes:
        start, size = self.streams[name]
        if size >= self.limit:
            return self._follow(start, self.next, self._sector)[:size]
        return self._follow(start, self.small_next, lambda n: self.small_data[n * self.small : (n + 1) * self.small])[:size]


def word_processor_text(data: bytes) -> str:
    """Paragraphs of a word-processor file: its body sections are raw-deflated records, of which one kind holds text."""
    file, out = CompoundFile(data), []
    for name in sorted((n for n in file.streams if n.startswith("Section")), key=lambda n: (len(n), n)):
        try:
            raw = zlib.decompress(file.read(name), -15)
        except zlib.error:
            continue
        at = 0
        while at + 4 <= len(raw):
            (head,) = struct.unpack_from("<I", raw, at)
            at, size = at + 4, head >> 20
            if size == 0xFFF:
                (size,) = struct.unpack_from("<I", raw, at)
                at += 4
            if head & 0x3FF == _PARAGRAPH_TEXT:
                text = "".join(c for c in raw[at : at + size].decode("utf-16-le", "replace") if c >= " " or c == "\n")
                if text.strip():
                    out.append(text)
            at += size
    return "\n".join(out)


def _safe(f, value):
    try:
        return None if value is None else f(bytes(value))
    except (ValueError, KeyError, struct.error, zipfile.BadZipFile):
        return None


@F.pandas_udf(StringType())
def document_text(content: pd.Series) -> pd.Series:
    """Text of word-processor files; null for other content."""
    return content.map(lambda c: _safe(word_processor_text, c))


@F.pandas_udf(ArrayType(StructType([StructField("name", StringType()), StructField("size", LongType())])))
def archive_entries(content: pd.Series) -> pd.Series:
    """Names and sizes of an archive's entries; null if it is none."""
    return content.map(lambda c: _safe(lambda b: [{"name": i.filename, "size": i.file_size} for i in zipfile.ZipFile(io.BytesIO(b)).infolist()], c))


@F.pandas_udf(StringType())
def korean_text(content: pd.Series) -> pd.Series:
    """Bytes in the legacy Korean encoding as text, unknown ones replaced."""
    return content.map(lambda c: None if c is None else bytes(c).decode("euc-kr", "replace"))
