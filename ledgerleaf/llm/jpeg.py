"""Progressive JPEG on coefficient arrays: a writer for a fixed scan script and a reader for any.

The reader accumulates spectral-selection and successive-approximation scans into one array of quantised
coefficients per component; ``to_rgb`` transforms them back, in exact integer arithmetic held in doubles, and
upsamples the chroma. Long stretches of one symbol with values of one size, which the writer's own files
consist of, are read by numpy in one step; all else symbol by symbol.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np

# Fixed values of the format: the order in which a block's coefficients are stored.
ZIGZAG = np.array(
    [i for _, i in sorted(((r + c, (r if (r + c) % 2 else c)), 8 * r + c) for r in range(8) for c in range(8))]
)
_SCALE = 1 << 13
#: A marker that ends a scan: neither a stuffed byte nor a restart.
_MARKER = re.compile(rb"\xff[^\x00\xd0-\xd7]")


def _basis() -> np.ndarray:
    """Row: coefficient in zigzag order; column: sample; values are integers, 8 * _SCALE times the true ones."""
    n = np.arange(8)
    one = np.cos((2 * n[None, :] + 1) * n[:, None] * np.pi / 16) * np.where(n == 0, np.sqrt(0.5), 1.0)[:, None] / 2
    return np.round(np.einsum("ux,vy->uvxy", one, one).reshape(64, 64)[ZIGZAG] * 8 * _SCALE)


BASIS = _basis()


@dataclass
class Component:
    ident: int
    across: int  # sampling factors
    down: int
    table: int
    wide: int = 0  # blocks in the array, a whole number of MCUs
    high: int = 0
    own_wide: int = 0  # blocks that hold samples, which scans of this component alone count
    own_high: int = 0
    blocks: np.ndarray | None = None  # (high, wide, 64) in zigzag order


@dataclass
class Image:
    height: int
    width: int
    components: list[Component]
    quant: dict[int, np.ndarray]
    comment: bytes = b""

    def layout(self) -> Image:
        most_x, most_y = max(c.across for c in self.components), max(c.down for c in self.components)
        mx, my = -(-self.width // (8 * most_x)), -(-self.height // (8 * most_y))
        for c in self.components:
            c.wide, c.high = mx * c.across, my * c.down
            c.own_wide = -(-(-(-self.width * c.across // most_x)) // 8)
            c.own_high = -(-(-(-self.height * c.down // most_y)) // 8)
            if c.blocks is None:
                c.blocks = np.zeros((c.high, c.wide, 64), np.int32)
        return self


class Bits:
    """Bits of a scan, most significant first; past the end come zeros."""

    def __init__(self, data: bytes) -> None:
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8))
        self.length, self.at = 8 * len(data), 0
        self.data = data + b"\0" * 8

    def peek(self, n: int) -> int:
        byte, off = self.at >> 3, self.at & 7
        return (int.from_bytes(self.data[byte : byte + 4], "big") >> (32 - off - n)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        if not n:
            return 0
        out = self.peek(n)
        self.at += n
        return out


@dataclass
class Huffman:
    """Code lengths by symbol, as JPEG stores them: ``counts`` of codes by length 1..16, and the symbols in order."""

    counts: tuple[int, ...]
    symbols: bytes

    def __post_init__(self) -> None:
        self.codes: dict[int, tuple[int, int]] = {}  # symbol: code, length
        code, k = 0, 0
        for length, count in enumerate(self.counts, 1):
            for _ in range(count):
                self.codes[self.symbols[k]] = (code, length)
                code, k = code + 1, k + 1
            code <<= 1
        self.longest = max((n for n, c in enumerate(self.counts, 1) if c), default=1)

    @cached_property
    def table(self) -> list[int]:
        """For each value of the next ``longest`` bits the code's length, shifted by 8, and symbol; -1 for none."""
        table = np.full(1 << self.longest, -1, np.int32)
        for s, (c, n) in self.codes.items():
            table[c << (self.longest - n) : (c + 1) << (self.longest - n)] = n << 8 | s
        return table.tolist()

    def read(self, bits: Bits) -> int:
        found = self.table[bits.peek(self.longest)]
        if found < 0:
            raise ValueError("not a code of the table")
        bits.at += found >> 8
        return found & 255

    @classmethod
    def for_symbols(cls, symbols: list[int]) -> Huffman:
        """One code of 1 bit, or codes of 4 bits for up to 15 symbols, or of 8 and 16; a code of ones stays free."""
        if len(symbols) == 1:
            return _known((1, *[0] * 15), bytes(symbols))
        order = sorted(symbols)
        if len(order) <= 15:
            return _known((0, 0, 0, len(order), *[0] * 12), bytes(order))
        return _known((*[0] * 7, min(len(order), 127), *[0] * 7, max(0, len(order) - 127)), bytes(order))


@lru_cache(256)
def _known(counts: tuple[int, ...], symbols: bytes) -> Huffman:
    return Huffman(counts, symbols)


def _extend(value: int, size: int) -> int:
    return value if size == 0 or value >> (size - 1) else value - (1 << size) + 1


def _pack(values: np.ndarray, lengths: np.ndarray | int) -> bytes:
    """Codes of the given bit lengths (one number: of all) one after the other."""
    if isinstance(lengths, int):
        if lengths == 1:
            return _close(values.astype(np.uint8))
        return _close(np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - lengths :].ravel())
    if not len(lengths):
        return b""
    most = int(lengths.max())
    bits = np.unpackbits(values.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - most :]
    return _close(bits[np.arange(most)[None, :] >= most - lengths[:, None]])


def _close(bits: np.ndarray) -> bytes:
    """Whole bytes of the bits, filled up with ones, with 0 after each 255."""
    raw = np.packbits(np.concatenate([bits, np.ones(-len(bits) % 8, np.uint8)]) if len(bits) % 8 else bits).tobytes()
    return raw.replace(b"\xff", b"\xff\x00")


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _sizes(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.abs(values).astype(np.float64) + 1)).astype(np.int64)


class Writer:
    """Writes coefficients as: DC of all components without the last bit, AC of each component without the last bit,
    of the first in two bands, then the last bits of DC and of each component's AC."""

    BANDS = ((1, 5), (6, 63))

    def write(self, image: Image) -> bytes:
        image.layout()
        out = [b"\xff\xd8"]
        if image.comment:
            out.append(_segment(0xFE, image.comment))
        for k, q in image.quant.items():
            out.append(_segment(0xDB, bytes([k]) + bytes(int(x) for x in q)))
        frame = struct.pack(">BHHB", 8, image.height, image.width, len(image.components))
        for c in image.components:
            frame += bytes([c.ident, c.across << 4 | c.down, c.table])
        out.append(_segment(0xC2, frame))
        self._first_dc(image, out)
        for k in range(len(image.components)):
            for band in self.BANDS if k == 0 else ((1, 63),):
                self._first_ac(image, k, *band, out)
        self._last_dc(image, out)
        for k in range(len(image.components)):
            self._last_ac(image, k, 1, 63, out)
        out.append(b"\xff\xd9")
        return b"".join(out)

    @staticmethod
    def _scan(out: list, image: Image, which: list[int], start: int, end: int, high: int, low: int, data: bytes, table: Huffman | None) -> None:
        if table is not None:
            out.append(_segment(0xC4, bytes([(0x10 if start else 0)]) + bytes(table.counts) + table.symbols))
        head = bytes([len(which)]) + b"".join(bytes([image.components[k].ident, 0]) for k in which)
        out.append(_segment(0xDA, head + bytes([start, end, high << 4 | low])))
        out.append(data)

    @staticmethod
    def _mcu_order(image: Image) -> list[np.ndarray]:
        """DC values by MCU, for each component: (MCUs, blocks in one)."""
        out = []
        for c in image.components:
            dc = c.blocks[:, :, 0].reshape(c.high // c.down, c.down, c.wide // c.across, c.across)
            out.append(dc.transpose(0, 2, 1, 3).reshape(-1, c.down * c.across))
        return out

    def _first_dc(self, image: Image, out: list) -> None:
        columns = []
        for dc in self._mcu_order(image):
            shifted = (dc >> 1).ravel()
            columns.append(np.diff(shifted, prepend=0).reshape(dc.shape))
        diff = np.concatenate(columns, axis=1).ravel().astype(np.int64)
        sizes = _sizes(diff)
        table = Huffman.for_symbols(np.flatnonzero(np.bincount(sizes)).tolist())
        codes, lengths = np.zeros(16, np.int64), np.zeros(16, np.int64)
        for s, (c, n) in table.codes.items():
            codes[s], lengths[s] = c, n
        extra = np.where(diff < 0, diff + (1 << sizes) - 1, diff)
        data = _pack(codes[sizes] << sizes | extra, lengths[sizes] + sizes)
        self._scan(out, image, list(range(len(image.components))), 0, 0, 0, 1, data, table)

    def _last_dc(self, image: Image, out: list) -> None:
        bits = np.concatenate([dc & 1 for dc in self._mcu_order(image)], axis=1).ravel()
        self._scan(out, image, list(range(len(image.components))), 0, 0, 1, 0, _pack(bits, 1), None)

    @staticmethod
    def _own(c: Component) -> np.ndarray:
        return c.blocks[: c.own_high, : c.own_wide].reshape(-1, 64)

    def _first_ac(self, image: Image, k: int, start: int, end: int, out: list) -> None:
        values = self._own(image.components[k])[:, start : end + 1]
        low = int(values.min()) if values.size else 0
        shifted = values >> 1 if low >= 0 else np.sign(values) * (np.abs(values) >> 1)
        if low > 1 and (size := (low >> 1).bit_length()) == (int(values.max()) >> 1).bit_length():
            # All of one size and positive: one symbol, whose code is the bit 0.
            data = _pack(shifted.ravel(), size + 1)
            table = Huffman.for_symbols([size])
        elif shifted.all():
            flat = shifted.ravel().astype(np.int64)
            sizes = _sizes(flat)
            counts = np.bincount(sizes)
            table = Huffman.for_symbols(np.flatnonzero(counts).tolist())
            codes, lengths = np.zeros(16, np.int64), np.zeros(16, np.int64)
            for s, (c, n) in table.codes.items():
                codes[s], lengths[s] = c, n
            extra = np.where(flat < 0, flat + (1 << sizes) - 1, flat)
            data = _pack(codes[sizes] << sizes | extra, lengths[sizes] + sizes)
        else:
            symbols, extra, sizes = [], [], []
            for row in shifted.tolist():
                run = 0
                for v in row:
                    if not v:
                        run += 1
                        continue
                    while run > 15:
                        symbols.append(0xF0), extra.append(0), sizes.append(0)
                        run -= 16
                    size = abs(v).bit_length()
                    symbols.append(run << 4 | size), extra.append(v if v > 0 else v + (1 << size) - 1), sizes.append(size)
                    run = 0
                if run:
                    symbols.append(0), extra.append(0), sizes.append(0)
            table, data = self._coded(symbols, extra, sizes)
        self._scan(out, image, [k], start, end, 0, 1, data, table)

    @staticmethod
    def _coded(symbols: list[int], extra: list[int], sizes: list[int]) -> tuple[Huffman, bytes]:
        table = Huffman.for_symbols(list(set(symbols)))
        codes = np.array([table.codes[s] for s in symbols], np.int64).reshape(-1, 2)
        e, n = np.array(extra, np.int64), np.array(sizes, np.int64)
        return table, _pack(codes[:, 0] << n | e, codes[:, 1] + n)

    def _last_ac(self, image: Image, k: int, start: int, end: int, out: list) -> None:
        values = self._own(image.components[k])[:, start : end + 1]
        size = np.abs(values)
        known, last = size >> 1, size & 1
        if known.all():
            # No coefficient becomes non-zero here: runs of blocks without one, each followed by its bits.
            n, most, runs = len(values), 32767, []
            for pos in range(0, n, most):
                count = min(most, n - pos)
                runs.append((pos, count, count.bit_length() - 1))
            table = Huffman.for_symbols(list(dict.fromkeys(power << 4 for _, _, power in runs)))
            bits = []
            for pos, count, power in runs:
                code, length = table.codes[power << 4]
                head = code << power | count - (1 << power)
                bits += [np.array([head >> i & 1 for i in range(length + power - 1, -1, -1)], np.uint8), last[pos : pos + count].ravel().astype(np.uint8)]
            data = _close(np.concatenate(bits)) if bits else b""
        else:
            symbols, extra, sizes, tails = [], [], [], []
            for row, old, bit in zip(values.tolist(), known.tolist(), last.tolist(), strict=True):
                run, pending = 0, []
                for i, (v, o, b) in enumerate(zip(row, old, bit, strict=True)):
                    if o:
                        pending.append(b)
                    elif b:
                        symbols.append(run << 4 | 1), extra.append(int(v > 0)), sizes.append(1), tails.append(pending)
                        run, pending = 0, []
                    else:
                        run += 1
                        if run == 16:
                            # A run of 16 is only worth a symbol if something new comes behind it.
                            if any(not o2 and b2 for o2, b2 in zip(old[i + 1 :], bit[i + 1 :], strict=True)):
                                symbols.append(0xF0), extra.append(0), sizes.append(0), tails.append(pending)
                                run, pending = 0, []
                if run or pending:
                    symbols.append(0), extra.append(0), sizes.append(0), tails.append(pending)
            table = Huffman.for_symbols(list(set(symbols)))
            vals, lens = [], []
            for s, e, n, tail in zip(symbols, extra, sizes, tails, strict=True):
                code, length = table.codes[s]
                vals += [code << n | e, *tail]
                lens += [length + n, *([1] * len(tail))]
            data = _pack(np.array(vals, np.int64), np.array(lens, np.int64))
        self._scan(out, image, [k], start, end, 1, 0, data, table)


@lru_cache(64)
def _places(wide: int, high: int, sampling: tuple[tuple[int, int], ...]) -> np.ndarray:
    """(component of the scan, row, column) of each block of a scan of ``wide`` x ``high`` units, in order."""
    unit = np.array([(k, y, z, down, across) for k, (across, down) in enumerate(sampling) for y in range(down) for z in range(across)], np.int64)
    r, x = np.divmod(np.arange(wide * high), max(1, wide))
    out = np.empty((wide * high, len(unit), 3), np.int64)
    out[:, :, 0] = unit[:, 0]
    out[:, :, 1] = r[:, None] * unit[:, 3] + unit[:, 1]
    out[:, :, 2] = x[:, None] * unit[:, 4] + unit[:, 2]
    return out.reshape(-1, 3)


class Reader:
    """Reads a progressive (or sequential, Huffman-coded, 8-bit) JPEG into an ``Image`` of coefficients."""

    def read(self, data: bytes) -> Image:
        if data[:2] != b"\xff\xd8":
            raise ValueError("not a JPEG")
        self.quant: dict[int, np.ndarray] = {}
        self.tables: dict[int, Huffman] = {}
        self.image, self.restart, comment, at = None, 0, b"", 2
        while at < len(data) - 1:
            marker = data[at + 1]
            if data[at] != 0xFF:
                raise ValueError("a marker is missing")
            if marker == 0xD9:
                break
            if marker == 0xFF:
                at += 1
                continue
            size = struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xFE:
                comment = body
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    n = 64 * (1 + wide)
                    self.quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], ">u2" if wide else np.uint8).astype(np.int64)
                    body = body[1 + n :]
            elif marker == 0xC4:
                while body:
                    counts = tuple(body[1:17])
                    n = sum(counts)
                    self.tables[body[0]] = _known(counts, body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.restart = struct.unpack(">H", body)[0]
            elif marker in (0xC0, 0xC1, 0xC2):
                depth, high, wide, n = struct.unpack_from(">BHHB", body)
                if depth != 8:
                    raise ValueError("only 8-bit samples are read")
                self.progressive = marker == 0xC2
                parts = [Component(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
                self.image = Image(high, wide, parts, self.quant).layout()
            elif marker == 0xDA:
                at = self._scan(body, data, at)
        if self.image is None:
            raise ValueError("no frame")
        self.image.comment = comment
        return self.image

    def _scan(self, head: bytes, data: bytes, at: int) -> int:
        found = _MARKER.search(data, at)
        end = found.start() if found else len(data)
        n = head[0]
        parts = []
        for k in range(n):
            c = next(c for c in self.image.components if c.ident == head[1 + 2 * k])
            parts.append((c, self.tables.get(head[2 + 2 * k] >> 4), self.tables.get(0x10 | head[2 + 2 * k] & 15)))
        start, stop, approx = head[1 + 2 * n : 4 + 2 * n]
        pieces, piece_at, pos = [], at, at
        if self.restart:
            while (pos := data.find(b"\xff", pos, end)) >= 0:
                if 0xD0 <= data[pos + 1] <= 0xD7:
                    pieces.append(data[piece_at:pos])
                    piece_at = pos + 2
                pos += 2
        pieces.append(data[piece_at:end])
        pieces = [p.replace(b"\xff\x00", b"\xff") for p in pieces]
        first = parts[0][0]
        if n == 1:
            if self.progressive and start:
                # One component's AC band: the blocks in order, in one array.
                flat = np.ascontiguousarray(first.blocks[: first.own_high, : first.own_wide].reshape(-1, 64))
                step = self.restart or len(flat)
                for k, piece in enumerate(pieces):
                    if k * step < len(flat):
                        self._band(flat[k * step : (k + 1) * step], Bits(piece), parts[0][2], start, stop, approx >> 4, approx & 15)
                first.blocks[: first.own_high, : first.own_wide] = flat.reshape(first.own_high, first.own_wide, 64)
                return end
            where, per_unit = _places(first.own_wide, first.own_high, ((1, 1),)), 1
        else:
            where = _places(first.wide // first.across, first.high // first.down, tuple((c.across, c.down) for c, _, _ in parts))
            per_unit = sum(c.across * c.down for c, _, _ in parts)
        step = self.restart * per_unit or max(1, len(where))
        for k, piece in enumerate(pieces):
            self._units(where[k * step : (k + 1) * step], parts, Bits(piece), approx >> 4, approx & 15)
        return end

    def _units(self, by: np.ndarray, parts: list, bits: Bits, high: int, low: int) -> None:
        """DC scans, and all of a sequential file's."""
        if self.progressive and high:
            values = bits.bits[: len(by)].astype(np.int32) << low
            for k, (c, _, _) in enumerate(parts):
                m = by[:, 0] == k
                c.blocks[by[m, 1], by[m, 2], 0] |= values[m]
            return
        before = [0] * len(parts)
        if self.progressive:
            tables, out = [t.table for _, t, _ in parts], []
            longest = [t.longest for _, t, _ in parts]
            data, at = bits.data + b"\0" * 8, bits.at
            for k in by[:, 0].tolist():
                word = int.from_bytes(data[at >> 3 : (at >> 3) + 5], "big") << (at & 7)
                found = tables[k][(word >> (40 - longest[k])) & ((1 << longest[k]) - 1)]
                n, size = found >> 8, found & 255
                value = (word >> (40 - n - size)) & ((1 << size) - 1)
                at += n + size
                before[k] += _extend(value, size)
                out.append(before[k] << low)
            values = np.array(out, np.int32)
            for k, (c, _, _) in enumerate(parts):
                m = by[:, 0] == k
                c.blocks[by[m, 1], by[m, 2], 0] = values[m]
            return
        for k, r, x in by.tolist():
            c, dc, ac = parts[k]
            size = dc.read(bits)
            before[k] += _extend(bits.read(size), size)
            c.blocks[r, x, 0] = before[k]
            i = 1
            while i < 64:
                symbol = ac.read(bits)
                run, size = symbol >> 4, symbol & 15
                if not size:
                    if run < 15:
                        break
                    i += 16
                    continue
                i += run
                c.blocks[r, x, i] = _extend(bits.read(size), size)
                i += 1

    def _band(self, flat: np.ndarray, bits: Bits, table: Huffman, start: int, stop: int, high: int, low: int) -> None:
        if high:
            self._band_again(flat, bits, table, start, stop, 1 << low)
        else:
            self._band_first(flat, bits, table, start, stop, low)

    @staticmethod
    def _same(bits: Bits, table: Huffman, most: int) -> tuple[np.ndarray, int]:
        """Values of the longest stretch from here on, at most ``most``, that has one symbol without a run."""
        found = table.table[bits.peek(table.longest)]
        n, symbol = found >> 8, found & 255
        size = symbol & 15
        if found < 0 or symbol >> 4 or not size:
            return np.zeros(0, np.int64), 0
        stride = n + size
        most = min(most, (bits.length - bits.at) // stride)
        rows = bits.bits[bits.at : bits.at + most * stride].reshape(most, stride)
        fits = rows[:, 0] == rows[0, 0] if n == 1 else (rows[:, :n] == rows[:1, :n]).all(axis=1)
        count = most if fits.all() else int(fits.argmin())
        wide = np.zeros((count, 16), np.uint8)
        wide[:, 16 - size :] = rows[:count, n:]
        values = np.packbits(wide, axis=1).view(">u2").ravel().astype(np.int32)
        if not rows[:count, n].all():
            values = np.where(rows[:count, n] == 1, values, values - (1 << size) + 1)
        bits.at += count * stride
        return values, count

    def _band_first(self, flat: np.ndarray, bits: Bits, table: Huffman, start: int, stop: int, low: int) -> None:
        width, block, at, skip = stop - start + 1, 0, 0, 0
        band = np.ascontiguousarray(flat[:, start : stop + 1])
        line, total = band.reshape(-1), band.size
        pos = 0
        tried = 0
        while pos < total:
            if skip:
                pos = min(total, (pos // width + skip) * width)
                skip = 0
                continue
            if tried <= 0:
                values, count = self._same(bits, table, total - pos)
                if count:
                    line[pos : pos + count] = values << low
                    pos += count
                tried = 0 if count > 32 else 32  # else go on by single symbols for a while
                if count:
                    continue
            tried -= 1
            symbol = table.read(bits)
            run, size = symbol >> 4, symbol & 15
            if size:
                pos += run
                line[pos] = _extend(bits.read(size), size) << low
                pos += 1
            elif run == 15:
                pos += 16
            else:
                skip = (1 << run) + bits.read(run)
        flat[:, start : stop + 1] = band

    def _band_again(self, flat: np.ndarray, bits: Bits, table: Huffman, start: int, stop: int, unit: int) -> None:
        block, n = 0, len(flat)
        while block < n:
            i = start
            while i <= stop:
                symbol = table.read(bits)
                run, size = symbol >> 4, symbol & 15
                if not size and run < 15:
                    blocks = (1 << run) + bits.read(run)
                    block = self._corrections(flat, bits, block, i, blocks, start, stop, unit)
                    i = -1
                    break
                value = (unit if bits.read(1) else -unit) if size else 0
                row = flat[block]
                while i <= stop:
                    if row[i]:
                        if bits.read(1):
                            row[i] += unit if row[i] > 0 else -unit
                    elif run:
                        run -= 1
                    else:
                        row[i] = value
                        i += 1
                        break
                    i += 1
            if i >= 0:
                block += 1

    @staticmethod
    def _corrections(flat: np.ndarray, bits: Bits, block: int, i: int, blocks: int, start: int, stop: int, unit: int) -> int:
        """The correction bits of the rest of a block and of those after it that have nothing new."""
        part = flat[block : block + blocks, start : stop + 1]
        known = part != 0
        known[0, : i - start] = False
        if known.all():
            part += np.where(part > 0, unit, -unit) * bits.bits[bits.at : bits.at + part.size].reshape(part.shape)
            bits.at += part.size
            return block + blocks
        n = int(known.sum())
        got = np.zeros(n, part.dtype)
        have = bits.bits[bits.at : bits.at + n]
        got[: len(have)] = have
        bits.at += n
        part[known] += np.sign(part[known]) * got * unit
        return block + blocks


def to_rgb(image: Image) -> np.ndarray:
    """Full-resolution (height, width, 3) bytes. One component gives gray; three are luma and two chroma."""
    most_x, most_y = max(c.across for c in image.components), max(c.down for c in image.components)
    planes = []
    for c in image.components:
        values = (c.blocks.reshape(-1, 64) * image.quant[c.table]).astype(np.float64)
        samples = np.floor(((values @ BASIS) + 4 * _SCALE) / (8 * _SCALE)).astype(np.int32) + 128
        plane = np.clip(samples, 0, 255).reshape(c.high, c.wide, 8, 8).transpose(0, 2, 1, 3).reshape(8 * c.high, 8 * c.wide)
        if c.across != most_x:
            plane = np.repeat(plane, most_x // c.across, axis=1)
        if c.down != most_y:
            plane = np.repeat(plane, most_y // c.down, axis=0)
        planes.append(plane[: image.height, : image.width])
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    out = np.empty((*y.shape, 3), np.uint8)
    out[..., 0] = np.clip(y + ((91881 * cr + 32768) >> 16), 0, 255)
    out[..., 1] = np.clip(y - ((22554 * cb + 46802 * cr - 32768) >> 16), 0, 255)
    out[..., 2] = np.clip(y + ((116130 * cb + 32768) >> 16), 0, 255)
    return out
