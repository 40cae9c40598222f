"""Media columns: texts as lossless baseline JPEG images, and features of their DC-only luminance thumbnails.

Encoding puts one payload byte into the DC coefficient of each 8x8 block of a grey image, 64 blocks a row. With a DC
quantiser of 8 the DC-only thumbnail (one pixel a block) is the payload itself, so the stored form loses nothing. Each
row of blocks is a restart interval. A JPEG is at most 65,535 pixels high, so longer payloads are several images in
sequence, each complete.

Decoding reads markers, tables and scans of any baseline JPEG (several components, subsampling, AC coefficients) and
keeps the DC coefficients of the luminance. Restart intervals of all images of a group are decoded together, one numpy
lane each, so the interpreter's work is the number of blocks in the longest interval and not of all blocks.

Scale: one pass, no shuffle; a task holds one Arrow batch and works on images of about `GROUP` payload bytes together, so one long
text needs no more working memory than many short ones.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import batch

UNIT = 64
ROWS = 65535 // 8
GROUP = 1 << 20

#: Our Huffman tables as (code counts by length 1 to 16, symbols). DC: sizes 0 to 9; AC: end of block alone.
DC_TABLE = ((0, 1, 5, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0), (7, 6, 5, 8, 4, 3, 2, 1, 0, 9))
AC_TABLE = ((1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0), (0,))


def huffman_codes(counts: tuple[int, ...], symbols: tuple[int, ...]) -> dict[int, tuple[int, int]]:
    """Code and length by symbol, as the standard assigns them: in order, counting up, one bit more for each length."""
    codes, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            codes[symbols[k]] = (code, length)
            code, k = code + 1, k + 1
        code <<= 1
    return codes


def lookup(counts: tuple[int, ...], symbols: tuple[int, ...]) -> np.ndarray:
    """By the next 16 bits: 256 * code length + symbol; 0 where no code begins."""
    found = np.zeros(1 << 16, dtype=np.int32)
    for symbol, (code, length) in huffman_codes(counts, symbols).items():
        found[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | symbol
    return found


def _diff_table() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for a block with DC difference d and nothing else, by d + 255."""
    dc, (end, end_bits) = huffman_codes(*DC_TABLE), huffman_codes(*AC_TABLE)[0]
    bits, length = np.zeros(511, dtype=np.uint64), np.zeros(511, dtype=np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = dc[size]
        value = ((code << size) | (d if d >= 0 else d + (1 << size) - 1)) << end_bits | end
        bits[d + 255], length[d + 255] = value, n + size + end_bits
    return bits, length


BITS, LENGTHS = _diff_table()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(rows: int) -> bytes:
    tables = b"".join(bytes([kind << 4]) + bytes(counts) + bytes(symbols) for kind, (counts, symbols) in enumerate((DC_TABLE, AC_TABLE)))
    return (
        b"\xff\xd8"
        + _segment(0xDB, b"\x00\x08" + b"\x01" * 63)
        + _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, UNIT * 8, 1) + b"\x01\x11\x00")
        + _segment(0xC4, tables)
        + _segment(0xDD, struct.pack(">H", UNIT))
        + _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")
    )


def payload(text: str | None) -> bytes:
    """The text's UTF-8 with zero bytes up to a positive multiple of 64."""
    raw = (text or "").encode()
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b"\0")


def encode(payloads: list[bytes]) -> list[bytes]:
    """One stored form for each payload (whose lengths are multiples of 64): its images, made in groups of bounded size."""
    step = UNIT * ROWS
    images = [(k, p[s : s + step]) for k, p in enumerate(payloads) for s in range(0, len(p), step)]
    stored: list[list[bytes]] = [[] for _ in payloads]
    start = size = 0
    for end, (_, p) in enumerate(images, 1):
        size += len(p)
        if size >= GROUP or end == len(images):
            for (k, _), image in zip(images[start:end], _images(images[start:end])):
                stored[k].append(image)
            start, size = end, 0
    return [b"".join(parts) for parts in stored]


def _images(parts: list[tuple[int, bytes]]) -> list[bytes]:
    """One image for each (document, payload) of at most `ROWS` rows."""
    payloads = [p for _, p in parts]
    rows_of = [len(p) // UNIT for p in payloads]
    samples = np.frombuffer(b"".join(payloads), dtype=np.uint8).reshape(-1, UNIT).astype(np.int64) - 128
    diffs = np.diff(samples, axis=1, prepend=0) + 255
    bits, length = BITS[diffs], LENGTHS[diffs]
    row_bits = length.sum(axis=1)
    row_bytes = (row_bits + 7) >> 3
    base = np.concatenate([[0], np.cumsum(row_bytes)])  # where each row's bytes begin
    offset = np.cumsum(length, axis=1) - length + 8 * base[:-1, None]
    # Bits of different blocks don't overlap, so adding them up within 16-bit words is joining them.
    total = int(base[-1]) // 2 + 3
    shift = (48 - (offset & 15) - length).astype(np.uint64)
    placed, word = (bits << shift).ravel(), (offset >> 4).ravel()
    words = sum(
        np.bincount(word + k, weights=((placed >> np.uint64(32 - 16 * k)) & np.uint64(0xFFFF)).astype(np.float64), minlength=total)[:total]
        for k in range(3)
    )
    data = words.astype(">u2").view(np.uint8)[: base[-1]].copy()
    data[base[1:] - 1] |= ((1 << (8 * row_bytes - row_bits)) - 1).astype(np.uint8)  # rows are filled up with ones
    # A zero follows each 0xFF of the data, a restart marker each row but an image's last.
    stuffed = data == 0xFF
    extra = np.cumsum(stuffed) - stuffed
    row = np.repeat(np.arange(len(row_bytes)), row_bytes)
    out = np.zeros(len(data) + int(stuffed.sum()) + 2 * len(row_bytes), dtype=np.uint8)
    out[np.arange(len(data)) + extra + 2 * row] = data
    row_end = base[1:] + np.concatenate([[0], np.cumsum(stuffed)])[base[1:]] + 2 * np.arange(len(row_bytes))
    first = np.concatenate([[0], np.cumsum(rows_of)])
    number = np.arange(len(row_bytes)) - np.repeat(first[:-1], rows_of)
    out[row_end] = 0xFF
    out[row_end + 1] = 0xD0 + number % 8
    whole, starts = out.tobytes(), np.concatenate([[0], row_end + 2])
    return [_header(n) + whole[starts[f] : row_end[f + n - 1]] + b"\xff\xd9" for f, n in zip(first.tolist(), rows_of)]


@dataclass
class Frame:
    """One image: what its markers say, and its restart intervals as byte ranges without stuffing or markers."""

    height: int = 0
    width: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, quantiser
    tables: dict[int, tuple] = field(default_factory=dict)  # 0x00.. DC, 0x10.. AC
    quantisers: dict[int, int] = field(default_factory=dict)  # the DC entry
    interval: int = 0
    scan: list[tuple[int, int]] = field(default_factory=list)  # table numbers by component
    pieces: list[np.ndarray] = field(default_factory=list)

    @property
    def mcu(self) -> tuple[int, int]:
        h, v = (max(c[k] for c in self.components) for k in (1, 2)) if len(self.components) > 1 else (1, 1)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    def layout(self) -> tuple[int, ...]:
        """The component of each block of an MCU."""
        if len(self.components) == 1:
            return (0,)
        return tuple(k for k, c in enumerate(self.components) for _ in range(c[1] * c[2]))


#: A marker that ends a scan: neither stuffing nor a restart marker.
_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7]")


def parse(raw: bytes) -> Iterator[Frame]:
    """The images of a stored form, one after another. Progressive and arithmetic coding are errors."""
    at, f, open_ = 0, Frame(), True
    while at + 1 < len(raw):
        if raw[at] != 0xFF:
            raise ValueError(f"no marker at byte {at}")
        marker = raw[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        at += 2
        if marker == 0xD8:
            f, open_ = Frame(), True
            continue
        if marker == 0xD9:
            yield f
            open_ = False
            continue
        size = struct.unpack_from(">H", raw, at)[0]
        body, at = raw[at + 2 : at + size], at + size
        if marker in (0xC0, 0xC1):
            depth, f.height, f.width, n = struct.unpack_from(">BHHB", body)
            if depth != 8:
                raise ValueError("only 8-bit samples")
            f.components = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("only baseline JPEG")
        elif marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                f.quantisers[body[k] & 15] = struct.unpack_from(">H", body, k + 1)[0] if wide else body[k + 1]
                k += 129 if wide else 65
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                counts = tuple(body[k + 1 : k + 17])
                f.tables[body[k]] = counts, tuple(body[k + 17 : k + 17 + sum(counts)])
                k += 17 + sum(counts)
        elif marker == 0xDD:
            f.interval = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            chosen = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            if len(chosen) != len(f.components):
                raise ValueError("only scans of all components")
            f.scan = [(chosen[c[0]] >> 4, 16 + (chosen[c[0]] & 15)) for c in f.components]
            found = _SCAN_END.search(raw, at)
            end = found.start() if found else len(raw)
            data = np.frombuffer(raw, dtype=np.uint8, offset=at, count=end - at)
            marks = np.flatnonzero(data[:-1] == 0xFF)
            follow = data[marks + 1]
            restarts = marks[follow != 0]
            keep = np.ones(len(data), dtype=bool)
            keep[marks[follow == 0] + 1] = False  # stuffing
            keep[restarts], keep[restarts + 1] = False, False
            cuts = np.concatenate([[0], np.cumsum(keep)])[restarts]
            f.pieces = np.split(data[keep], cuts)
            at = end
    if open_:
        raise ValueError("no end of image")


def dc_thumbnails(frames: list[Frame]) -> list[np.ndarray]:
    """For each image the luminance's DC-only thumbnail as uint8: one pixel for each 8x8 block."""
    out: list[np.ndarray] = [np.zeros((0, 0), np.uint8)] * len(frames)
    groups: dict[tuple, list[int]] = {}
    for i, f in enumerate(frames):
        groups.setdefault((tuple(sorted(f.tables.items())), tuple(f.scan), f.layout()), []).append(i)
    for (tables, scan, layout), members in groups.items():
        found = {k: lookup(*t) for k, t in tables}
        lanes, counts = [], []
        for i in members:
            f = frames[i]
            total = f.mcu[0] * f.mcu[1]
            per = f.interval or total
            if len(f.pieces) != -(-total // per):
                raise ValueError("a restart marker is missing")
            lanes += f.pieces
            counts += [min(per, total - s) for s in range(0, total, per)]
        values = _decode(lanes, np.array(counts), layout, scan, found)
        at = 0
        for i in members:
            f = frames[i]
            n = len(f.pieces)
            out[i] = _thumbnail(f, [v[at : at + n] for v in values], counts[at : at + n])
            at += n
    return out


def _decode(lanes: list[np.ndarray], mcus: np.ndarray, layout: tuple[int, ...], scan: tuple, tables: dict) -> list[np.ndarray]:
    """DC coefficients of component 0: for each of its blocks in an MCU an array [lane, MCU]."""
    pad = np.zeros(8, np.uint8)
    sizes = np.array([len(x) + 8 for x in lanes])
    data = np.concatenate([y for x in lanes for y in (x, pad)]).astype(np.int64)
    window = np.zeros(len(data), dtype=np.int64)  # the 48 bits from each byte on
    for k in range(6):
        window[: len(data) - k] |= data[k:] << (40 - 8 * k)
    order = np.argsort(-mcus, kind="stable")  # lanes that end early are at the end
    pos = (8 * (np.cumsum(sizes) - sizes))[order]
    limit = pos + 8 * (sizes[order] - 8)
    alive = np.searchsorted(-mcus[order], -np.arange(int(mcus.max())), side="left")  # lanes with more than m MCUs
    first = [k for k, c in enumerate(layout) if c == 0]
    out = [np.zeros((len(lanes), int(mcus.max())), dtype=np.int32) for _ in first]
    last = np.zeros((max(layout) + 1, len(lanes)), dtype=np.int64)
    bits = lambda p: window[p >> 3] << (p & 7)  # noqa: E731  the next 41 bits at least, from bit 47 down
    for m in range(int(mcus.max())):
        n = int(alive[m])
        p = pos[:n]
        for k, c in enumerate(layout):
            dc, ac = tables[scan[c][0]], tables[scan[c][1]]
            w = bits(p)
            code = dc[(w >> 32) & 0xFFFF]
            length, size = code >> 8, code & 255
            raw = (w >> (48 - length - size)) & ((1 << size) - 1)
            last[c, :n] += np.where(raw << 1 >> size, raw, raw - (1 << size) + 1)
            if c == 0:
                out[first.index(k)][:n, m] = last[c, :n]
            p = p + length + size
            code = ac[(bits(p) >> 32) & 0xFFFF]
            p += code >> 8
            open_ = np.flatnonzero(code & 255)  # blocks with AC coefficients, or with a code that is none
            at = np.zeros(len(open_), dtype=np.int64)
            code = code[open_]
            if (length == 0).any() or (code == 0).any():
                raise ValueError("a code that is in no table")
            while len(open_):
                run, size = (code >> 4) & 15, code & 15
                at += run + 1
                p[open_] += size
                going = np.flatnonzero(at < 63)
                open_, at = open_[going], at[going]
                code = ac[(bits(p[open_]) >> 32) & 0xFFFF]
                p[open_] += code >> 8
                going = np.flatnonzero(code & 255)
                open_, at, code = open_[going], at[going], code[going]
        if (p > limit[:n]).any():
            raise ValueError("a scan ends early")
        pos[:n] = p
    back = np.argsort(order)
    return [x[back] for x in out]


def _thumbnail(f: Frame, values: list[np.ndarray], counts: list[int]) -> np.ndarray:
    wide, high = f.mcu
    flat = [np.concatenate([row[:c] for row, c in zip(v, counts)]).reshape(high, wide) for v in values]
    h, v = (f.components[0][1], f.components[0][2]) if len(f.components) > 1 else (1, 1)
    grid = np.zeros((high * v, wide * h), dtype=np.int64)
    for k, x in enumerate(flat):
        grid[k // h :: v, k % h :: h] = x
    top = (max(c[1] for c in f.components), max(c[2] for c in f.components)) if len(f.components) > 1 else (1, 1)
    grid = grid[: -(-f.height * v // (8 * top[1])), : -(-f.width * h // (8 * top[0]))]
    scaled = grid * f.quantisers[f.components[0][3]]
    return np.clip((scaled + 4 >> 3) + 128, 0, 255).astype(np.uint8)


def thumbnail_hash(pixels: np.ndarray) -> str:
    """64 bits in hex: each of 8x8 cells against the mean of the cells; an image is cut into 8x8 nearly equal parts."""
    h, w = pixels.shape
    rows, cols = (np.linspace(0, n, 9).astype(np.int64) for n in (h, w))
    area = np.zeros((h + 1, w + 1), dtype=np.int64)
    area[1:, 1:] = pixels.cumsum(0, dtype=np.int64).cumsum(1)
    corner = area[np.ix_(rows, cols)]
    sums = corner[1:, 1:] - corner[:-1, 1:] - corner[1:, :-1] + corner[:-1, :-1]
    cells = np.maximum(1, np.outer(np.diff(rows), np.diff(cols)))
    return np.packbits(sums * int(cells.sum()) > int(sums.sum()) * cells).tobytes().hex()


COLUMNS = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
_TYPES = dict(zip(COLUMNS, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())))
SCHEMA = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


class Digest:
    """What is told of one stored form, from its decoded images in order."""

    def __init__(self, raw: bytes):
        self.media = len(raw), hashlib.sha256(raw).hexdigest()
        self.sha, self.size, self.tail, self.features = hashlib.sha256(), 0, b"", []

    def add(self, f: Frame, thumbnail: np.ndarray) -> None:
        back = thumbnail.tobytes()
        self.sha.update(back)
        self.size += len(back)
        self.tail = (self.tail + back)[-UNIT:]
        self.features.append(f"{f.width}x{f.height}:{thumbnail_hash(thumbnail)}")

    def row(self) -> tuple:
        return (self.size, self.sha.hexdigest(), zlib.crc32(self.tail), *self.media, ",".join(self.features))


def digests(stored: list[bytes]) -> list[Digest]:
    """Decodes the images of stored forms in groups of bounded size, whatever form they belong to."""
    out, some, size = [Digest(raw) for raw in stored], [], 0

    def decode() -> None:
        for (k, f), thumbnail in zip(some, dc_thumbnails([f for _, f in some])):
            out[k].add(f, thumbnail)
        some.clear()

    for k, raw in enumerate(stored):
        for f in parse(raw):
            some.append((k, f))
            size += sum(map(len, f.pieces))
            if size >= GROUP:
                decode()
                size = 0
    decode()
    return out


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): the stored form of each text of docs(doc_id, text; other columns are ignored).

    Null and empty texts are 64 zero bytes. Equal texts have equal stored forms. Repeated rows and null ids stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in _slices(b, b.column("text")):
                raw = [(t.as_py() or "") for t in some.column("text")]
                sizes = pa.array([len(t.encode()) for t in raw], pa.int64())
                yield batch(doc_id=some.column("doc_id"), n_bytes=sizes, media=pa.array(encode([payload(t) for t in raw]), pa.binary()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, media binary")


def _slices(b: pa.RecordBatch, measured: pa.Array) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `GROUP` bytes of `measured`; one long value is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(measured), 0).to_numpy(zero_copy_only=False).astype(np.int64) + UNIT) // GROUP
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(b)]
    for s, e in zip(cuts, cuts[1:]):
        if e > s:
            yield b.slice(s, e - s)


def read_back(media: DataFrame) -> DataFrame:
    """Digests and features of the stored forms of media(doc_id, n_bytes, media), from the decoded thumbnails alone.

    feature has "<width>x<height>:<thumbnail hash>" for each image, joined by commas.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in _slices(b, b.column("media")):
                rows = [d.row() for d in digests(some.column("media").to_pylist())]
                told = {c: pa.array(v, _TYPES[c]) for c, v in zip(COLUMNS, zip(*rows))}
                yield batch(doc_id=some.column("doc_id"), n_bytes=some.column("n_bytes"), **told)

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
