"""Media columns: baseline JPEG files that hold bytes, and their DC-only thumbnails.

Storing: the unit of the format is the quantised DCT coefficient. A payload is
padded with bytes 32 to a multiple of 192, three 8x8 blocks. Each byte becomes the
eight magnitude bits of one coefficient of category 8, so byte b is the value b
for b > 127 and b - 255 otherwise, which is lossless. Blocks are 64 coefficients
in zigzag order; a restart interval of one block keeps the DC predictor at zero and
lets blocks be decoded side by side. A comment segment states the payload's length.

Reading: a decoder for baseline files of one scan (any Huffman tables, sampling
factors, restart intervals, runs, end of block, byte stuffing); of a file with a scan for each component
it reads the first one only. It parses the
markers, splits scans at restart markers and decodes the Huffman codes of all
intervals of a batch of files in lock step with numpy. DC coefficients of the first
component, times their quantiser, give the luminance thumbnail, one sample per
block, from which an 8x8 average hash and a checksum are made.

Defined results: null text counts as empty and is stored as 192 bytes 32; equal
texts give equal values, so there are no ties to decide; repeated rows give repeated rows; very long texts are stored whole, and those too long for three
columns of blocks get more columns; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common

UNIT = 192
_MOST_ROWS = 65535 // 8
_MARK = "payload bytes:"


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def pad(data: bytes) -> bytes:
    """Bytes 32 up to a positive multiple of 192."""
    return data + b" " * (max(-(-len(data) // UNIT), 1) * UNIT - len(data))


def store(payload: bytes) -> bytes:
    """A baseline JPEG file that holds a padded payload."""
    n = len(payload) // 64
    wide = 3 * -(-n // (3 * _MOST_ROWS))
    high = -(-n // wide)
    blocks = np.full((wide * high, 8, 8), 32, np.uint8)
    blocks.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    # Eight coefficients are eight times a code of one zero bit and a byte: nine bytes.
    bits = np.zeros((wide * high, 8, 9), np.uint8)
    for j in range(8):
        bits[..., j] |= blocks[..., j] >> (j + 1)
        bits[..., j + 1] |= blocks[..., j] << (7 - j)
    rows = np.empty((wide * high, 74), np.uint8)
    rows[:, :72] = bits.reshape(-1, 72)
    rows[:, 72] = 0xFF
    rows[:, 73] = 0xD0 + np.arange(wide * high) % 8
    flat = rows.reshape(-1)[:-2]
    stuffed = (rows == 0xFF)
    stuffed[:, 72] = False
    hits = np.flatnonzero(stuffed.reshape(-1)[:-2])
    scan = np.insert(flat, hits + 1, 0) if len(hits) else flat
    one_code = bytes([1] + [0] * 15)
    return b"".join(
        [
            b"\xff\xd8",
            _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"),
            _segment(0xFE, f"{_MARK}{len(payload)}".encode()),
            _segment(0xDB, b"\0" + b"\x01" * 64),
            _segment(0xC0, bytes([8]) + (8 * high).to_bytes(2, "big") + (8 * wide).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])),
            _segment(0xC4, b"\x00" + one_code + b"\x08" + b"\x10" + one_code + b"\x08"),
            _segment(0xDD, (1).to_bytes(2, "big")),
            _segment(0xDA, bytes([1, 1, 0, 0, 63, 0])),
            scan.tobytes(),
            b"\xff\xd9",
        ]
    )


@dataclass
class Frame:
    """What the markers of a file say."""

    width: int = 0
    height: int = 0
    components: list[tuple[int, int, int, int]] = field(default_factory=list)  # id, h, v, table
    quant: dict[int, bytes] = field(default_factory=dict)
    huffman: dict[int, bytes] = field(default_factory=dict)  # class * 16 + id: counts and symbols
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # component, DC and AC table
    interval: int = 0
    comment: bytes = b""
    segments: list[np.ndarray] = field(default_factory=list)

    @property
    def mcus(self) -> tuple[int, int]:
        h, v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        return -(-self.width // (8 * h)), -(-self.height // (8 * v))

    def units(self) -> list[tuple[int, int, int]]:
        """Blocks of an MCU: component, DC and AC table."""
        if len(self.scan) == 1:
            return [self.scan[0]]
        return [(c, dc, ac) for c, dc, ac in self.scan for _ in range(self.components[c][1] * self.components[c][2])]

    def key(self) -> tuple:
        return tuple(self.units()), tuple(sorted(self.huffman.items()))


def parse(data: bytes) -> Frame:
    """Read the markers of a baseline file with one scan, and split the scan at its restarts."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    frame, at = Frame(), 2
    while True:
        if data[at] != 0xFF:
            raise ValueError(f"no marker at {at}")
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if kind == 0xDB:
            while body:
                wide = 1 + (body[0] >> 4)
                frame.quant[body[0] & 15] = body[1 : 1 + 64 * wide]
                body = body[1 + 64 * wide :]
        elif kind == 0xC0:
            frame.height, frame.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            frame.components = [(c[0], c[1] >> 4, c[1] & 15, c[2]) for c in (body[6 + 3 * i : 9 + 3 * i] for i in range(body[5]))]
        elif 0xC1 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline file")
        elif kind == 0xC4:
            while body:
                n = sum(body[1:17])
                frame.huffman[body[0]] = body[1 : 17 + n]
                body = body[17 + n :]
        elif kind == 0xDD:
            frame.interval = int.from_bytes(body, "big")
        elif kind == 0xFE:
            frame.comment = body
        elif kind == 0xDA:
            order = [c[0] for c in frame.components]
            frame.scan = [(order.index(body[1 + 2 * i]), body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
            break
    coded = np.frombuffer(data, np.uint8, offset=at)
    marks = np.flatnonzero(coded[:-1] == 0xFF)
    follow = coded[marks + 1]
    ends = marks[(follow != 0) & (follow != 0xFF)]
    stops = ends[coded[ends + 1] >> 3 != 0xD0 >> 3][:1]
    ends = ends[ends <= stops[0]] if len(stops) else np.append(ends, len(coded))
    begins = np.concatenate([[0], ends[:-1] + 2])
    stuffed = marks[follow == 0] + 1
    if not len(stuffed):
        frame.segments = [coded, begins, ends]
    else:
        keep = np.ones(len(coded), bool)
        keep[stuffed] = False
        shift = np.concatenate([[0], np.cumsum(~keep)])
        frame.segments = [coded[keep], begins - shift[begins], ends - shift[ends]]
    return frame


def code_table(spec: bytes) -> np.ndarray:
    """For every 16 bits ahead: code length * 256 + symbol; 0 where no code begins so."""
    out, code, at = np.zeros(1 << 16, np.uint16), 0, 16
    for length in range(1, 17):
        for _ in range(spec[length - 1]):
            span = 1 << (16 - length)
            out[code * span : (code + 1) * span] = length * 256 + spec[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


def _extend(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The signed value that ``size`` magnitude bits stand for."""
    return np.where(bits < (1 << size >> 1), bits - (1 << size) + 1, bits)


def decode_scans(frames: list[Frame]) -> list[np.ndarray]:
    """Quantised coefficients of files with equal tables: per file (MCUs, units, 64), in zigzag order."""
    units = frames[0].units()
    tables = {k: code_table(v) for k, v in frames[0].huffman.items()}
    counts, limits, begins, base = [], [], [], 0
    for f in frames:
        w, h = f.mcus
        step = f.interval or w * h
        n = -(-w * h // step)
        if len(f.segments[1]) < n:
            raise ValueError("the scan ends early")
        counts.append(w * h)
        limits.append(np.minimum(step, w * h - step * np.arange(n)))
        begins.append(f.segments[1][:n] + base)
        base += len(f.segments[0])
    flat = np.concatenate([*(f.segments[0] for f in frames), np.zeros(8, np.uint8)]).astype(np.uint32)
    ahead = flat[:-3] << 24 | flat[1:-2] << 16 | flat[2:-1] << 8 | flat[3:]
    bit = np.concatenate(begins).astype(np.int64) * 8
    limit = np.concatenate(limits)
    row = np.concatenate([[0], np.cumsum(limit)[:-1]])
    out = np.zeros((int(limit.sum()), len(units), 64), np.int16)
    last = np.zeros((len(limit), len(frames[0].components)), np.int64)

    def take(pos: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbol, its magnitude bits' value, and the position behind them."""
        view = ahead[pos >> 3] << (pos & 7).astype(np.uint32)
        entry = table[view >> 16]
        if not entry.all():
            raise ValueError("a code that no table has")
        symbol, used = (entry & 255).astype(np.int64), (entry >> 8).astype(np.int64)
        size, pos = symbol & 15, pos + used
        view = ahead[pos >> 3] << (pos & 7).astype(np.uint32)
        bits = (view >> 16).astype(np.int64) >> (16 - size)
        return symbol, _extend(bits, size), pos + size

    for m in range(int(limit.max())):
        live = np.flatnonzero(limit > m)
        for u, (component, dc, ac) in enumerate(units):
            _, diff, pos = take(bit[live], tables[dc])
            last[live, component] += diff
            target = row[live] + m
            out[target, u, 0] = last[live, component]
            who, k = np.arange(len(live)), np.ones(len(live), np.int64)
            while len(who):
                symbol, value, then = take(pos[who], tables[16 + ac])
                pos[who] = then
                run, coded = symbol >> 4, (symbol & 15) > 0
                k = k + run
                if coded.any():
                    if (k[coded] > 63).any():
                        raise ValueError("a run goes past the block")
                    out[target[who[coded]], u, k[coded]] = value[coded]
                k = k + 1
                on = ((symbol != 0) & (k < 64))
                if not on.all():
                    who, k = who[on], k[on]
            bit[live] = pos
    cuts = np.cumsum(counts)[:-1]
    return np.split(out, cuts)


def decode(files: list[bytes]) -> list[tuple[Frame, np.ndarray]]:
    """Frames and coefficients of files; those with equal tables are decoded together."""
    frames = [parse(x) for x in files]
    groups: dict[tuple, list[int]] = defaultdict(list)
    for i, f in enumerate(frames):
        groups[f.key()].append(i)
    out: list = [None] * len(files)
    for members in groups.values():
        for i, coefficients in zip(members, decode_scans([frames[i] for i in members])):
            out[i] = (frames[i], coefficients)
    return out


def payload_of(frame: Frame, coefficients: np.ndarray) -> bytes:
    """The payload of a file that ``store`` made."""
    values = coefficients.reshape(-1)
    stored = np.where(values > 0, values, values + 255).astype(np.uint8).tobytes()
    return stored[: int(frame.comment.decode().removeprefix(_MARK))]


def thumbnail(frame: Frame, coefficients: np.ndarray) -> np.ndarray:
    """One luminance sample per block of the first component, from DC alone."""
    units = frame.units()
    first = [u for u, x in enumerate(units) if x[0] == units[0][0]]
    w, h = frame.mcus
    _, fh, fv, table = frame.components[units[0][0]]
    if len(frame.scan) == 1:
        fh = fv = 1
    spec = frame.quant[table]
    step = spec[0] if len(spec) == 64 else int.from_bytes(spec[:2], "big")
    dc = coefficients[:, first, 0].reshape(h, w, fv, fh).transpose(0, 2, 1, 3).reshape(h * fv, w * fh)
    return np.clip(np.round(dc.astype(np.float64) * step / 8) + 128, 0, 255).astype(np.uint8)


def average_hash(thumb: np.ndarray) -> int:
    """64 bits: samples of an 8x8 grid above their mean."""
    h, w = thumb.shape
    grid = thumb[np.ix_(np.arange(8) * h // 8, np.arange(8) * w // 8)].astype(np.int64)
    return int.from_bytes(np.packbits(grid * 64 > grid.sum()).tobytes(), "big")


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, media (a JPEG file)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                media = [store(pad(t)) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(len, texts), pa.int64()), pa.array(media, pa.binary())], schema=schema
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return rows.mapInArrow(encode, "doc_id long, n_bytes long, media binary")


FEATURES = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
    "media_bytes long, media_sha256 string, feature string, width int, height int, thumb_hash string"
)


def media_features(media: DataFrame) -> DataFrame:
    """Decode stored files: payload digests, dimensions and thumbnail hashes."""
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in FEATURES.split(", "))])

    def describe(doc_id: int, n_bytes: int, file: bytes, frame: Frame, coefficients: np.ndarray) -> tuple:
        payload, thumb = payload_of(frame, coefficients), thumbnail(frame, coefficients)
        mark = f"{average_hash(thumb):016x}"
        feature = f"{frame.width}x{frame.height}:{mark}:{zlib.crc32(thumb.tobytes()):08x}"
        return (
            doc_id, n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]),
            len(file), hashlib.sha256(file).hexdigest(), feature, frame.width, frame.height, mark,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in _bounded(batch.column("media")):
                ids, sizes, files = (c.to_pylist() for c in batch.slice(at, upto - at).select(["doc_id", "n_bytes", "media"]).columns)
                rows = [describe(i, n, f, *d) for i, n, f, d in zip(ids, sizes, files, decode(files))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, FEATURES)


def _bounded(files: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of files of about ``most`` bytes."""
    start = size = 0
    for i, x in enumerate(files):
        size += len(x.as_buffer())
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(files):
        yield start, len(files)


def op7_media_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(to_media(common.table(spark, sf_dir, "documents")))
