"""Removal of repeated byte strings by bucket-pointer refinement over sampled suffixes.

A byte goes when a string of ``span`` bytes that covers it starts at another place
too, in the same or another document. Strings are judged on the input.

How it works. Sorting all suffixes of the corpus would move many times its size. A
string of ``span`` bytes that occurs twice has the same content twice, so every
choice made from content alone is made twice. In each window of ``span`` bytes the
q-gram with the smallest hash (the rightmost, on ties) is the window's anchor.
Equal windows have equal anchors at equal offsets, so it is enough to sort the
suffixes at anchors, about one position in a hundred, and each window belongs to
exactly one of them. An anchor stands for the windows that chose it: those that
begin ``low`` to ``high`` bytes before it.

1. Initial buckets: anchors with the same q-gram. Each row also has the hash of its
   extent, all bytes of its windows. Rows of one bucket with the same extent are
   repeats in all their windows. A bucket of one row is no repeat. Only buckets with
   several extents are refined.
2. Refinement by bucket identifiers of later offsets: the windows of such an anchor are
   divided into ranges of nearby offsets. The new bucket of a range is named by its old
   bucket and the identifiers of the q-gram buckets at the later and earlier offsets that
   all its windows share. Identifiers are doubled inside a context: that of the bucket of 2 q bytes comes from
   those of q bytes at an offset and q bytes later, that of 4 q bytes from these. A
   range's extent is what any of its windows covers. The same three cases decide. What
   is still mixed is divided again, down to single windows, where bucket and extent are one.

Departure from the method as it is named: what is looked up at later offsets are the buckets of all suffixes by their first q, 2 q, 4 q ...
bytes, named by 64-bit hashes, and each level makes these names anew from the bytes of the context. Buckets are not sorted on
identifiers, and a bucket that refinement has split is looked up by no other range; only a range's own bucket goes on from level
to level. Names of sorted ranks would need all suffixes of the corpus in one table, sorted globally and looked up by
position in each pass: a row of three numbers for each byte, some 24 bytes a byte before any pass, where the whole operator
now writes about twice its input.

Each level is a grouping by short hashes with a map-side combine, so a passage that
a third of all documents share costs one row per task and level; rows then meet the few
decided buckets in a plain join, whose hot partitions adaptive execution splits. Text is read twice: to find anchors, and, joined with
the mixed anchors, to cut their contexts; a last join of removed runs with the
documents makes the remaining text. Between levels the contexts are written to the
shared folder.

Defined results: null text counts as empty; texts under ``span`` bytes are never
touched; exact copies of at least ``span`` bytes vanish whole, each of them; rows
with equal ids count as one document each and are told apart by a 64-bit hash of their text and
its length, rows without an id by 128 bits of their text, so equal rows are copies of each other; very long texts are read in parts that
overlap, so each window is in one; an empty table gives no rows; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common

#: Widths of the ranges of window offsets at the levels of refinement; each is a multiple of the next.
LEVELS = (28, 7, 1)
#: Low bits of a packed hash that hold the place in a chunk.
_PLACE = (1 << 24) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes (the finaliser of a public integer hash)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def qgram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of each q-gram, built by doubling its length."""
    h, width, multiplier = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width * 2 <= q:
        h = h[:-width] * np.uint64(multiplier) + h[width:]
        multiplier = multiplier * multiplier % (1 << 64)
        width *= 2
    if width < q:
        h = h[: len(h) - (q - width)] * np.uint64(0xC2B2AE3D27D4EB4F) + h[q - width :]
    return _mix(h)


def anchors(data: np.ndarray, ends: np.ndarray, span: int, q: int) -> tuple[np.ndarray, ...]:
    """Anchors of documents laid end to end, of under 16 MB in all.

    Returns per anchor its position, the first and last window that chose it, and
    its q-gram's hash. Windows are numbered by where they begin.
    """
    n, width = len(data) - span + 1, span - q + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h = qgram_hashes(data, q)
    # Upper bits order the q-grams; the place, counted down, makes ties fall to the right.
    places = np.uint64(_PLACE) - np.arange(len(h), dtype=np.uint64)
    low, had = (h & ~np.uint64(_PLACE)) | places, 1
    while had * 2 <= width:
        low = np.minimum(low[:-had], low[had:])
        had *= 2
    low = np.minimum(low[:n], low[width - had : width - had + n])
    chosen = _PLACE - (low & np.uint64(_PLACE)).astype(np.int64)
    # Windows that reach into the next document are none.
    for end in ends[:-1].tolist():
        chosen[max(0, end - span + 1) : end] = -1
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.append(first[1:], n) - 1
    real = chosen[first] >= 0
    first, last = first[real], last[real]
    pos = chosen[first]
    return pos, first, last, h[pos].view(np.int64)


def row_key(given: Column, data: Column) -> tuple[Column, Column]:
    """The two numbers that name a row: its id, or half a digest of its text, and a hash of the text and its length."""
    digest = F.conv(F.substring(F.md5(data), 1, 16), 16, -10).cast("long")
    return F.coalesce(given.cast("long"), digest).alias("doc_id"), F.xxhash64(data, F.octet_length(data)).alias("row")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents as (given, doc_id, row, data): the id as it is, and the key that tells rows apart."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data")
    rows = docs.select(F.col(id_col).cast("long").alias("given"), data)
    return rows.select("given", *row_key(F.col("given"), F.col("data")), "data")


def sampled_suffixes(texts: DataFrame, span: int, q: int, chunk: int = 128 << 10) -> DataFrame:
    """One row per anchor: doc_id, row, place, bucket, extent.

    ``place`` packs the anchor's position with the first and last offset of its windows.
    """
    if not q + LEVELS[0] <= span <= q + 255:
        raise ValueError(f"span must be from q + {LEVELS[0]} to q + 255")
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("bucket", pa.int64()), ("extent", pa.int64())])

    def emit(held: list[tuple[int, int, int, memoryview]]) -> pa.RecordBatch:
        sizes = np.array([len(x[3]) for x in held], np.int64)
        ends = np.cumsum(sizes)
        joined = b"".join(x[3] for x in held)
        pos, first, last, bucket = anchors(np.frombuffer(joined, np.uint8), ends, span, q)
        doc = np.searchsorted(ends, pos, side="right")
        digest, view = xxhash.xxh3_64_intdigest, memoryview(joined)
        extent = np.fromiter((digest(view[a:b]) for a, b in zip(first.tolist(), (last + span).tolist())), np.uint64, len(pos))
        ids, rows, shift = (np.array([x[k] for x in held], np.int64) for k in range(3))
        place = (pos - (ends - sizes)[doc] + shift[doc]) << 16 | (pos - first) << 8 | (pos - last)
        columns = [ids[doc], rows[doc], place, bucket, extent.view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, 8 << 20
        for batch in batches:
            for doc_id, row, data in zip(*(c.to_pylist() for c in batch.columns)):
                if len(data) < span:
                    continue
                # Parts of a very long text overlap, so that each window is in exactly one.
                for at in range(0, len(data) - span + 1, most):
                    held.append((doc_id, row, at, memoryview(data)[at : at + most + span - 1]))
                    size += len(held[-1][3])
                    if size >= chunk:
                        yield emit(held)
                        held, size = [], 0
        if held:
            yield emit(held)

    return texts.select("doc_id", "row", "data").mapInArrow(sample, "doc_id long, row long, place long, bucket long, extent long")


def unpacked(place: int) -> tuple[int, int, int]:
    """Position, first and last window offset."""
    return place >> 16, place & 255, place >> 8 & 255


def judged(rows: DataFrame, weight: Column, label: str) -> tuple[DataFrame, DataFrame]:
    """Refine by bucket: rows that are repeats in whole, and rows of mixed buckets.

    A weight of 2 stands for several equal extents. Buckets of one row are dropped.
    ``rows`` must be stored; what is left is stored once for both results.
    """
    buckets = (
        rows.groupBy("bucket")
        .agg(F.sum(weight).alias("_n"), F.min("extent").alias("_a"), F.max("extent").alias("_b"))
        .where("_n > 1")
        .select("bucket", (F.col("_a") == F.col("_b")).alias("_same"))
    )
    # Stored, so that the join has a shuffle of its own, which can be split where a bucket is hot.
    buckets = common.materialise(buckets, "bucket-kinds")
    shared = common.materialise(rows.join(buckets, "bucket"), label)
    common.discard(buckets)
    return shared.where("_same").drop("_same"), shared.where("NOT _same").drop("_same")


def contexts(texts: DataFrame, mixed: DataFrame, span: int) -> DataFrame:
    """The bytes of all windows of mixed anchors, cut from the joined texts."""
    wanted = mixed.groupBy("doc_id", "row").agg(F.collect_list(F.struct("place", "bucket", "weight")).alias("anchors"))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for doc_id, row, data, found in zip(frame["doc_id"], frame["row"], frame["data"], frame["anchors"]):
                for a in found:
                    pos, low, high = unpacked(a["place"])
                    out.append((doc_id, row, a["place"], a["bucket"], a["weight"], bytes(data[pos - high : pos - low + span])))
            yield pd.DataFrame(out, columns=["doc_id", "row", "place", "bucket", "weight", "data"])

    joined = texts.drop("given").join(wanted, ["doc_id", "row"])
    return joined.mapInPandas(cut, "doc_id long, row long, place long, bucket long, weight int, data binary")


class Names:
    """Identifiers of the buckets of all substrings of contexts laid end to end, by doubling those of q-grams."""

    def __init__(self, data: np.ndarray, q: int, longest: int) -> None:
        self.q, self.levels = q, [qgram_hashes(data, q)]
        width = q
        while 2 * width <= longest:
            last = self.levels[-1]
            self.levels.append(_mix(last[:-width] * np.uint64(0x9E3779B97F4A7C15) + last[width:]))
            width *= 2

    def of(self, begin: np.ndarray, size: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The bucket of ``size`` bytes at ``begin``, within bucket ``base``: two identifiers cover them."""
        level = np.floor(np.log2(size / self.q)).astype(np.int64)
        h = _mix(base * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64))
        first, last = np.empty(len(h), np.uint64), np.empty(len(h), np.uint64)
        for k in np.unique(level).tolist():
            at = level == k
            first[at] = self.levels[k][begin[at]]
            last[at] = self.levels[k][begin[at] + size[at] - (self.q << k)]
        return _mix(_mix(h + first) * np.uint64(0xC2B2AE3D27D4EB4F) + last)


def divided(parts: DataFrame, span: int, q: int, width: int, within: int | None = None) -> DataFrame:
    """Ranges of ``width`` window offsets of each context, with their buckets and extents.

    ``parts`` has a column ``nodes`` of ranges and their buckets if only those, of width
    ``within``, are to be divided. In the result ``place`` has the offsets of the range,
    ``anchor`` those of the context.
    """
    names = ["doc_id", "row", "anchor", "node", "place", "weight", "bucket", "extent"]

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), 5000):
                frame = whole.iloc[at : at + 5000]
                place = frame["place"].to_numpy(np.int64)
                low, high = place & 255, place >> 8 & 255
                sizes = frame["data"].map(len).to_numpy(np.int64)
                base = np.cumsum(sizes) - sizes
                found = Names(np.frombuffer(b"".join(frame["data"]), np.uint8), q, span + width)
                if within:
                    counts = frame["nodes"].map(len).to_numpy(np.int64)
                    nodes = np.array([n["node"] for x in frame["nodes"] for n in x], np.int64)
                    bucket = np.array([n["bucket"] for x in frame["nodes"] for n in x], np.int64)
                    i = np.repeat(np.arange(len(frame)), counts)
                    begin, end = np.maximum(low[i], nodes * within), np.minimum(high[i], nodes * within + within - 1)
                else:
                    i, begin, end, bucket = np.arange(len(frame)), low, high, frame["bucket"].to_numpy(np.int64)
                # Numbers of the ranges of each.
                counts = end // width - begin // width + 1
                last = np.cumsum(counts)
                k = np.repeat(begin // width - (last - counts), counts) + np.arange(int(last[-1]))
                i, begin, end, bucket = (np.repeat(x, counts) for x in (i, begin, end, bucket))
                a, b = np.maximum(begin, k * width), np.minimum(end, k * width + width - 1)
                # Offset x before the anchor is byte high - x of the context.
                start = base[i] + high[i]
                own = found.of(start - k * width, np.full(len(k), span - width + 1), bucket.view(np.uint64) + k.astype(np.uint64))
                extent = own if width == 1 else found.of(start - b, span + b - a, np.zeros(len(k), np.uint64))
                columns = (
                    frame["doc_id"].to_numpy()[i], frame["row"].to_numpy()[i], place[i], k, (place[i] >> 16) << 16 | b << 8 | a,
                    frame["weight"].to_numpy()[i], own.view(np.int64), extent.view(np.int64),
                )
                yield pd.DataFrame(dict(zip(names, columns)))

    return parts.mapInPandas(split, "doc_id long, row long, anchor long, node int, place long, weight int, bucket long, extent long")


def repeated_runs(docs: DataFrame, span: int = 200, q: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Byte runs to remove: doc_id, row, begin, end; they may touch and overlap."""
    texts = _texts(docs, id_col, text_col)

    def run(rows: DataFrame) -> DataFrame:
        pos, high, low = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
        return rows.select("doc_id", "row", (pos - high).alias("begin"), (pos - low + span).alias("end"))

    suffixes = common.materialise(sampled_suffixes(texts, span, q), "suffixes")
    same, mixed = judged(suffixes, F.lit(1), "suffix-buckets")
    common.discard(suffixes)
    runs = run(same)
    # One row of each extent goes on; the others are decided.
    kinds = mixed.groupBy("bucket", "extent").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("doc_id", "row", "place")).alias("_r"))
    kinds = common.materialise(kinds, "suffix-kinds")
    runs = runs.unionByName(run(mixed.join(kinds.where("_n > 1").select("bucket", "extent"), ["bucket", "extent"])))
    one_each = kinds.select("_r.*", "bucket", F.least("_n", F.lit(2)).cast("int").alias("weight"))
    parts = common.materialise(contexts(texts, one_each, span), "contexts")
    for level, width in enumerate(LEVELS):
        nodes = common.materialise(divided(parts, span, q, width, LEVELS[level - 1] if level else None), "nodes")
        same, mixed = judged(nodes, F.col("weight"), "node-buckets")
        common.discard(nodes)
        runs = runs.unionByName(run(same.where("weight = 1")))
        if width > 1:
            left = mixed.groupBy("doc_id", "row", F.col("anchor").alias("place")).agg(F.collect_list(F.struct("node", "bucket")).alias("nodes"))
            fewer = common.materialise(parts.drop("nodes").join(left, ["doc_id", "row", "place"]), "contexts")
            common.discard(parts)
            parts = fewer
    common.discard(parts)
    return runs


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the bytes that any of the given runs covers."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate([[True], begins[1:] > reach[:-1]])
    starts = np.flatnonzero(fresh)
    return begins[starts], reach[np.append(starts[1:], len(begins)) - 1]


REMOVED = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(
    docs: DataFrame, span: int = 200, q: int = 32, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True
) -> DataFrame:
    """One row per document, see ``REMOVED``; ``kept`` is null unless asked for."""
    runs = repeated_runs(docs, span, q, id_col, text_col)
    by_doc = runs.groupBy("doc_id", "row").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("given").to_pylist(), batch.column("data").to_pylist()
            lists = batch.column("runs")
            offsets, flat = lists.offsets.to_numpy(), lists.values
            begins, ends = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            out = []
            for i, (doc_id, data) in enumerate(zip(ids, texts)):
                kept, n_spans = data, 0
                if lists.is_valid()[i].as_py() and offsets[i + 1] > offsets[i]:
                    a, b = merged(begins[offsets[i] : offsets[i + 1]], ends[offsets[i] : offsets[i + 1]])
                    n_spans = len(a)
                    stops = [*a.tolist(), len(data)]
                    kept = b"".join(data[x:y] for x, y in zip([0, *b.tolist()], stops))
                out.append((doc_id, kept if with_kept else None, len(data), len(data) - len(kept), n_spans, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    joined = _texts(docs, id_col, text_col).join(by_doc, ["doc_id", "row"], "left").select("given", "data", "runs")
    return joined.mapInArrow(apply, REMOVED)


def without_repeats(docs: DataFrame, span: int = 200, q: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, with the repeats gone from the text.

    Bytes of a character that a removed run cuts in two go as well.
    """
    runs = repeated_runs(docs, span, q, id_col, text_col)
    by_doc = runs.groupBy("doc_id", "row").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    # All columns travel in one, so none can clash with those of the join.
    key = row_key(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    whole = docs.select(*key, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    joined = whole.join(by_doc, ["doc_id", "row"], "left").select("whole", "runs")

    docs_columns = docs.columns

    def cut(data: bytes, runs: list[dict]) -> str:
        a, b = merged(np.array([r["begin"] for r in runs]), np.array([r["end"] for r in runs]))
        left = [data[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(data)])]
        return "".join(x.decode("utf-8", "ignore") for x in left)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("whole")
            place = docs_columns.index(text_col)
            columns = whole.flatten()
            texts, runs = columns[place].to_pylist(), batch.column("runs").to_pylist()
            columns[place] = pa.array([cut(t.encode(), r) if r else t for t, r in zip(texts, runs)], columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    return joined.mapInArrow(apply, docs.schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(common.table(spark, sf_dir, "documents"), with_kept=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
