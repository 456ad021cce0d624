"""Hierarchical packing of documents into sequences of several lengths.

Each document is tokenised and gets an end id. Whole windows of ``top`` ids become
sequences at once, where the text was tokenised; only what is left, under one
window for any document, is shuffled, so a very long document cannot fill a task.

What is left goes to packing groups by a hash. Their number follows the bytes and the
rows of the table, and rows that are alike are numbered inside a task and dealt by these numbers too, so a
group stays within a fixed size. In a group, parts of at least half
a window open a long window, and its gap is filled from the shorter tiers, the
shortest first. The rest of each tier is cut into full sequences of the tier's
length. The tails of the tiers are joined, cut into windows, and what is under a
window is split into powers of two. So no sequence needs padding. The sequences of
a group are then dealt, longest first and back and forth, to step groups of about
equal numbers of ids.

Defined results: null text counts as empty and gives just the end id; repeated
rows are packed each; ties are ordered by id, start and checksum; very long texts are cut into
windows where they were tokenised; an empty table gives no pieces; other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common, tokens

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, seq_tokens long, step_group long"
)
_PART = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "twin")]
    + [("ids", pa.binary())]
)


def powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def cut(lengths: np.ndarray, capacities: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lay parts end to end and cut them where bins of the given capacities end.

    Returns per piece: part, start in the part, length, bin, offset in the bin.
    The capacities must add up to the lengths.
    """
    part_ends, bin_ends = np.cumsum(lengths), np.cumsum(capacities)
    ends = np.union1d(part_ends, bin_ends)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    part = np.searchsorted(part_ends, starts, side="right")
    bins = np.searchsorted(bin_ends, starts, side="right")
    part_start = part_ends[part] - lengths[part]
    bin_start = bin_ends[bins] - capacities[bins]
    return part, starts - part_start, ends - starts, bins, starts - bin_start


def plan(lengths: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lay out parts, each shorter than ``top``, in sequences.

    Returns the pieces, rows of (part, start, length, sequence, offset), and the
    length of each sequence. Parts are taken in the order given.
    """
    out: list[np.ndarray] = []
    sizes: list[int] = []

    def put(who: np.ndarray, froms: np.ndarray, lens: np.ndarray, caps: list[int], shift: np.ndarray, seqs: np.ndarray) -> None:
        part, start, length, bins, offset = cut(lens, np.array(caps, np.int64))
        out.append(np.stack([who[part], froms[part] + start, length, seqs[bins], shift[bins] + offset], axis=1))

    def new(caps: list[int]) -> np.ndarray:
        sizes.extend(caps)
        return np.arange(len(sizes) - len(caps), len(sizes))

    everyone = np.arange(len(lengths))
    tier = np.maximum(2 ** np.floor(np.log2(np.maximum(lengths, 1))).astype(np.int64), least)
    long = everyone[lengths >= top // 2]
    short = everyone[lengths < top // 2]
    short = short[np.argsort(tier[short], kind="stable")]
    stock = int(lengths[short].sum())
    gaps = top - lengths[long]
    filled = int(np.searchsorted(np.cumsum(gaps), stock, side="right"))
    # Long windows whose gap the shorter tiers can fill.
    seqs = new([top] * filled)
    if filled:
        out.append(np.stack([long[:filled], np.zeros(filled, np.int64), lengths[long[:filled]], seqs, np.zeros(filled, np.int64)], axis=1))
    used = int(gaps[:filled].sum())
    ends = np.cumsum(lengths[short])
    taken = int(np.searchsorted(ends, used, side="left")) + 1 if used else 0
    if used:
        give = lengths[short[:taken]].copy()
        give[-1] -= ends[taken - 1] - used
        put(short[:taken], np.zeros(taken, np.int64), give, gaps[:filled].tolist(), lengths[long[:filled]], seqs)
    # What is left of the shorter tiers, then of the long ones.
    rest, froms = short[taken:], np.zeros(len(short) - taken, np.int64)
    if used and ends[taken - 1] > used:
        last = short[taken - 1]
        rest = np.concatenate([[last], rest])
        froms = np.concatenate([[lengths[last] - (ends[taken - 1] - used)], froms])
    lens = lengths[rest] - froms
    tails: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    loose = [(rest[tier[rest] == t], froms[tier[rest] == t], lens[tier[rest] == t], int(t)) for t in np.unique(tier[rest])]
    loose.append((long[filled:], np.zeros(len(long) - filled, np.int64), lengths[long[filled:]], top))
    for who, begin, size, t in loose:
        total = int(size.sum())
        whole = total // t * t
        if whole:
            part, start, length, bins, offset = cut(size, np.array([t] * (whole // t) + [total - whole] * (total > whole)))
            seq = np.concatenate([new([t] * (whole // t)), [-1]])[bins]
            piece = np.stack([who[part], begin[part] + start, length, seq, offset], axis=1)
            out.append(piece[seq >= 0])
            piece = piece[seq < 0]
            tails.append((piece[:, 0], piece[:, 1], piece[:, 2]))
        elif total:
            tails.append((who, begin, size))
    if tails:
        who, begin, size = (np.concatenate(x) for x in zip(*tails))
        total = int(size.sum())
        if total:
            caps = [top] * (total // top) + powers(total % top)
            put(who, begin, size, caps, np.zeros(len(caps), np.int64), new(caps))
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64), np.array(sizes, np.int64)


def deal(sizes: np.ndarray, per_step: int) -> np.ndarray:
    """A step group for each sequence, so that groups hold about equal numbers of ids."""
    steps = max(1, round(int(sizes.sum()) / per_step))
    place = np.arange(len(sizes))
    turn, seat = np.divmod(place, steps)
    group = np.empty(len(sizes), np.int64)
    group[np.argsort(-sizes, kind="stable")] = np.where(turn % 2 == 0, seat, steps - 1 - seat)
    return group


def tokenised_parts(docs: DataFrame, tokenizer: str, end_id: int, top: int, id_col: str, text_col: str) -> DataFrame:
    """Whole windows (without ids) and what is left of each document (with ids).

    ``twin`` numbers rows of a task that are alike. It does not depend on the order of the rows, so
    a task that runs again gives the same rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer, False)
        end = np.array([end_id], encoder.dtype).tobytes()
        seen: Counter[tuple] = Counter()
        for batch in batches:
            for part in tokens.slices(batch, "text"):
                ids, texts = (c.to_pylist() for c in part.columns)
                rows = []
                for doc_id, raw in zip(ids, encoder.encode(texts)):
                    wide = np.frombuffer(raw + end, encoder.dtype).astype("<u4")
                    for at in range(0, len(wide), top):
                        piece = wide[at : at + top].tobytes()
                        left = None if len(piece) == 4 * top else (raw + end)[at * encoder.dtype.itemsize :]
                        key = (doc_id, at, zlib.crc32(piece))
                        rows.append((doc_id, at, len(piece) // 4, key[2], len(wide), seen[key], left))
                        seen[key] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PART)], schema=_PART)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    return rows.mapInArrow(
        encode, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, twin long, ids binary"
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    top: int = 4096,
    least: int = 256,
    group_bytes: int = 4 << 20,
    group_rows: int = 10_000,
    step_tokens: int = 32 * 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece, see ``PIECES``."""
    size, count = docs.agg(F.sum(F.octet_length(F.col(text_col))), F.count(F.lit(1))).first()
    groups = max(1, (size or 0) // group_bytes, -(-count // group_rows))
    dtype = tokens.id_type(tokenizer)

    def lay_out(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        whole = rows["ids"].isna().to_numpy()
        parts = rows[~whole].reset_index(drop=True)
        windows = rows[whole]
        pieces, sizes = plan(parts["length"].to_numpy(np.int64), top, least)
        raw = parts["ids"].tolist()
        crc = [
            zlib.crc32(np.frombuffer(raw[p], dtype, n, s * dtype.itemsize).astype("<u4").tobytes())
            for p, s, n in pieces[:, :3].tolist()
        ]
        who, n_short = pieces[:, 0], len(sizes)
        sizes = np.concatenate([sizes, np.full(len(windows), top)]).astype(np.int64)
        step = deal(sizes, step_tokens)
        seq = np.concatenate([pieces[:, 3], n_short + np.arange(len(windows))]).astype(np.int64)
        both = lambda a, b: np.concatenate([a, b.to_numpy()])
        out = pd.DataFrame(
            {
                "start": both(parts["start"].to_numpy(np.int64)[who] + pieces[:, 1], windows["start"]),
                "length": both(pieces[:, 2], windows["length"]),
                "ids_crc32": both(np.array(crc, np.int64), windows["ids_crc32"]),
                "doc_tokens": both(parts["doc_tokens"].to_numpy(np.int64)[who], windows["doc_tokens"]),
                "sequence_id": (int(key[0]) << 32) + seq,
                "offset": np.concatenate([pieces[:, 4], np.zeros(len(windows), np.int64)]),
                "seq_tokens": sizes[seq],
                "step_group": (int(key[0]) << 32) + step[seq],
            }
        )
        out.insert(0, "doc_id", pd.concat([parts["doc_id"].iloc[who], windows["doc_id"]]).to_numpy())
        return out

    parts = tokenised_parts(docs, tokenizer, end_id, top, id_col, text_col)
    spread = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "twin"), F.lit(groups))
    return parts.withColumn("_group", spread).groupBy("_group").applyInPandas(lay_out, PIECES)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
