"""Quality scores from a factorisation machine.

Inputs of a document: its distinct words, hashed into ``buckets`` and weighted
1 / sqrt(number of distinct words); structure statistics (shares of character
classes, word and line lengths, repeated words and lines), each as the bin it falls
into; and metadata of the text, its length in characters and bytes, binned as well.
Bin edges are quantiles of the sample. The model is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),

so all pairwise interactions are scored in time linear in the number of inputs.

Learning uses a bounded sample, ``sample`` labelled documents, the first by a hash
of the id; only their hashed inputs reach the driver. Scoring covers all texts.
Labels, language, source and id are no inputs.

Defined results: null text counts as empty and gets the score of its statistics; very long texts are
read whole; without labels every score is 0.5; with several labels of one id the smallest counts;
equal texts get equal scores, so rows that repeat and ties do too; an empty table gives no rows; other columns are
not read, whatever their names. The bound on the sample counts ids: where rows share an id, all of them
are in the sample with it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common

#: Byte classes: upper, lower, digit, blank, line end, sentence marks, other ASCII signs, beyond ASCII.
_CLASSES = np.full(256, 6)
_CLASSES[128:] = 7
for _k, _chars in enumerate((common.UPPER, common.LOWER, "0123456789", " \t", "\r\n", ".,;:'\"()-")):
    _CLASSES[[ord(c) for c in _chars]] = _k
_CLASS_OF = np.eye(8)[_CLASSES]
N_STATS = 18


def statistics(text: str, data: bytes, words: list[str], distinct: int) -> list[float]:
    """Structure statistics, then metadata of the text."""
    n = max(len(data), 1)
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS_OF / n
    lines = text.split("\n")
    return [
        *shares.tolist(),
        len(words) and sum(map(len, words)) / len(words),
        len(words) and max(map(len, words)),
        distinct / max(len(words), 1),
        len(words) / len(lines),
        len(set(lines)) / len(lines),
        sum(w[0].isupper() for w in words) / max(len(words), 1),
        sum(not w[-1].isalnum() for w in words) / max(len(words), 1),
        np.log1p(len(words)),
        np.log1p(len(text)),
        np.log1p(len(data)),
    ]


class Inputs:
    """Hashed words and statistics of texts; keeps buckets of words in a bounded store."""

    def __init__(self, buckets: int, limit: int = 400_000) -> None:
        self.buckets, self.limit = buckets, limit
        self.known: dict[str, int] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, list[float]]:
        text = text or ""
        words = text.split()
        distinct = set(words)
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in [w for w in distinct if w not in known]:
            known[w] = zlib.crc32(w.encode("utf-8", "replace")) % self.buckets
        # Sorted, so that sums do not depend on the order of a set.
        hashed = np.sort(np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct)))
        return hashed, statistics(text, text.encode("utf-8", "replace"), words, len(distinct))


@dataclass
class Machine:
    """A factorisation machine over word buckets and binned statistics."""

    buckets: int
    edges: np.ndarray  # statistic, inner edges of its bins
    bias: float
    w: np.ndarray
    v: np.ndarray

    def inputs(self, hashed: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins = (stats[:, None] > self.edges).sum(axis=1)
        at = self.buckets + np.arange(len(stats)) * (self.edges.shape[1] + 1) + bins
        weight = np.full(len(hashed), 1.0 / np.sqrt(max(len(hashed), 1)))
        return np.concatenate([hashed, at]), np.concatenate([weight, np.ones(len(at))])

    def score(self, index: np.ndarray, x: np.ndarray) -> float:
        vx = self.v[index] * x[:, None]
        z = self.bias + self.w[index] @ x + 0.5 * ((vx.sum(axis=0) ** 2).sum() - (vx**2).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, rank: int = 6, bins: int = 12, epochs: int = 12, rate: float = 0.08, decay: float = 2e-4, seed: int = 7) -> Machine:
    """Fit by stochastic gradients with per-weight step sizes; rows: words, statistics, label."""
    rng = np.random.default_rng(seed)
    stats = np.array([r[1] for r in rows]) if rows else np.zeros((1, N_STATS))
    edges = np.quantile(stats, np.arange(1, bins) / bins, axis=0).T
    size = buckets + N_STATS * bins
    machine = Machine(buckets, edges, 0.0, np.zeros(size), rng.normal(0, 0.02, (size, rank)))
    if not rows:
        machine.v[:] = 0
        return machine
    data = [(*machine.inputs(h, np.array(s)), y) for h, s, y in rows]
    share = np.clip(np.mean([y for _, _, y in data]), 0.01, 0.99)
    machine.bias = float(np.log(share / (1 - share)))
    # The rarer label counts more, by the root of how much rarer it is.
    weight = np.maximum(1.0, np.sqrt(np.array([share / (1 - share), (1 - share) / share])))
    sum_w, sum_v = np.full(size, 1e-2), np.full((size, rank), 1e-2)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), 32):
            part = [data[i] for i in order[at : at + 32]]
            index = np.concatenate([p[0] for p in part])
            x = np.concatenate([p[1] for p in part])
            y = np.array([p[2] for p in part], float)
            cuts = np.concatenate([[0], np.cumsum([len(p[0]) for p in part])[:-1]])
            doc = np.repeat(np.arange(len(part)), [len(p[0]) for p in part])
            vx = machine.v[index] * x[:, None]
            sums = np.add.reduceat(vx, cuts)
            z = machine.bias + np.add.reduceat(machine.w[index] * x, cuts) + 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), cuts))
            slope = (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y) * weight[y.astype(int)] / len(part)
            own, place = np.unique(index, return_inverse=True)
            gw = np.bincount(place, slope[doc] * x, len(own)) + decay * machine.w[own]
            step = slope[doc][:, None] * (x[:, None] * sums[doc] - machine.v[index] * (x**2)[:, None])
            gv = np.stack([np.bincount(place, step[:, f], len(own)) for f in range(rank)], axis=1) + decay * machine.v[own]
            sum_w[own] += gw**2
            sum_v[own] += gv**2
            machine.w[own] -= rate * gw / np.sqrt(sum_w[own])
            machine.v[own] -= rate * 0.5 * gv / np.sqrt(sum_v[own])
            machine.bias -= rate * 0.1 * slope.sum()
    return machine


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, buckets: int = 1 << 15, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Machine:
    """Fit on at most ``sample`` labelled documents; their hashed inputs are all the driver sees."""
    marked = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).cast("int").alias("label"))
    chosen = F.broadcast(marked.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(sample))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        inputs = Inputs(buckets)
        for batch in batches:
            got = [inputs.of(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "words": [g[0] for g in got], "stats": [g[1] for g in got]})

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id")
    rows = texts.mapInPandas(encode, "doc_id long, label int, words array<long>, stats array<double>").orderBy("doc_id", F.col("words").cast("string")).collect()
    return fit([(np.array(r["words"], np.int64), np.array(r["stats"]), r["label"]) for r in rows], buckets)


def score(docs: DataFrame, machine: Machine, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        inputs = Inputs(model.buckets)
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            scores = []
            for text in texts:
                hashed, stats = inputs.of(text)
                scores.append(model.score(*model.inputs(hashed, np.array(stats))))
            predicted = [int(s >= threshold) for s in scores]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, scores, predicted), schema)], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(rate, "doc_id long, score double, predicted int")


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    labels = common.table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
