"""Hard negatives from rotated one-bit codes with deterministic intervals.

Vectors are made of integers, and the score of a row for an anchor is their inner product.
For each anchor its best rows of the same label are its positives, and for each positive the
best rows of other labels whose score is within two shares of the positive's are its hard negatives.

How it works.

1. Codes. A vector o is turned by a random rotation, the same for all. Its code c is the signs of the
   rotated components, over the root of their number, so |c| = 1. Stored with it are the
   alignment a = <o, c> and the length r of what is left, o - a c, with r^2 = |o|^2 - a^2.
2. Estimates. The rotated anchor q is rounded to ``BITS`` bits a component, as planes of bits, so
   its product with a code is a sum of population counts; by Cauchy-Schwarz what rounding
   changes is at most the length e of the rounding error, so <q, c> is known up to e.
3. Intervals. As o - a c is at a right angle to c, <q, o> = a <q, c> + <q - <q, c> c, o - a c>, and
   by Cauchy-Schwarz the last term is at most r sqrt(|q|^2 - <q, c>^2). With e and a margin for rounding in
   floating point this gives bounds that no true score leaves.
4. Candidates. The k-th largest lower bound is a score that k rows reach, so rows whose upper
   bound is below it are out. The others are scored with integers, those with
   high estimates first, and each batch of true scores raises the bound. Nothing is
   decided by an estimate, so results are exact.

Rows are dealt to slices of bounded size and never copied; anchors, one row in a hundred, go to every slice
and stream past its codes. Each slice returns k rows an anchor, and a window keeps the best. So work grows with
anchors times rows, as the query asks for, and what is moved with anchors times slices.

Defined results: rows with a null id, label or vector, or with any component that is null or not
finite, take no part; an empty vector scores 0 with all; shorter vectors count as if zeros followed; each row counts, so one of two rows
that share an id can be the other's positive, and equal rows give equal result rows; ties go to the smaller
id; anchors without positives, and positives without negatives, give no rows; scores must fit into 64
bits, else an error says so; an empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm import common

#: Components become floor(SCALE * x); one id in EVERY is an anchor.
SCALE, EVERY = 256, 100
#: Positives of an anchor, negatives of a positive, and the percent of a positive's score between which theirs are.
POSITIVES, NEGATIVES, LEAST, MOST = 5, 10, 30, 90
#: Bits of a component of a rotated anchor, and rows of a slice: a 64th of all rows within these bounds.
BITS, SMALL, LARGE = 8, 4096, 65_536
#: Rows that are scored with integers at a time.
BATCH = 512


def rotation(size: int, seed: int = 20240229) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None) -> DataFrame:
    """Rows that take part, with integer components: vec_id, label, v. ``label`` replaces the label column's value."""
    x = F.col(vector_col)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    fit = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).where(~odd)
    v = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))
    return fit.select(F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"), v.alias("v"))


def coded(rows: DataFrame, size: int) -> DataFrame:
    """Vectors of up to ``size`` components with their codes: row, vec_id, label, v, code, align, rest."""
    words = -(-size // 64)
    kinds = "row long, vec_id long, label long, v array<long>, code array<long>, align double, rest double"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(size) if size else np.zeros((0, 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            table = padded(batch.column("v"), size)
            turned = table.astype(np.float64) @ turn
            code, align = one_bit(turned)
            rest = np.sqrt(np.maximum((turned**2).sum(axis=1) - align**2, 0))
            codes = pa.FixedSizeListArray.from_arrays(pa.array(code.view(np.int64).ravel()), words).cast(pa.list_(pa.int64())) if words else pa.array([[]] * batch.num_rows, pa.list_(pa.int64()))
            columns = [batch.column(c) for c in ("row", "vec_id", "label", "v")]
            yield pa.RecordBatch.from_arrays([*columns, codes, pa.array(align), pa.array(rest)], ["row", "vec_id", "label", "v", "code", "align", "rest"])

    return rows.mapInArrow(encode, kinds)


def padded(column: pa.Array, size: int) -> np.ndarray:
    """Lists of integers as a table with zeros behind short ones."""
    offsets, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy(zero_copy_only=False)
    counts = np.diff(offsets)
    out = np.zeros((len(counts), size), np.int64)
    if size:
        row = np.repeat(np.arange(len(counts)), counts)
        out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], counts)] = flat[offsets[0] : offsets[-1]]
    if out.size and float(np.abs(out).max()) ** 2 * size >= 2.0**62:
        raise ValueError("scores of these vectors do not fit into 64 bits")
    return out


def one_bit(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs as bits in 64-bit words, and each vector's product with its code."""
    n, size = turned.shape
    bits = np.zeros((n, -(-size // 64) * 64), np.uint8)
    bits[:, :size] = turned >= 0
    align = np.abs(turned).sum(axis=1) / np.sqrt(max(size, 1))
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64), align


class Slice:
    """Rows of one slice, against which anchors are held."""

    def __init__(self, batches: list[pa.RecordBatch], size: int) -> None:
        whole = pa.Table.from_batches(batches).combine_chunks()
        column = lambda c: whole.column(c).to_numpy()
        self.size, self.row, self.ids, self.labels = size, column("row"), column("vec_id"), column("label")
        self.v = padded(whole.column("v").chunk(0), size)
        self.code = padded_words(whole.column("code").chunk(0), -(-size // 64))
        self.align, self.rest = column("align"), column("rest")
        self.ones = np.bitwise_count(self.code).sum(axis=1).astype(np.int64)
        self.turn = rotation(size) if size else np.zeros((0, 0))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Estimates of the scores of all rows for an anchor, and what no score is below or above."""
        turned = q.astype(np.float64) @ self.turn
        length = float(np.sqrt((turned**2).sum()))
        if not length:
            zeros = np.zeros(len(self.row))
            return zeros, zeros, zeros
        low, high = float(turned.min()), float(turned.max())
        step = (high - low) / ((1 << BITS) - 1) or 1.0
        level = np.rint((turned - low) / step).astype(np.int64)
        error = float(np.sqrt(((low + step * level - turned) ** 2).sum()))
        # The product with the signs s is 2 * (sum over set bits) - sum; set bits of each plane are counted.
        planes = np.zeros((BITS, self.code.shape[1] * 64), np.uint8)
        planes[:, : self.size] = level >> np.arange(BITS)[:, None] & 1
        packed = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
        found = np.zeros(len(self.row), np.int64)
        for k in range(BITS):
            found += np.bitwise_count(self.code & packed[k]).sum(axis=1).astype(np.int64) << k
        along = (2 * (low * self.ones + step * found) - (low * self.size + step * level.sum())) / np.sqrt(self.size)
        across = np.sqrt(np.maximum(length**2 - np.maximum(np.abs(along) - error, 0) ** 2, 0))
        reach = self.align * error + self.rest * across
        reach += 1e-9 * length * (self.align + self.rest) + 1e-6
        middle = self.align * along
        return middle, middle - reach, middle + reach

    def best(self, q: np.ndarray, able: np.ndarray, bounds: tuple[np.ndarray, ...], keep: int, window: tuple[int, int, int] | None = None) -> list[tuple[int, int]]:
        """The best ``keep`` rows of ``able`` by score and id, as (score, number).

        ``window`` is a score, and the percent of it between which scores must be.
        """
        middle, lower, upper = bounds
        sure = able
        if window is not None:
            score, least, most = window
            able = able & (100 * upper >= least * score - 1) & (100 * lower <= most * score + 1)
            sure = able & (100 * lower >= least * score + 1) & (100 * upper <= most * score - 1)
        at = np.flatnonzero(able)
        known = lower[sure]
        limit = np.partition(known, len(known) - keep)[len(known) - keep] if len(known) >= keep else -np.inf
        at = at[upper[at] >= limit]
        at = at[np.argsort(-middle[at], kind="stable")]
        scores, numbers = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(at):
            now, at = at[:BATCH], at[BATCH:]
            true = self.v[now] @ q
            if window is not None:
                fits = (100 * true >= least * score) & (100 * true <= most * score)
                true, now = true[fits], now[fits]
            scores, numbers = np.concatenate([scores, true]), np.concatenate([numbers, now])
            order = np.lexsort((self.ids[numbers], -scores))[:keep]
            scores, numbers = scores[order], numbers[order]
            if len(scores) == keep:
                at = at[upper[at] >= scores[-1] - 0.5]
        return list(zip(scores.tolist(), numbers.tolist()))


def padded_words(column: pa.Array, words: int) -> np.ndarray:
    """Lists of ``words`` numbers as a table; ``flatten`` leaves out what lies around a slice."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), words).view(np.uint64)


def _sliced(codes: DataFrame, anchors: DataFrame, slices: int) -> DataFrame:
    """Rows in their slice, and behind them in each slice all anchors."""
    place = F.pmod(F.xxhash64("row"), F.lit(slices))
    rows = codes.select(place.alias("slice"), F.lit(0).alias("kind"), "row", "vec_id", "label", "v", "code", "align", "rest", F.array().cast("array<long>").alias("scores"))
    every = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"), F.lit(1).alias("kind"), "row", "vec_id", "label", "v",
        F.array().cast("array<long>").alias("code"), F.lit(0.0).alias("align"), F.lit(0.0).alias("rest"), "scores",
    )
    return rows.unionByName(every).repartition("slice").sortWithinPartitions("slice", "kind", "row")


def scanned(codes: DataFrame, anchors: DataFrame, slices: int, size: int, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """The best rows of each slice for each anchor: anchor (its row), place, row, vec_id, score.

    ``anchors`` has a column ``scores``: where it is null, rows of the same label are looked for; else, for each score in
    it, rows of other labels within two shares of it. ``place`` is the number of the score, from 0.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "place", "row", "vec_id", "score")])

    def held(now: Slice, part: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        queries = padded(part.column("v"), size)
        for q, row, label, scores in zip(queries, part.column("row").to_pylist(), part.column("label").to_pylist(), part.column("scores").to_pylist()):
            bounds, same = now.bounds(q), now.labels == label
            if scores is None:
                found = [(0, x) for x in now.best(q, same & (now.row != row), bounds, positives)]
            else:
                found = [(k, x) for k, s in enumerate(scores) if s >= 0 for x in now.best(q, ~same, bounds, negatives, (s, least, most))]
            out += [(row, k, int(now.row[i]), int(now.ids[i]), score) for k, (score, i) in found]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)], schema=schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kept, now = None, [], None
        for batch in batches:
            at = 0
            slice_, kind = batch.column("slice").to_numpy(), batch.column("kind").to_numpy()
            for end in [*(np.flatnonzero((np.diff(slice_) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]:
                part = batch.slice(at, end - at)
                if end > at:
                    if kind[at] == 0:
                        if number != slice_[at]:
                            number, kept, now = slice_[at], [], None
                        kept.append(part)
                    elif number == slice_[at]:  # else the slice has no rows
                        now = now or Slice(kept, size)
                        yield held(now, part)
                at = end

    return _sliced(codes, anchors, slices).mapInArrow(scan, "anchor long, place long, row long, vec_id long, score long")


def _first(rows: DataFrame, keys: list[str], keep: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= keep)


def hard_negatives(
    rows: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """Hard negatives of all anchors among ``rows`` (vec_id, label, v): anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``.
    """
    # Stored at once, so that the numbers of the rows stay as they are.
    numbered = common.materialise(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v"), "negative-rows")
    count, size = numbered.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    size = size or 0
    codes = common.materialise(coded(numbered, size), "negative-codes")
    common.discard(numbered)
    slices = max(1, -(-count // min(LARGE, max(SMALL, count // 64))))
    anchors = codes.where(F.col("vec_id") % every == 0).select("row", "vec_id", "label", "v")
    near = scanned(codes, anchors.withColumn("scores", F.lit(None).cast("array<long>")), slices, size, positives=positives)
    chosen = common.materialise(_first(near, ["anchor"], positives).select("anchor", (F.col("rank") - 1).cast("long").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negative-positives")
    scores = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("_s"))  # a few an anchor
    scored = anchors.join(scores.select(F.col("anchor").alias("row"), F.col("_s.positive_score").alias("scores")), "row")
    far = scanned(codes, scored, slices, size, negatives=negatives, least=least, most=most)
    best = _first(far, ["anchor", "place"], negatives).select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(chosen, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors(rows, label=label))


OP13_SQL = f"""
WITH fit AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM fit a JOIN fit r ON a.vec_id <> r.vec_id WHERE a.vec_id % {EVERY} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives JOIN pairs n USING (anchor_id)
WHERE NOT n.same AND {LEAST} * positive_score <= 100 * n.score AND 100 * n.score <= {MOST} * positive_score
QUALIFY rank <= {NEGATIVES}"""
