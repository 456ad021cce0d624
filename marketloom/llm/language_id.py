"""Language identification with interpolated Kneser-Ney character models.

Learning: a bounded sample of labelled rows (``per_language`` per language, the
first by a hash of the id) is read; Spark counts its character n-grams within words,
with boundary marks. From these counts the model is built: the highest order uses
counts, each lower order the number of distinct left neighbours, and each order is
interpolated with the next lower one by an absolute discount, down to a uniform
distribution. Grams and contexts of all languages are kept by order in sorted arrays
of 64-bit hashes, with one row of probabilities, or of weights of the lower order,
per entry and a column per language.

Scoring: the cross-entropy of a text is the sum over its words' characters and end
marks divided by their number; the language with the lowest one is chosen. A word's
sums do not depend on its neighbours, so each distinct word is scored once per batch
and kept in a bounded store.

Rejection: a text's least cross-entropy takes each word under the language that fits it
best, so a text in two learned languages lies where a text in one does. On the held
fifth of the sample it is measured twice: with all models, as known text shows it, and without
the model of the row's own language, as an unknown language would. From both the limit
is calibrated (see ``calibrate``): a text of n characters is rejected if its least cross-entropy
is above level + z * spread / sqrt(n). Nothing in it is a fixed margin.

Defined results: a text that is null or has no letter (Unicode category L) is ``und``
with score 0 and is rejected; without any labelled rows every text is ``und``; with one
language nothing shows how unknown text looks, and the limit is the known rows' own; equal
texts, repeated rows included, get equal values; ties go to the language that sorts first; very long texts
are scored whole; an empty table gives no rows; columns other than the id, text and
language are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import normalize

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.llm import common

#: Marks before and behind a word.
_BEGIN, _END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, composed and in lower case."""
    if not text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower())
    words = _WORD.findall(normalize("NFC", text).lower())
    # Fractions, superscripts and numeral signs count as word characters there, but are no letters.
    return words if all(map(str.isalpha, words)) else [x for w in words for x in "".join(c if c.isalpha() else " " for c in w).split()]


def grams_of(word: str, order: int) -> list[str]:
    """The n-gram that ends at each character and at the end mark."""
    full = _BEGIN * (order - 1) + word + _END
    return [full[i : i + order] for i in range(len(word) + 1)]


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the grams of orders 1 to ``order`` that end at each place from order - 1 on."""
    out, h = [], np.zeros(len(codes), np.uint64)
    power = 1
    for k in range(order):
        # The character k places back is the k-th digit, so orders extend each other.
        h = h.copy()
        h[k:] += (codes[: len(codes) - k].astype(np.uint64) + np.uint64(1)) * np.uint64(power)
        power = power * 0x9E3779B97F4A7C15 % (1 << 64)
        out.append(h[order - 1 :])
    return out


@dataclass
class Model:
    """Sorted hash arrays by order, and what rejection needs."""

    languages: list[str]
    order: int
    floor: float
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    #: Limit of the least cross-entropy: level + z * spread / sqrt(characters).
    level: float = np.inf
    spread: float = 0.0
    z: float = 0.0

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Summed natural logs of each word's characters and end mark, a column per language."""
        n, width = self.order, len(self.languages)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        text = "".join(_BEGIN * (n - 1) + w + _END for w in words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        by_order = gram_hashes(codes, n)
        # Drop the places that end in a begin mark.
        real = codes[n - 1 :] != ord(_BEGIN)
        p = np.full((int(real.sum()), width), self.floor, np.float64)
        contexts = self._context_hashes(codes, n)
        for k in range(n):
            h, (keys, rows) = by_order[k][real], self.grams[k]
            weights_at, weights = self.contexts[k]
            c = contexts[k][real]
            p *= _rows(weights_at, weights, c, 1.0)
            p += _rows(keys, rows, h, 0.0)
        sums = np.add.reduceat(np.log(p), np.concatenate([[0], np.cumsum(lengths)[:-1]]), axis=0)
        return sums

    @staticmethod
    def _context_hashes(codes: np.ndarray, n: int) -> list[np.ndarray]:
        """Hashes of the 0 to n - 1 characters before each place from n - 1 on."""
        out = [np.zeros(len(codes) - n + 1, np.uint64)]
        for h in gram_hashes(codes, n - 1) if n > 1 else []:
            # Those that end one place earlier.
            out.append(h[: len(codes) - n + 1])
        return out


def _rows(keys: np.ndarray, rows: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    """Rows of a sorted hash array; its last row stands for keys that it has not."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    found = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
    return rows[np.where(found, at, len(rows) - 1)]


def _table(entries: dict[str, np.ndarray], width: int, missing: float) -> tuple[np.ndarray, np.ndarray]:
    texts = list(entries)
    keys = np.array([gram_hashes(np.frombuffer(t.encode("utf-32-le"), np.uint32), len(t))[-1][0] if t else 0 for t in texts], np.uint64)
    order = np.argsort(keys)
    rows = np.array([entries[texts[i]] for i in order], np.float32).reshape(len(texts), width)
    return keys[order], np.concatenate([rows, np.full((1, width), missing, np.float32)])


def build(counts: dict[str, Counter], order: int) -> Model:
    """The interpolated Kneser-Ney models of all languages from their highest-order counts."""
    languages = sorted(counts)
    width = len(languages)
    letters = {g[-1] for c in counts.values() for g in c}
    floor = 1.0 / (len(letters) + 1)
    grams: list[dict[str, np.ndarray]] = [{} for _ in range(order)]
    contexts: list[dict[str, np.ndarray]] = [{} for _ in range(order)]
    for column, language in enumerate(languages):
        level = counts[language]
        for k in range(order - 1, -1, -1):
            ones, twos = sum(c == 1 for c in level.values()), sum(c == 2 for c in level.values())
            discount = min(max(ones / (ones + 2 * twos) if ones + twos else 0.5, 0.1), 0.9)
            total: dict[str, float] = defaultdict(float)
            kinds: Counter = Counter()
            for gram, c in level.items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            for gram, c in level.items():
                grams[k].setdefault(gram, np.zeros(width, np.float32))[column] = (c - discount) / total[gram[:-1]] if c > discount else 0.0
            for context, c in kinds.items():
                contexts[k].setdefault(context, np.ones(width, np.float32))[column] = discount * c / total[context]
            level = Counter(gram[1:] for gram in level)
    return Model(
        languages, order, floor,
        [_table(g, width, 0.0) for g in grams],
        [_table(c, width, 1.0) for c in contexts],
    )


def calibrate(known: pd.DataFrame, foreign: pd.DataFrame) -> tuple[float, float, float]:
    """Level, spread and z of the limit, from least cross-entropies h of texts of n characters.

    Known texts scatter around their mean like a mean of n characters, each with the
    measured spread. z and the level are set where known text ends: the level is
    half-way from the highest known text, lifted by its length, to the 5 % quantile of
    foreign text where this lies above it, and the highest known text itself elsewhere.
    """
    mean = float(np.average(known["h"], weights=known["n"]))
    spread = float(np.sqrt((known["n"] * (known["h"] - mean) ** 2).mean()))
    # A normal quantile that one known text in a thousand exceeds.
    z = 3.1
    reach = known["h"] - z * spread / np.sqrt(known["n"])
    highest = max(float(reach.max()), mean)
    if len(foreign):
        low = float((foreign["h"] - z * spread / np.sqrt(foreign["n"])).quantile(0.05))
        highest = max(highest, (highest + low) / 2)
    return highest, spread, z


class Scorer:
    """Scores texts with a model; keeps the sums of words in a bounded store."""

    def __init__(self, model: Model, limit: int = 300_000) -> None:
        self.model, self.limit = model, limit
        self.places: dict[str, int] = {}
        self.sums = np.zeros((0, len(model.languages)), np.float32)

    def entropies(self, texts: list[str | None], without: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per language, the least one by words, and the number of characters and marks of each text.

        ``without`` names a language per text that the least one does not use.
        """
        lists = [words_of(t) for t in texts]
        seen = set().union(*lists)
        new = [w for w in seen if w not in self.places]
        if len(self.places) + len(new) > self.limit and self.places:
            self.places, self.sums, new = {}, self.sums[:0], list(seen)
        if new:
            got = [self.model.log_probabilities(new[i : i + 20_000]).astype(np.float32) for i in range(0, len(new), 20_000)]
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.sums = np.concatenate([self.sums, *got])
        sizes = np.array([sum(map(len, x)) + len(x) for x in lists], np.float64)
        out, least = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts))
        get = self.places.__getitem__
        for i, x in enumerate(lists):
            if x:
                rows = self.sums[np.fromiter(map(get, x), np.int64, len(x))]
                out[i] = -rows.sum(axis=0, dtype=np.float64) / sizes[i]
                if without is not None and without[i] >= 0:
                    rows = np.delete(rows, without[i], axis=1)
                if rows.shape[1]:
                    least[i] = -rows.max(axis=1).sum(dtype=np.float64) / sizes[i]
        return out, least, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and whether the text is rejected."""
        if not self.model.languages:
            n = len(texts)
            return ["und"] * n, np.zeros(n), np.zeros(n), np.ones(n, bool)
        entropy, least, sizes = self.entropies(texts)
        best = entropy.argmin(axis=1)
        low = entropy[np.arange(len(texts)), best]
        score = 1.0 / np.exp(-10.0 * (entropy - low[:, None])).sum(axis=1)
        some = sizes > 0
        limit = self.model.level + self.model.z * self.model.spread / np.sqrt(np.maximum(sizes, 1))
        names = [self.model.languages[b] if ok else "und" for b, ok in zip(best, some)]
        return names, np.where(some, score, 0.0), np.where(some, low, 0.0), ~some | (least > limit)


def scorer_of(model: Model) -> Scorer:
    """A scorer that the tasks of one Python worker share; a broadcast model is there once per worker."""
    scorer = common.worker_store(("scorer", id(model)), lambda: Scorer(model))
    return scorer if scorer.model is model else Scorer(model)


def train(
    labelled: DataFrame, order: int = 4, per_language: int = 700, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """Learn from at most ``per_language`` rows of each language; a fifth of them calibrate."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.withColumn("mark", F.xxhash64(F.col("doc_id").cast("string")))
    # A bound of the hash leaves about twice the rows wanted of each language, however many it has.
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_rows"))
    share = F.least(F.lit(1.0), F.lit(2.0 * per_language) / F.col("_rows"))
    # One row per language; broadcast, so that no row is shuffled by its language before the bound.
    few = rows.select("lang", "mark", "doc_id").join(F.broadcast(counts), "lang").where(F.col("mark") / F.lit(float(1 << 64)) + 0.5 <= share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id"))
    chosen = few.withColumn("rank", rank).where(F.col("rank") <= per_language).select("doc_id", "lang", (F.col("rank") % 5 == 0).alias("held"))
    # Bounded by per_language rows of three short columns for each language.
    sample = rows.select("doc_id", "text", "lang").join(F.broadcast(chosen.distinct()), ["doc_id", "lang"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch["lang"], batch["text"]):
                words = Counter(words_of(text))
                for word, n in words.items():
                    for gram in grams_of(word, order):
                        found[lang][gram] += n
            yield pd.DataFrame([(k, g, n) for k, c in found.items() for g, n in c.items()], columns=["lang", "gram", "n"])

    sample = common.materialise(sample, "language-sample")
    grams = sample.where("NOT held").mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, gram, n in zip(*grams.toPandas().to_dict("list").values()):
        counts[lang][gram] = n
    model = build(counts, order)
    shared = spark.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        numbers = {language: k for k, language in enumerate(shared.value.languages)}
        for batch in batches:
            texts, own = batch["text"].tolist(), [numbers.get(x, -1) for x in batch["lang"]]
            _, known, sizes = scorer.entropies(texts)
            _, foreign, _ = scorer.entropies(texts, own)
            yield pd.DataFrame({"known": known, "foreign": foreign, "n": sizes})[sizes > 0]

    if model.languages:
        # Two numbers for each row of the held fifth of the sample.
        held = sample.where("held").mapInPandas(measure, "known double, foreign double, n double").toPandas()
        if len(held):
            foreign = held[["foreign", "n"]].set_axis(["h", "n"], axis=1) if len(model.languages) > 1 else held[:0]
            model.level, model.spread, model.z = calibrate(held[["known", "n"]].set_axis(["h", "n"], axis=1), foreign)
    return model


PREDICTED = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, see ``PREDICTED``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("cross_entropy", pa.float64()), ("rejected", pa.bool_())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 500).columns)
                found = scorer.predict(texts)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((ids, *found), schema)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(predict, PREDICTED)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with all their columns; no row moves."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rejected = scorer.predict(part.column(place).to_pylist())[-1]
                yield part.filter(pa.array(~rejected))

    return docs.mapInArrow(keep, docs.schema)


def fold(id_col: str, n: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % n


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = train(docs.where(fold("doc_id", 3) != 1))
    out = identify(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
