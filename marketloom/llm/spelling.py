"""Spelling variants: one-edit neighbours over a reduced alphabet, verified on the words.

Two words are near when they differ by exactly one inserted, deleted or replaced code
point. Letters are hashed to a few symbols. Near words have reduced words that are
equal or one edit apart, so the neighbours of a word are found among the reduced words,
over so few symbols that a reduced word's full one-edit neighbourhood can be written out.

1. Words. Runs of letters are counted per task, then over all documents.
2. Reduced vocabulary: the distinct reduced words.
3. Neighbourhoods. For each reduced word all deletions, replacements and insertions are
   generated, as rolling hashes, and looked up in the reduced vocabulary. Written to a
   shuffle they would be some 150 rows a word. An edit in the second half of a word leaves the first half as it
   is, and an edit in the first half leaves the second, so reduced words are dealt by
   their halves instead: what can match is in one chunk of a task, and the neighbourhood
   lives there only. A word of c letters meets those of c letters (replacements) and of
   c + 1 (insertions, and their deletions) by the first c // 2 symbols and by the last
   c - c // 2. As there are few symbols, a half holds a bounded number of reduced words.
4. Pairs of reduced words that both exist, and each reduced word with itself, become pairs
   of words by two joins; the edit distance of the words decides. Hashes only choose
   candidates, so collisions lose nothing and add nothing.
5. The form of a word is its most frequent near word, if that is frequent enough; roots
   follow forms by pointer jumping. Counts grow along forms, so there are no cycles.

Defined results: null and empty text give no words; very long texts are read whole, a
document at a time; rows that repeat count again, as does each row of a repeated id; a null id counts as the
empty string before the colon; ties between forms go to the smallest word in code-point order; an empty table gives no
rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common

#: Symbols of the reduced alphabet, least letters and occurrences of a word, and how much more frequent a form is.
SYMBOLS, LETTERS, LEAST, TIMES = 8, 7, 2, 10
#: One word in so many loses a letter (a test of the grouping that the query's contract asks for).
SLIPS = 31
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: The symbol of each letter, from 1; all letters of the words are below U+0100.
_SYMBOL = np.array([zlib.crc32(bytes([c])) % SYMBOLS + 1 for c in range(256)], np.uint64)


def slipped(word: str, mark: int) -> str:
    """The word without one of its letters, where its hash is divisible by ``SLIPS``."""
    if mark % SLIPS:
        return word
    k = mark % len(word)
    return word[:k] + word[k + 1 :]


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, held: int = 200_000) -> DataFrame:
    """How often each word of at least ``letters`` letters occurs: word, n."""
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                start = zlib.crc32(f"{doc}:".encode())
                # Bytes are lower-cased in A-Z only.
                for run, n in Counter(pattern.findall(text.lower().decode("utf-8", "replace"))).items():
                    word = slipped(run, zlib.crc32(run.encode(), start))
                    if len(word) >= letters:
                        total[word] += n
                if len(total) >= held:
                    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
                    total.clear()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    rows = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _powers(upto: int) -> np.ndarray:
    return np.array([pow(int(_BASE), i, 1 << 64) for i in range(upto + 1)], np.uint64)


def _prefixes(symbols: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, ... symbols of rows of equal length."""
    out = np.zeros((symbols.shape[0], symbols.shape[1] + 1), np.uint64)
    for i in range(symbols.shape[1]):
        out[:, i + 1] = out[:, i] * _BASE + symbols[:, i]
    return out


def _suffixes(symbols: np.ndarray) -> np.ndarray:
    """Hashes of the symbols from each place on."""
    n = symbols.shape[1]
    out, power = np.zeros((symbols.shape[0], n + 1), np.uint64), _powers(n)
    for i in range(n - 1, -1, -1):
        out[:, i] = symbols[:, i] * power[n - 1 - i] + out[:, i + 1]
    return out


def neighbourhood(symbols: np.ndarray, first: int, last: int, kinds: str = "drx") -> np.ndarray:
    """Hashes of all rows' words after one edit at the places ``first`` to before ``last``.

    ``kinds``: d deletes the symbol at a place, r replaces it, x inserts one before it.
    """
    n = symbols.shape[1]
    pre, suf, power = _prefixes(symbols), _suffixes(symbols), _powers(n + 1)
    every = np.arange(1, SYMBOLS + 1, dtype=np.uint64)
    out = []
    for i in range(first, last):
        if "d" in kinds and i < n:
            out.append((pre[:, i] * power[n - 1 - i] + suf[:, i + 1])[:, None])
        if "r" in kinds and i < n:
            kept = pre[:, i] * power[n - i] + suf[:, i + 1]
            # A replacement by itself is the word, which is no neighbour; its hash is left in and finds the word alone.
            out.append(kept[:, None] + every * power[n - 1 - i])
        if "x" in kinds:
            kept = pre[:, i] * power[n + 1 - i] + suf[:, i]
            out.append(kept[:, None] + every * power[n - i])
    return np.concatenate(out, axis=1) if out else np.zeros((len(symbols), 0), np.uint64)


def reduced(vocabulary: DataFrame) -> DataFrame:
    """The words with their reduced words: word, n, symbols (bytes from 1), reduced (their hash)."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("symbols", pa.binary()), ("reduced", pa.int64())])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            symbols = [_SYMBOL[np.frombuffer(c, np.uint8)].astype(np.uint8).tobytes() for c in codes]
            sizes = np.array([len(c) for c in codes])
            hashes = np.zeros(len(codes), np.uint64)
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                rows = np.frombuffer(b"".join(symbols[i] for i in at), np.uint8).reshape(len(at), n)
                hashes[at] = _prefixes(rows.astype(np.uint64))[:, -1]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(symbols, pa.binary()), pa.array(hashes.view(np.int64))], schema=schema)

    return vocabulary.select("word", "n").mapInArrow(reduce, "word string, n long, symbols binary, reduced long")


def dealt(codes: DataFrame) -> DataFrame:
    """Reduced words with the halves by which they meet others: half (class, side and symbols), c, side, symbols, reduced."""
    n = F.octet_length("symbols")
    # As the shorter word of a pair, and as the longer one.
    classes = F.explode(F.array(n, n - 1)).alias("c")
    rows = codes.select("symbols", "reduced", classes).where("c > 0").withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    kept = F.floor(F.col("c") / 2).cast("int")
    part = F.when(F.col("side") == 0, F.substring("symbols", F.lit(1), kept)).otherwise(F.expr("substring(symbols, length(symbols) - (c - c div 2) + 1)"))
    return rows.withColumn("half", F.xxhash64("c", "side", part))


def reduced_pairs(codes: DataFrame, held: int = 50_000) -> DataFrame:
    """Reduced words that are one edit apart, each pair from both ends: a, b (hashes)."""

    def match(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(rows)
        known = np.unique(whole.column("reduced").to_numpy().view(np.uint64))
        symbols = np.array(whole.column("symbols").to_pylist(), object)
        own = whole.column("reduced").to_numpy().view(np.uint64)
        c, side = whole.column("c").to_numpy(), whole.column("side").to_numpy()
        sizes = np.fromiter(map(len, symbols), np.int64, len(symbols))
        found_a, found_b = [], []
        for n, k, s in np.unique(np.stack([sizes, c, side]), axis=1).T.tolist():
            at = np.flatnonzero((sizes == n) & (c == k) & (side == s))
            # Side 0 keeps the first k // 2 symbols, so edits are behind them; side 1 has the edits before.
            first, last = (k // 2, n + 1) if s == 0 else (0, k // 2)
            for i in range(0, len(at), 4000):
                part = at[i : i + 4000]
                table = np.frombuffer(b"".join(symbols[part].tolist()), np.uint8).reshape(len(part), n).astype(np.uint64)
                near = neighbourhood(table, first, last, "rx" if n == k else "d")
                place = np.minimum(np.searchsorted(known, near), len(known) - 1)
                row, _ = hit = np.nonzero(known[place] == near)
                a, b = own[part][row], near[hit]
                found_a.append(a[a != b])
                found_b.append(b[a != b])
        pairs = np.unique(np.stack([np.concatenate(found_a), np.concatenate(found_b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64))], ["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by half; chunks end where a half ends."""
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if size >= held:
                half, last = batch.column("half").to_numpy(), kept[-1].column("half")[-1].as_py()
                more = int(np.searchsorted(half != last, True))
                if more < batch.num_rows:
                    yield match([*kept, batch.slice(0, more)])
                    kept, size, batch = [], 0, batch.slice(more)
            kept.append(batch)
            size += batch.num_rows
        if kept:
            yield match(kept)

    # Many partitions, as each row grows to a neighbourhood.
    rows = dealt(codes.select("symbols", "reduced").distinct()).repartition("half").sortWithinPartitions("half")
    return rows.mapInArrow(join, "a long, b long").distinct()


def near_words(codes: DataFrame) -> DataFrame:
    """Near words of each word of a stored vocabulary with reduced words: word, n, near, near_n."""
    pairs = reduced_pairs(codes)
    own = codes.groupBy("reduced").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("reduced").alias("a"), F.col("reduced").alias("b"))
    left = codes.select(F.col("reduced").alias("a"), "word", "n")
    right = codes.select(F.col("reduced").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = pairs.union(own).join(left, "a").join(right, "b")
    return both.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def forms(codes: DataFrame, times: int = TIMES) -> DataFrame:
    """The words of a stored vocabulary with reduced words, with their form and what is near: word, n, n_near, form, form_n."""
    # The largest count first, then the smallest word.
    best = near_words(codes).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_n"), F.col("near"))).alias("_f"))
    near_n = -F.col("_f._n")
    best = best.withColumn("_fits", near_n >= times * F.col("n"))
    chosen = best.select("word", "n_near", F.when(F.col("_fits"), F.col("_f.near")).alias("form"), F.when(F.col("_fits"), near_n).alias("form_n"))
    return codes.join(chosen, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """The last word that forms lead to from each word that has one (word, form): word, root."""
    now = common.materialise(links.select("word", F.col("form").alias("root"), F.lit(True).alias("_moved")), "spelling-roots")
    while not now.where("_moved").isEmpty():
        # Each round looks up the end so far, so what is left of a chain is halved; counts grow along it, so there are few rounds.
        up = now.select(F.col("word").alias("root"), F.col("root").alias("_up"))
        further = now.join(up, "root", "left").select("word", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("_moved"))
        new = common.materialise(further, "spelling-roots")
        common.discard(now)
        now = new
    return now.select("word", "root")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per word of at least ``least`` occurrences: word, form, root, n, n_near, form_n."""
    codes = common.materialise(reduced(words(docs, id_col, text_col).where(F.col("n") >= least)), "spelling-codes")
    found = common.materialise(forms(codes, times), "spelling-forms")
    common.discard(codes)
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(common.table(spark, sf_dir, "documents"))


#: The checksum from a table made by its rule; near words by words with one letter left out or masked.
OP11_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(text, '{common.UPPER}', '{common.LOWER}') AS text FROM documents),
runs AS (SELECT id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]+')) AS run FROM docs),
each AS (SELECT id || ':' || run AS name, run, count(*) AS n FROM runs WHERE len(run) >= {LETTERS} GROUP BY ALL),
steps AS (SELECT list_transform(range(256), lambda k: list_reduce(list_prepend(k, range(8)), lambda c, s: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
coded AS (SELECT run, n, hex(name) AS h, strlen(name) AS size FROM each),
bytes AS (
  SELECT run, n, list_transform(range(1, size + 1), lambda i: instr('123456789ABCDEF', substr(h, 2 * i - 1, 1)) * 16 + instr('123456789ABCDEF', substr(h, 2 * i, 1))) AS b FROM coded),
marked AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS h FROM bytes, steps),
slipped AS (SELECT CASE WHEN h % {SLIPS} = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, n FROM marked),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE len(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {LEAST}),
places AS (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM words),
cuts AS (SELECT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM places),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (i, head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.head || a.tail = b.word),
ranked AS (
  SELECT x.word, x.other, o.n AS other_n, count(*) OVER (PARTITION BY x.word) AS n_near, row_number() OVER (PARTITION BY x.word ORDER BY o.n DESC, x.other) AS r
  FROM near x JOIN words o ON o.word = x.other),
formed AS (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {TIMES} * w.n THEN other END AS form, CASE WHEN other_n >= {TIMES} * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE r = 1) f USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS depth FROM formed
  UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word) e USING (word)"""
