"""Removal of repeated phrases with sharded Aho-Corasick automata.

A window is ``WINDOW`` consecutive words of one document. A word goes when a window that
covers it has its word sequence also start in a document with a smaller id. Windows are
judged on the input.

How it works.

1. Anchors. In each window the sequence of ``GRAM`` words with the smallest hash is its
   anchor, so equal windows have equal anchors at equal offsets, and an anchor stands for
   the windows that chose it. Anchors that one document id alone has are dropped: nothing
   that recurs has one of them.
2. Segments: the words of all windows of one anchor. Segments of one anchor that are alike
   are one kind, with the smallest and largest document id of all its places, so a passage that a
   third of all documents share is streamed once.
3. Recurring passages are confirmed: the windows of all kinds are grouped by a 96-bit digest; those
   with several document ids recur, each with the smallest of them. Windows that follow each other in the only kind that
   has them, with one smallest id, are one passage, and so one pattern; the others are patterns of their own.
4. Automata. Kinds and patterns are dealt to shards by their anchor, so all windows of a segment are
   in the shard of its anchor. A task compiles a shard's patterns, as sequences of word
   numbers, into one automaton and streams all segments of the shard through it, which
   locates every occurrence. The number of shards follows the number of kinds; an anchor
   with more kinds than a shard may hold is dealt to several by the digests of the
   windows, and a segment goes to those that its windows are in. So a task holds the words, and the automaton, of one
   shard of bounded size.
5. Occurrences in documents behind the first become runs of words, and a join with the
   documents cuts them.

The automaton compares words themselves; digests only choose what is compiled. Documents
without a shared anchor need no streaming, as no pattern can be in them. Tables between the steps are in the
shared folder; as each cuts the lineage, the shuffle files behind it go once it is written.

Defined results: null and empty texts have no words and give zeros and the digest of the empty string;
documents with fewer words than a window stay whole; words are compared byte by byte, with no
change of case; very long texts are read whole, as arrays of offsets; of equal texts all but that of
the smallest id go; rows with equal ids are told apart by a 64-bit hash of their text and its
length and remove nothing from each other; a row without an id stands behind all others, and
those rows remove nothing from each other; an empty table gives no rows; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common

#: Words of a window and of an anchor.
WINDOW, GRAM = 13, 6
#: Segments that a shard should hold.
SHARD = 1_000
#: Bits of an anchor's key and of a segment's hash that are kept: short numbers make short rows, and both together name a kind.
_SHORT = np.uint64((1 << 48) - 1)
#: Stands for a null id: behind all others.
_NO_ID = (1 << 63) - 1
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    blank = np.concatenate([[True], _BLANK[np.frombuffer(data, np.uint8)], [True]])
    change = np.flatnonzero(blank[1:] != blank[:-1])
    return change[::2], change[1::2]


def word_hashes(data: bytes, part: int = 1 << 22) -> np.ndarray:
    """A 64-bit hash of each word; very long texts are split in parts that end at a blank."""
    out, at = [], 0
    while at < len(data):
        end = at + part
        if end < len(data):
            # The next blank of any kind; words themselves are not cut.
            ahead = _BLANK[np.frombuffer(data, np.uint8, offset=end)]
            end += int(ahead.argmax()) if ahead.any() else len(ahead)
        words = data[at:end].split()
        out.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def anchors(hashes: np.ndarray, ends: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchors of documents laid end to end: place, first and last window that chose it, key.

    ``ends`` are the numbers of words up to the end of each document.
    """
    n, width = len(hashes) - window + 1, window - gram + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    key = np.full(len(hashes) - gram + 1, gram, np.uint64)
    for k in range(gram):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(key)])
    chosen = np.arange(n)
    least = key[:n].copy()
    for k in range(1, width):
        other = key[k : k + n]
        better = other <= least
        chosen[better] = np.arange(k, k + n)[better]
        np.minimum(least, other, out=least)
    # Windows that reach into the next document are none.
    for end in ends[:-1].tolist():
        chosen[max(0, end - window + 1) : end] = -1
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.append(first[1:], n) - 1
    real = chosen[first] >= 0
    first, last = first[real], last[real]
    return chosen[first], first, last, key[chosen[first]]


def _stored(frame: DataFrame, label: str) -> DataFrame:
    """``common.materialise``, and the shuffle files that only led to the table go when it is written."""
    conf, key = frame.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return common.materialise(frame, label)
    finally:
        conf.set(key, before)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents as (given, doc_id, row, data); ``row`` tells rows with equal ids apart, and is 0 where no id comes twice."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc_id")
    twice = docs.select(key).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data")
    rows = docs.select(F.col(id_col).cast("long").alias("given"), key, data)
    row = F.lit(0).cast("long") if twice.isEmpty() else F.xxhash64("data", F.octet_length("data"))
    return rows.select("given", "doc_id", row.alias("row"), "data")


def segments(rows: DataFrame, window: int, gram: int, held: int = 200_000) -> DataFrame:
    """One row per anchor of a document: anchor, extent, doc_id, row, place.

    ``extent`` is a hash of the segment's words; ``place`` packs the place of the anchor with
    its first and last offset in the windows.
    """
    if not 0 < window - gram < 16:
        raise ValueError("a window may be up to 15 words longer than an anchor")
    schema = pa.schema([(c, pa.int64()) for c in ("anchor", "extent", "doc_id", "row", "place")])

    def emit(texts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        hashes = np.concatenate([t[2] for t in texts])
        sizes = np.array([len(t[2]) for t in texts])
        ends = np.cumsum(sizes)
        at, first, last, key = anchors(hashes, ends, window, gram)
        doc = np.searchsorted(ends, at, side="right")
        view, digest = memoryview(hashes.tobytes()), xxhash.xxh3_64_intdigest
        extent = np.fromiter((digest(view[8 * a : 8 * b]) for a, b in zip(first.tolist(), (last + window).tolist())), np.uint64, len(at))
        place = (at - (ends - sizes)[doc]) << 8 | (at - first) << 4 | (at - last)
        key, extent = key & _SHORT, extent & _SHORT
        ids, numbers = (np.array([t[k] for t in texts], np.int64)[doc] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (key.view(np.int64), extent.view(np.int64), ids, numbers, place)], schema=schema)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size = [], 0
        for batch in batches:
            for doc_id, row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                hashes = word_hashes(data.as_py())
                if len(hashes) < window:
                    continue
                texts.append((doc_id, row, hashes))
                size += len(hashes)
                if size >= held:
                    yield emit(texts)
                    texts, size = [], 0
        if texts:
            yield emit(texts)

    return rows.select("doc_id", "row", "data").mapInArrow(sample, "anchor long, extent long, doc_id long, row long, place long")


def shared_segments(found: DataFrame) -> DataFrame:
    """Segments whose anchor several document ids have, stored."""
    recurring = found.groupBy("anchor").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).where("_a < _b").select("anchor")
    # Stored, so that the join has a shuffle of its own, which can be split where an anchor is common.
    recurring = _stored(recurring, "phrase-anchors")
    out = _stored(found.join(recurring, "anchor"), "phrase-shared")
    common.discard(recurring)
    return out


def segment_kinds(shared: DataFrame) -> DataFrame:
    """Segments with equal words, as one: kind (a number), anchor, extent, first and last document id, and one place (doc_id, row, place). Stored."""
    least = F.min(F.struct("doc_id", "row", "place")).alias("_r")
    kinds = shared.groupBy("anchor", "extent").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), least)
    # Stored at once, so that the numbers stay as they are.
    return _stored(kinds.select(F.monotonically_increasing_id().alias("kind"), "anchor", "extent", "first", "last", "_r.*"), "phrase-kinds")


def segment_words(rows: DataFrame, kinds: DataFrame, window: int, held: int = 4000) -> DataFrame:
    """The words of the kinds, and digests of their windows in order: kind, anchor, extent, first, last, words, digests."""
    wanted = kinds.groupBy("doc_id", "row").agg(F.collect_list(F.struct("kind", "anchor", "extent", "first", "last", "place")).alias("found"))
    schema = "kind long, anchor long, extent long, first long, last long, words binary, digests array<binary>"
    arrow = pa.schema([(c, pa.int64()) for c in ("kind", "anchor", "extent", "first", "last")] + [("words", pa.binary()), ("digests", pa.list_(pa.binary()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: list[np.ndarray] = []
        texts: list[bytes] = []
        digests: list[list[bytes]] = []

        def emit() -> pa.RecordBatch:
            columns = [pa.array(c) for c in np.concatenate(numbers, axis=1)]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary()), pa.array(digests, arrow.field("digests").type)], schema=arrow)
            numbers.clear(), texts.clear(), digests.clear()
            return out

        for batch in batches:
            lists = batch.column("found")
            offsets, flat = lists.offsets.to_pylist(), lists.values
            fields = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in range(6)])
            for i, data in enumerate(batch.column("data")):
                data, some = data.as_py(), fields[:, offsets[i] : offsets[i + 1]]
                begins, ends = word_bounds(data)
                place = some[5]
                at, high, low = place >> 8, place >> 4 & 15, place & 15
                for a, b in zip(begins[at - high].tolist(), ends[at - low + window - 1].tolist()):
                    words = data[a:b].split()
                    texts.append(b" ".join(words))
                    digests.append([xxhash.xxh3_128_digest(b" ".join(words[k : k + window]))[:12] for k in range(len(words) - window + 1)])
                numbers.append(some[:5])
                if len(texts) >= held:
                    yield emit()
        if texts:
            yield emit()

    return rows.drop("given").join(wanted, ["doc_id", "row"]).select("data", "found").mapInArrow(cut, schema)


def patterns(kinds: DataFrame) -> DataFrame:
    """Windows that start in several document ids: anchor, digest, start (the smallest id), and one segment with it (kind, number of the window).

    ``alone`` is 1 where no other kind has the window.
    """
    windows = kinds.select("anchor", "kind", "first", "last", F.posexplode("digests").alias("_p", "digest"))
    # Equal windows have one anchor. Kind and number in one, so that they stay together.
    one = F.shiftleft("kind", 4).bitwiseOR(F.col("_p").cast("long"))
    found = windows.groupBy("digest").agg(F.min("anchor").alias("anchor"), F.min("first").alias("start"), F.max("last").alias("_last"), F.min(one).alias("_one"), F.count(F.lit(1)).alias("_n"))
    number, alone = F.col("_one").bitwiseAND(15).cast("int").alias("number"), (F.col("_n") == 1).cast("int").alias("alone")
    return found.where("start < _last").select("anchor", "digest", "start", F.shiftright("_one", 4).alias("kind"), number, alone)


def dealt(kinds: DataFrame, found: DataFrame, shard: int) -> tuple[DataFrame, DataFrame]:
    """Segments and recurring windows by shard, and a stored table that they are read with: shard, kind, anchor, extent, last, words (null: a window), number, start, alone.

    The words of a window are those of its segment, which is in the same shard.
    """
    # An anchor with more kinds than a shard may hold has several parts.
    sizes = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > shard)
    many = _stored(sizes.select("anchor", F.ceil(F.col("_n") / shard).cast("long").alias("parts")), "phrase-many")
    number = max(1, -(-kinds.count() // shard))
    part = lambda d: F.pmod(F.xxhash64(d), F.col("parts"))
    place = F.pmod(F.xxhash64("anchor", "part"), F.lit(number)).alias("shard")
    if many.isEmpty():
        rows, marked = kinds.withColumn("part", F.lit(0).cast("long")), found.withColumn("part", F.lit(0).cast("long"))
    else:
        alone = kinds.join(many, "anchor", "left_anti").withColumn("part", F.lit(0).cast("long"))
        spread = kinds.join(many, "anchor").withColumn("part", F.explode(F.array_distinct(F.transform("digests", part)))).drop("parts")
        rows = alone.unionByName(spread)
        marked = found.join(many, "anchor", "left").withColumn("part", F.coalesce(part(F.col("digest")), F.lit(0).cast("long")))
    segments_ = rows.select(place, "kind", "anchor", "extent", "last", "words", F.lit(0).alias("number"), F.lit(0).cast("long").alias("start"), F.lit(0).alias("alone"))
    none = F.lit(0).cast("long")
    wanted = marked.select(place, "kind", none.alias("anchor"), none.alias("extent"), none.alias("last"), F.lit(None).cast("binary").alias("words"), "number", "start", "alone")
    return segments_.unionByName(wanted), many


def passages(wanted: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Patterns from recurring windows (kind, number, start, alone): kind, first and last window, start.

    Windows that no other kind has go together where they follow each other and start in one document first.
    """
    out: list[tuple[int, int, int, int]] = []
    for kind, number, start, alone in sorted(wanted):
        if alone and out and out[-1][0] == kind and out[-1][2] == number - 1 and out[-1][3] == start and out[-1][4]:
            out[-1] = (kind, out[-1][1], number, start, 1)
        else:
            out.append((kind, number, number, start, alone))
    return [x[:4] for x in out]


def occurrences(segments_: list[tuple], wanted: list[tuple], window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """All places of the patterns of a shard in its segments, see ``located``.

    ``segments_`` has (kind, anchor, extent, last, words), ``wanted`` has (kind, number, start, alone).
    """
    split = [s[4].split(b" ") for s in segments_]
    # Words become numbers of this shard, so the automaton compares words and no hashes of them. A number is two letters of
    # two alphabets, as the automaton looks a letter up among the children of a node one by one.
    words = dict.fromkeys(w for text in split for w in text)
    base = int(len(words) ** 0.5) + 1
    high, low = [chr(0x10000 + k) for k in range(base)], [chr(0x20000 + k) for k in range(base)]
    codes = {w: high[k // base] + low[k % base] for k, w in enumerate(words)}
    texts = {s[0]: "".join([codes[w] for w in text]) for s, text in zip(segments_, split)}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    compiled = passages(wanted)
    for k, (kind, a, b, _) in enumerate(compiled):
        automaton.add_word(texts[kind][2 * a : 2 * (b + window)], k)
    automaton.make_automaton()
    for kind, anchor, extent, last, _ in segments_:
        begin = end = first = None
        for at, k in automaton.iter(texts[kind]):
            _, a, b, start = compiled[k]
            if start >= last:
                continue  # no place of this segment is behind
            number = (at + 1) // 2 - window
            if first == start and number - (b - a) <= end + 1:
                begin, end = min(begin, number - (b - a)), number
                continue
            if begin is not None:
                yield anchor, extent, begin, end, first
            begin, end, first = number - (b - a), number, start
        if begin is not None:
            yield anchor, extent, begin, end, first


def located(parts: DataFrame, window: int) -> DataFrame:
    """All occurrences of patterns in the segments of their shard: anchor, extent, begin, end, start.

    A row stands for the windows ``begin`` to ``end`` of a segment, which start in document ``start`` first.
    """
    schema = pa.schema([("anchor", pa.int64()), ("extent", pa.int64()), ("begin", pa.int32()), ("end", pa.int32()), ("start", pa.int64())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; one shard is held at a time."""
        now, segments_, wanted = None, [], []

        def settle() -> Iterator[pa.RecordBatch]:
            rows = list(occurrences(segments_, wanted, window)) if wanted else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            ends = [*(np.flatnonzero(np.diff(shards)) + 1).tolist(), batch.num_rows]
            for at, end in zip([0, *ends], ends):
                if end == at:
                    continue
                if shards[at] != now:
                    yield from settle()
                    now, segments_, wanted = shards[at], [], []
                part = batch.slice(at, end - at)
                window_rows = pc.is_null(part.column("words"))
                some = part.filter(pc.invert(window_rows))
                segments_ += zip(*(some.column(c).to_pylist() for c in ("kind", "anchor", "extent", "last", "words")))
                some = part.filter(window_rows)
                wanted += zip(*(some.column(c).to_pylist() for c in ("kind", "number", "start", "alone")))
        yield from settle()

    rows = parts.repartition("shard").sortWithinPartitions("shard")
    return rows.mapInArrow(stream, "anchor long, extent long, begin int, end int, start long")


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of words to remove: doc_id, row, begin, end; they may touch and overlap."""
    return _runs(_rows(docs, id_col, text_col), window, gram, shard)


def _runs(rows: DataFrame, window: int, gram: int, shard: int) -> DataFrame:
    sampled = _stored(segments(rows, window, gram), "phrase-segments")
    shared = shared_segments(sampled)
    common.discard(sampled)
    numbered = segment_kinds(shared)
    kinds = _stored(segment_words(rows, numbered, window), "phrase-words")
    common.discard(numbered)
    found = _stored(patterns(kinds), "phrase-patterns")
    parts, many = dealt(kinds, found, shard)
    hits = _stored(located(parts, window), "phrase-hits")
    common.discard(kinds, found, many)
    both = shared.join(hits, ["anchor", "extent"]).where("doc_id > start")
    # The first word of the segment.
    first = F.shiftright("place", 8) - F.shiftright("place", 4).bitwiseAND(15)
    return both.select("doc_id", "row", (first + F.col("begin")).alias("begin"), (first + F.col("end") + window).alias("end"))


def kept_parts(count: int, begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The runs of words that stay of a document of so many words."""
    if not len(begins):
        return [(0, count)] if count else []
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    fresh = np.flatnonzero(begins[1:] > reach[:-1])
    cut = zip([0, *reach[fresh].tolist(), int(reach[-1])], [int(begins[0]), *begins[fresh + 1].tolist(), count])
    return [(a, b) for a, b in cut if a < b]


def remove_phrases(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True
) -> DataFrame:
    """One row per row of docs: doc_id, kept (words joined by a space, null unless asked for), n_words, n_removed, kept_sha256."""
    rows = _rows(docs, id_col, text_col)
    runs = _runs(rows, window, gram, shard)
    by_doc = runs.groupBy("doc_id", "row").agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column("runs")
            offsets, flat = lists.offsets.to_pylist(), lists.values
            runs_begin, runs_end = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
            for i, (doc_id, data) in enumerate(zip(batch.column("given").to_pylist(), batch.column("data"))):
                data, own = data.as_py(), slice(offsets[i], offsets[i + 1])
                begins, ends = word_bounds(data)
                parts = kept_parts(len(begins), runs_begin[own], runs_end[own])
                kept = b" ".join([b" ".join(data[begins[a] : ends[b - 1]].split()) for a, b in parts])
                text = kept.decode("utf-8", "replace") if with_kept else None
                out.append((doc_id, text, len(begins), len(begins) - sum(b - a for a, b in parts), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    joined = rows.join(by_doc, ["doc_id", "row"], "left").select("given", "data", "runs")
    return joined.mapInArrow(apply, "doc_id long, kept string, n_words long, n_removed long, kept_sha256 string")


def op12_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_phrases(common.table(spark, sf_dir, "documents"), with_kept=False)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Each word of a document with its place; windows by their words; the smallest document of each.
OP12_SQL = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS pos FROM docs WHERE len(words) >= {WINDOW}),
windows AS (SELECT doc_id, pos, array_to_string(words[pos:pos + {WINDOW - 1}], ' ') AS phrase FROM starts),
firsts AS (SELECT phrase, min(doc_id) AS first FROM windows GROUP BY phrase HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + {WINDOW})) AS place
  FROM windows JOIN firsts USING (phrase) WHERE doc_id > first),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs),
cut AS (
  SELECT doc_id, count(*) AS n_words, count(g.place) AS n_removed, string_agg(word, ' ' ORDER BY place) FILTER (g.place IS NULL) AS kept
  FROM placed LEFT JOIN gone g USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)"""
