"""Spelling variants, repeated phrases and hard negatives against brute force on awkward tables; keys and groups of rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from marketloom.llm import common, hard_negatives, packing, phrase_dedup, spelling, suffix_dedup  # noqa: E402

#: Extra columns with the names that the operators use inside.
DOCS = "doc_id long, text string, word string, n long, row long, anchor long, data string, found long"
LONG = [chr(c) for c in (0xE9, 0xDF, 0xFF, 0xC0)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, 3, "d", 4) for i, t in rows], DOCS)


# Spelling variants.


def plain_variants(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                counts[w] += 1
    words = {w: n for w, n in counts.items() if n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    out, form = [], {}
    close = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def test_spelling_variants(spark):
    rnd = random.Random(5)
    letters = "aeinst" + LONG[0] + LONG[1]
    base = ["".join(rnd.choices(letters, k=rnd.randint(6, 26))) for _ in range(25)] + ["aaaaaaaa", "abababab"]

    def edit(w):
        k, c = rnd.randrange(len(w) + 1), rnd.choice(letters)
        return rnd.choice((w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]))

    rows = []
    for i in range(120):
        chosen = [rnd.choice(base) for _ in range(60)] + [edit(rnd.choice(base)) for _ in range(12)] + [edit(edit(rnd.choice(base[:4]))) for _ in range(4)]
        rows.append((i * 7, " ".join(w.upper() if rnd.random() < 0.1 else w for w in chosen)))
    # A chain of forms: 3, 40 and 500 times.
    rows += [(5000, "chainabc " * 3 + "chainabd " * 40 + "chainxbd " * 500), (5001, "tieword1 a×b÷cdefgh " * 3), (5002, None), (5003, ""), (None, "withoutid withoutid " * 2), (5004, "x" * 200_000 + " " + "x" * 200_000)]
    rows += rows[:3]
    got = sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_groups(table(spark, rows)).collect())
    want = plain_variants(rows)
    assert got == want
    assert any(r[1] and r[2] != r[1] for r in want) and {len(r[0]) for r in want} >= {7, 8, 20}
    assert spelling.spelling_groups(table(spark, [])).count() == 0


def test_full_neighbourhoods():
    """All edits of a reduced word, and no others."""
    word = [3, 1, 1, 4]
    key = lambda w: int(spelling._prefixes(np.array([w], np.uint64))[0, -1])
    symbols = range(1, spelling.SYMBOLS + 1)
    deleted = {key(word[:k] + word[k + 1 :]) for k in range(4)}
    replaced = {key(word[:k] + [s] + word[k + 1 :]) for k in range(4) for s in symbols}
    inserted = {key(word[:k] + [s] + word[k:]) for k in range(5) for s in symbols}
    found = lambda kinds: {int(h) for h in spelling.neighbourhood(np.array([word], np.uint64), 0, 5, kinds)[0]}
    assert found("d") == deleted and found("r") == replaced and found("x") == inserted


# Repeated phrases.


def plain_phrases(rows, window=13):
    behind = lambda i: math.inf if i is None else i
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, math.inf), behind(i))
    out = []
    for i, w in words:
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < behind(i) for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, kept, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def phrase_rows():
    rnd = random.Random(8)
    vocabulary = ["a", "b", "c", "the", "Of", "of", " ", "é", "日本", "🙂", *("w%d" % k for k in range(60))]
    prose = lambda n: rnd.choices(vocabulary, k=n)
    shared, long = prose(40), prose(400)
    rows = []
    for i in range(60):
        w = prose(rnd.randint(0, 60))
        if i % 3:
            a = rnd.randrange(20)
            w = w + shared[a : a + rnd.randint(12, 20)] + prose(5)
        if i % 5 == 0:
            w = w + long[i : i + 100] * 2
        rows.append((rnd.randrange(40) if i % 4 else i + 100, rnd.choice((" ", "\n", "\t \x0b")).join(w)))
    rows += [(7, " ".join(["x"] * 50)), (8, " ".join(["x"] * 30)), (9, " ".join(["x", "y"] * 3000)), (900, None), (901, ""), (902, " \n"), (None, " ".join(shared)), (None, " ".join(shared[:20])), (3, " ".join(long)), (3, " ".join(long[:50]))]
    return rows + rows[:2]


def test_repeated_phrases(spark):
    rows = phrase_rows()
    got = sorted((tuple(r) for r in phrase_dedup.remove_phrases(table(spark, rows)).collect()), key=str)
    want = plain_phrases(rows)
    assert got == want and sum(r[3] for r in want) > 1000
    assert phrase_dedup.remove_phrases(table(spark, [])).count() == 0


def test_anchors_with_many_patterns_and_short_windows(spark):
    """Shards of three patterns, so that common anchors are dealt to several."""
    rows = phrase_rows()
    runs = phrase_dedup.remove_phrases(table(spark, rows), window=5, gram=2, shard=3)
    assert sorted((tuple(r) for r in runs.collect()), key=str) == plain_phrases(rows, 5)


def test_words_of_parts():
    data = ("é" * 7 + " ab\t\n" + "x" * 50 + " y ").encode()
    whole = phrase_dedup.word_hashes(data)
    begins, ends = phrase_dedup.word_bounds(data)
    assert [data[a:b] for a, b in zip(begins, ends)] == data.split()
    for part in (1, 3, 16):
        assert (phrase_dedup.word_hashes(data, part) == whole).all()


# Hard negatives.


def plain_negatives(rows, every=3, positives=5, negatives=10, least=30, most=90):
    """rows: (id, vector, label)."""
    fit = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (i, v, y) in enumerate(fit):
        if i % every:
            continue
        scored = sorted(((-dot(v, w), j, n) for n, (j, w, _) in enumerate(fit) if n != k))
        near = [(-s, j) for s, j, n in scored if fit[n][2] == y][:positives]
        for s, p in near:
            far = [(-t, j) for t, j, n in scored if fit[n][2] != y and least * s <= -100 * t <= most * s][:negatives]
            out += [(i, p, r + 1, j, s, t) for r, (t, j) in enumerate(far)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, row long, code string, scores string"


def negatives(spark, rows, every=3):
    frame = spark.createDataFrame([(i, v, y, 1, "c", "s") for i, v, y in rows], VECTORS)
    found = hard_negatives.hard_negatives(hard_negatives.vectors(frame), every)
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found.collect())


@pytest.mark.parametrize("size", [1, 5, 64, 100])
def test_hard_negatives(spark, size, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SMALL", 40)
    rnd = np.random.default_rng(size)
    centres = rnd.normal(size=(6, size))
    rows = []
    for i in range(180):
        v = centres[rnd.integers(6)] + rnd.normal(size=size) * rnd.choice([0.1, 0.5, 2])
        rows.append((i, np.float32(v).tolist(), int(rnd.integers(4))))
    rows += [(300, None, 1), (303, [None] * size, 1), (306, [float("nan")] * size, 1), (309, [float("inf")] * size, 1), (312, [0.5] * size, None), (None, [0.5] * size, 1)]
    rows += [(600, [0.0] * size, 0), (603, [], 1), (606, np.float32(centres[0, : size // 2 + 1]).tolist(), 2)]
    # Equal rows, and one id with two vectors and labels.
    rows += [rows[0], rows[3], (9, rows[12][1], 3)]
    want = plain_negatives(rows)
    assert negatives(spark, rows) == want and len(want) > 200


def test_hard_negatives_of_empty_tables(spark):
    assert negatives(spark, []) == []
    assert negatives(spark, [(3, [0.1, 0.2], 1)]) == []


def test_intervals_hold_all_scores():
    """No true score leaves its interval, and intervals are no wider than the residuals explain."""
    rnd = np.random.default_rng(2)
    v = rnd.integers(-300, 300, (500, 48)).astype(np.int64)
    v[0] = 0
    turned = v.astype(float) @ hard_negatives.rotation(48)
    code, align = hard_negatives.one_bit(turned)
    held = object.__new__(hard_negatives.Slice)
    held.size, held.row, held.v, held.code, held.align = 48, np.arange(500), v, code, align
    held.rest = np.sqrt(np.maximum((turned**2).sum(axis=1) - align**2, 0))
    held.ones, held.turn = np.bitwise_count(code).sum(axis=1).astype(np.int64), hard_negatives.rotation(48)
    for q in v[:60]:
        _, low, high = held.bounds(q)
        true = v @ q
        assert (low <= true).all() and (true <= high).all()
        assert (high - low <= 2.1 * held.rest * np.sqrt((q**2).sum()) + 0.05 * np.abs(align) * np.sqrt((q**2).sum()) + 1e-3).all()


# Keys and groups of rows.


def test_equal_checksums_keep_texts_apart(spark):
    """Rows without an id whose texts have one crc32: only the text with the shared passage loses it."""
    rnd = random.Random(1)
    letters = lambda n: "".join(rnd.choices("abcdefghij", k=n))
    for _ in range(3000):
        shared, alone = letters(250), letters(305)
        a = (shared + letters(59)).encode()
        b = crc_twin_of(alone.encode(), zlib.crc32(a))
        if b.isascii() and b.decode().isprintable():
            break
    assert zlib.crc32(a) == zlib.crc32(b) and len(a) == len(b)
    rows = [(None, a.decode()), (None, b.decode()), (5, shared + " end of another text")]
    found = suffix_dedup.remove_repeats(table(spark, rows)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in found) == [(270, 250), (309, 0), (309, 250)]
    left = suffix_dedup.without_repeats(table(spark, rows)).select("text").collect()
    assert b.decode() in {r.text for r in left}


def crc_twin_of(head, want):
    """``head`` with four bytes behind it that give a wanted crc32."""
    table_ = []
    for n in range(256):
        c = n
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table_.append(c)
    back = {c >> 24: n for n, c in enumerate(table_)}
    end, numbers = want ^ 0xFFFFFFFF, []
    for _ in range(4):
        n = back[end >> 24]
        numbers.append(n)
        end = (end ^ table_[n]) << 8 & 0xFFFFFFFF | 0
    now, tail = zlib.crc32(head) ^ 0xFFFFFFFF, bytearray()
    for n in reversed(numbers):
        tail.append(now & 255 ^ n)
        now = table_[n] ^ now >> 8
    return head + bytes(tail)


def groups(spark, rows, **kw):
    pieces = packing.pack(table(spark, rows), public_tokenizers.path("word_bpe_49k.json"), **kw)
    return pieces.groupBy(F.shiftright("sequence_id", 32).alias("g")).agg(F.count_distinct("doc_id").alias("d"), F.sum("length").alias("n"), F.count(F.lit(1)).alias("p")).collect()


def test_packing_groups_follow_rows_and_spread_equal_rows(spark):
    empty = groups(spark, [(i, "") for i in range(20_000)])
    assert len(empty) == 2 and sum(r.n for r in empty) == 20_000
    same = groups(spark, [(1, "the cat sat on the mat " * 4)] * 6000, group_rows=1000)
    assert len(same) == 6 and max(r.n for r in same) < 1.3 * sum(r.n for r in same) / 6


def test_stored_tables_are_deleted(spark):
    import os

    at = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(at))
    assert spelling.spelling_groups(table(spark, [(1, "wordword " * 3)])).count() == 1
    assert phrase_dedup.remove_phrases(table(spark, [(1, "a b " * 20), (2, "a b " * 20)])).agg({"n_removed": "sum"}).first()[0] == 40
    left = {re.sub("-[0-9a-f]{32}$", "", x) for x in set(os.listdir(at)) - before}
    # What the results themselves read.
    assert left <= {"spelling-forms", "spelling-roots", "phrase-shared", "phrase-hits"}


def test_counts_by_document(spark):
    by = defaultdict(int)
    for r in phrase_dedup.remove_phrases(table(spark, phrase_rows()), with_kept=False).collect():
        by[r.kept is None] += 1
    assert by[True] == len(phrase_rows())
