"""The training-data operators against brute force, on small and awkward tables."""

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
from tokenizers import Tokenizer  # noqa: E402

from marketloom.llm import (  # noqa: E402
    common, exact_dedup, jpeg, language_id, line_dedup, near_dedup, packing, piece_sampling, quality, suffix_dedup, token_files, tokens,
)

random.seed(11)
WORDS = ["".join(random.choice("abcdeiou") for _ in range(random.randint(2, 8))) for _ in range(400)]
PROSE = [" ".join(random.choice(WORDS) for _ in range(random.randint(30, 120))) for _ in range(12)]
SHARED = " ".join(random.choice(WORDS) for _ in range(60))
TEXTS = [
    None, "", " ", "a", "A", "Ää É", "ä É", *PROSE[:6], PROSE[0], PROSE[0].upper(), PROSE[1] + " tail", PROSE[6] + " " + SHARED, SHARED + " " + PROSE[7],
    "x\ny\nz\nw", "q\nx\ny\nz", "l\nl\nl\nl\nl", "\n\n\n\n", "日本語 テスト 🙂 " * 40, "é" * 500, "one two  three\tfour\n\n five", PROSE[8] * 30, "<|endoftext|> it's 12,3!", "ab",
]
ROWS = [(i * 3 + 1, t, "xx" if i % 2 else None, i) for i, t in enumerate(TEXTS)] + [(1, None, None, 0)]
#: Extra columns with the names that operators use inside.
SCHEMA = "doc_id long, text string, component long, bucket int"


@pytest.fixture(scope="module")
def docs(spark):
    return common.materialise(spark.createDataFrame([(a, b, 7, 7) for a, b, _, _ in ROWS], SCHEMA), "fixture")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(t):
    return (t or "").translate(str.maketrans(common.UPPER, common.LOWER))


def test_empty_tables(spark, empty):
    assert exact_dedup.exact_groups(empty).count() == 0
    assert exact_dedup.drop_exact_copies(empty).count() == 0
    assert line_dedup.dedup_lines(empty).count() == 0
    assert near_dedup.near_groups(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert jpeg.media_features(jpeg.to_media(empty)).count() == 0
    assert packing.pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert piece_sampling.sample_segmentations(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    files = token_files.write_token_files(empty, common.fresh_path(spark, "t"), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_token_files(spark, "file:///", files).count() == 0


def test_exact(docs):
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[lower(t)].append(i)
    for r in exact_dedup.exact_groups(docs).collect():
        (text, ids), = [(t, g) for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        assert r.doc_id in ids and r.keep_id == max(ids) and r.group_size == len(ids) and r.kept == (r.doc_id == max(ids))
    assert exact_dedup.drop_exact_copies(docs).count() == len(groups)


def test_lines(docs):
    seen, gone = {}, defaultdict(set)
    for i, t, *_ in sorted(ROWS[:-1]):
        ls = (t or "").split("\n")
        for k in range(len(ls) - 2):
            w = "\n".join(ls[k : k + 3])
            if w in seen:
                gone[i] |= {k, k + 1, k + 2}
            seen.setdefault(w, i)
    for r in line_dedup.dedup_lines(docs).collect():
        t = next(t for i, t, *_ in ROWS if i == r.doc_id) or ""
        want = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[r.doc_id])
        assert (r.kept_text, r.n_removed) == (want, len(gone[r.doc_id]))


def test_suffix(docs):
    data = [(i, (t or "").encode()) for i, t, *_ in ROWS]
    counts = Counter(d[k : k + 200] for _, d in data for k in range(len(d) - 199))
    got = sorted((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect())
    want = []
    for i, d in data:
        cover = bytearray(len(d))
        for k in range(len(d) - 199):
            if counts[d[k : k + 200]] > 1:
                cover[k : k + 200] = b"\1" * 200
        kept = bytes(c for c, m in zip(d, cover) if not m)
        want.append((i, sum(cover), len([x for x in bytes(cover).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)
    assert suffix_dedup.without_repeats(docs).columns == docs.columns


def test_near(spark):
    base = PROSE[9].split()
    rows = [(k, " ".join(base[:k] + ["zz"] + base[k + 1 :])) for k in range(5, 60, 6)] + [(900 + i, t) for i, (_, t, *_) in enumerate(ROWS)]
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if n and 100 * n >= 85 * len(sets[a] | sets[b]):
                    parent[a] = parent[b] = min(parent[a], parent[b])
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), parent[i], parent[i] == i) for i in sets}


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder(name, keeps):
    own, plain = tokens.UnitEncoder(public_tokenizers.path(name), keeps), Tokenizer.from_file(public_tokenizers.path(name))
    texts = [t or "" for _, t, *_ in ROWS] + ["  a  b", "a\n\nb", "\na\n", "ΑΣ ΣΑΣ", "x\x1cy \x1c", "a,\nb. \nc", "It'S <|startoftext|>", "ab\u0130. \u0130!? x", "\u0915\u0958. \ufb2a! a\u0130b,"]
    # New units, then kept ones, then none kept.
    for limit in (10**6, 10**6, 0):
        own.limit = limit
        assert [np.frombuffer(x, own.dtype).tolist() for x in own.encode(texts)] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_token_files(spark, docs):
    base = common.fresh_path(spark, "files")
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    files = token_files.write_token_files(docs, base, public_tokenizers.path("byte_bpe_50k.json"), length=16)
    got = token_files.read_token_files(spark, base, files).orderBy("start").collect()
    start = 0
    for r, (i, t, *_) in zip(got, sorted(ROWS, key=lambda r: r[0]), strict=True):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_packing(docs):
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [(i, plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, *_ in ROWS]
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), top=256, least=16).collect()
    # The pieces of each document follow each other, hold each id once, and have its checksums.
    left = sorted((r.doc_id, r.doc_tokens, r.start, r.length, r.ids_crc32) for r in pieces)
    for i, own in sorted(ids, key=lambda x: (x[0], len(x[1]))):
        at = 0
        while at < len(own):
            piece = next(p for p in left if p[:3] == (i, len(own), at))
            left.remove(piece)
            assert piece[4] == zlib.crc32(np.array(own[at : at + piece[3]], "<u4").tobytes())
            at += piece[3]
        assert at == len(own)
    assert not left
    by = defaultdict(list)
    for r in pieces:
        by[r.sequence_id].append((r.offset, r.length, r.seq_tokens))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == parts[0][2] <= 256 and at & (at - 1) == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_cuts_everything_once(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 4096, rnd.integers(1, 80))
    pieces, sizes = packing.plan(lengths, 4096, 256)
    got = np.zeros(len(lengths), np.int64)
    np.add.at(got, pieces[:, 0], pieces[:, 2])
    assert (got == lengths).all() and (np.bincount(pieces[:, 3], pieces[:, 2], len(sizes)) == sizes).all()


def test_jpeg(docs):
    for r in jpeg.media_features(jpeg.to_media(docs)).collect():
        texts = [jpeg.pad((t or "").encode()) for i, t, *_ in ROWS if i == r.doc_id]
        assert r.payload_sha256 in {hashlib.sha256(x).hexdigest() for x in texts} and r.payload_bytes % 192 == 0
    noise = [bytes(range(256)) * 3, b"\xff" * 192 * 5, b""]
    files = [jpeg.store(jpeg.pad(x)) for x in noise]
    assert [jpeg.payload_of(*d) for d in jpeg.decode(files)] == [jpeg.pad(x) for x in noise]


def test_jpeg_general_tables():
    """Runs, end of block, codes of many lengths and no restarts, from a bit writer of the test."""
    dc = {0: "00", 3: "01", 5: "10"}
    ac = {0x00: "00", 0x01: "01", 0x12: "100", 0xF0: "101", 0x23: "1100"}

    def spec(codes):
        order = sorted(codes, key=lambda s: (len(codes[s]), codes[s]))
        return bytes(sum(len(codes[s]) == n for s in order) for n in range(1, 17)) + bytes(order)

    bits = dc[3] + "101" + ac[0x01] + "1" + ac[0x12] + "01" + ac[0xF0] + ac[0x23] + "110" + ac[0x00]
    bits += dc[5] + "00110" + ac[0x00]
    scan = bytes(int(bits[i : i + 8].ljust(8, "1"), 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")
    file = b"\xff\xd8" + jpeg._segment(0xDB, b"\0" + bytes(range(1, 65))) + jpeg._segment(0xC0, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0]))
    file += jpeg._segment(0xC4, b"\0" + spec(dc)) + jpeg._segment(0xC4, b"\x10" + spec(ac)) + jpeg._segment(0xDA, bytes([1, 1, 0, 0, 63, 0])) + scan + b"\xff\xd9"
    (frame, c), = jpeg.decode([file])
    want = np.zeros((2, 1, 64), int)
    want[0, 0, [0, 1, 3, 22]] = [5, 1, -2, 6]
    want[1, 0, 0] = 5 - 25
    assert (frame.width, frame.height) == (16, 8) and (c == want).all()


def test_quality(spark):
    good = [(i, PROSE[i % 12] + f" {i}", 1) for i in range(60)]
    bad = [(100 + i, PROSE[i % 12].upper().replace(" ", "!! ") + "$$$", 0) for i in range(60)]
    rows = good + bad
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(500, None), (501, "")], "doc_id long, text string")
    machine = quality.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, quality int"), buckets=1024)
    out = {r.doc_id: r.score for r in quality.score(docs, machine).collect()}
    held = [(out[i], y) for i, _, y in rows if i % 5 == 0]
    assert min(s for s, y in held if y) > max(s for s, y in held if not y)
    assert out[500] == out[501] and 0 <= out[500] <= 1
    index, x = machine.inputs(np.array([1, 5]), np.zeros(quality.N_STATS))
    pairs = sum(machine.v[a] @ machine.v[b] * p * q for k, (a, p) in enumerate(zip(index, x)) for b, q in list(zip(index, x))[:k])
    assert math.isclose(machine.score(index, x), 1 / (1 + math.exp(-(machine.bias + machine.w[index] @ x + pairs))))


def test_language(spark):
    sounds = {"aa": "bamo", "ee": "skrit"}
    rnd = random.Random(5)
    rows = [(i, " ".join("".join(rnd.choice(sounds[l]) for _ in range(5)) for _ in range(40)), l) for i in range(80) for l in (("aa", "ee")[i % 2],)]
    docs = spark.createDataFrame(rows + [(900, None, None), (901, "12 !", None), (902, "zzz qqq www " * 30, None)], "doc_id long, text string, lang string")
    model = language_id.train(docs.where("doc_id % 4 < 3"))
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert all(got[i].lang_pred == lang and not got[i].rejected for i, _, lang in rows)
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[902].rejected
    assert language_id.keep_identified(docs, model).columns == docs.columns
    nothing = language_id.identify(docs, language_id.train(docs.where("lang = 'none'")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_piece_sampling(docs):
    out = piece_sampling.sample_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2, with_ids=True).collect()
    assert all(r.round_trip for r in out)
    by = defaultdict(set)
    for r in out:
        by[r.doc_id].add(tuple(r.ids))
        assert r.log_p <= 1e-9 and r.log_inclusion <= 1e-9
    assert by[4] == {()} and len(by[22]) == 2


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    frame = spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t, *_ in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    columns = frame.columns
    for name, stage in corpus_pipeline.STAGES:
        frame = common.materialise(stage(spark, frame, ""), "stage")
        assert frame.columns == columns or name == "packing"
    assert frame.count() > 0
