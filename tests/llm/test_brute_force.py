"""Training-data operators against enumeration, plain formulas and awkward tables."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from conftest import SF  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from marketloom.llm import common, exact_dedup, jpeg, language_id, line_dedup, near_dedup, piece_sampling, quality, suffix_dedup  # noqa: E402

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def edited(n, edits, seed, words=200):
    """Near copies: words of one text replaced, left out or put in."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(rnd.choice(edits)):
            k, kind = rnd.randrange(len(text)), rnd.random()
            if kind < 0.6:
                text[k] = f"x{rnd.randrange(10**6)}"
            elif kind < 0.8:
                del text[k]
            else:
                text.insert(k, f"x{rnd.randrange(10**6)}")
        out.append((i + 1, " ".join(text)))
    return out


def linked(rows, percent):
    """The smallest id that each row reaches over pairs at the threshold."""
    sets = [set(near_dedup.shingles(t).tolist()) for _, t in rows]
    top = list(range(len(rows)))

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                top[root(a)] = root(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[root(k)].append(i)
    return [min(least[root(k)]) for k in range(len(rows))]


@pytest.mark.parametrize("percent, edits", [(85, (3,)), (80, (0, 1, 2, 3, 4, 6))])
def test_near_copies_at_both_thresholds(spark, percent, edits):
    rows = edited(90, edits, 5) + [(1000 + i, t) for i, t in edited(40, (1, 2), 6, 40)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), percent).collect()}
    assert got == dict(zip([i for i, _ in rows], linked(rows, percent)))


def test_pair_tests_stay_few(spark, monkeypatch):
    """Members of a group are tested with hubs and few others, not with each other."""
    tests = []
    plain = near_dedup.overlapping

    def counted(pairs, shared, percent):
        pairs = common.materialise(pairs, "counted")
        tests.append(pairs.count())
        return plain(pairs, shared, percent)

    monkeypatch.setattr(near_dedup, "overlapping", counted)
    seen = {}
    for n in (200, 400):
        tests.clear()
        assert near_dedup.near_groups(spark.createDataFrame(edited(n, (2,), 7), "doc_id long, text string"), 85).count() == n
        seen[n] = sum(tests)
    assert seen[200] <= 3 * 200 and seen[400] <= 3 * 400


def test_keys_are_bounded_by_differences(spark):
    """A member has a row per difference at most, however many values g has in its family, and linked members meet."""
    rnd = random.Random(11)
    rows = [(0, i, i, 360 * (i % 40) - 3600 + rnd.randrange(360), i < 5, sorted(rnd.sample(range(120), 60))) for i in range(150)]
    rows = [(*r[:3], -7000 if r[4] else r[3], *r[4:]) for r in rows]
    shared = spark.createDataFrame(rows, "hub long, node long, component long, g long, _home boolean, d array<long>").cache()
    keys = near_dedup.difference_keys(shared, 80)
    assert keys.count() <= sum(len(r[5]) for r in rows)
    got = {(r.a, r.b) for r in near_dedup.overlapping(near_dedup.key_pairs(near_dedup.within_reach(keys)), shared, 80).collect()}
    want = {(x[1], y[1]) for x in rows for y in rows if x[1] < y[1] and 0 < x[3] + y[3] <= 360 * len({*x[5]} & {*y[5]})}
    assert want <= got and len(want) > 1000


def test_rows_with_equal_ids(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "b"), (None, "c"), (None, "c")], "doc_id long, text string")
    kept = sorted((r.doc_id or 0, r.text) for r in exact_dedup.drop_exact_copies(frame).collect())
    assert kept == [(0, "c"), (0, "c"), (1, "b"), (2, "a")]
    lines = spark.createDataFrame([(1, "P\nQ\nR"), (2, "P\nQ\nR"), (2, "P\nQ\nX\nS"), (None, "P\nQ\nR")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.kept_text) for r in line_dedup.dedup_lines(lines).collect())
    assert got == [(0, "P\nQ\nR"), (1, ""), (2, ""), (2, "P\nQ\nX\nS")]
    base = [f"w{i}" for i in range(60)]
    other = " ".join(f"v{i}" for i in range(60))
    near = " ".join([*base[:59], "end"])
    frame = spark.createDataFrame([(1, " ".join(base)), (2, near), (2, other), (None, " ".join(base)), (None, None), (3, None)], "doc_id long, text string")
    kept = near_dedup.drop_near_copies(frame).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(1, " ".join(base)), (2, other), (0, ""), (3, "")])


def test_columns_with_clashing_names(spark):
    names = "doc_id long, text string, _id long, _row long, _runs long, whole long, row long, node long, band long, lang string, runs long"
    text = " ".join(f"word{i}" for i in range(80))
    frame = spark.createDataFrame([(1, text, *[7] * 7, "xx", 7), (2, text, *[7] * 7, "xx", 7), (None, None, *[None] * 9)], names)
    cut = suffix_dedup.without_repeats(frame)
    assert cut.columns == frame.columns and sorted((r.doc_id or 0, r.text or "", r.runs) for r in cut.collect()) == [(0, "", None), (1, "", 7), (2, "", 7)]
    assert sorted(r.doc_id or 0 for r in near_dedup.drop_near_copies(frame).collect()) == [0, 1]
    assert sorted(r.doc_id or 0 for r in exact_dedup.drop_exact_copies(frame).collect()) == [0, 2]
    model = language_id.train(frame)
    assert language_id.keep_identified(frame, model).columns == frame.columns
    machine = quality.train(frame, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), buckets=64)
    assert quality.score(frame, machine).count() == 3


def segmentations(vocabulary, word):
    """All ways to write a word, with their log weights."""
    known = {p: i for i, p in enumerate(vocabulary.pieces) if i > 2 and not vocabulary.model.is_byte(i)}
    out = {}

    def go(rest, ids, weight):
        if not rest:
            out[ids] = weight
        for n in range(1, len(rest) + 1):
            if rest[:n] in known:
                go(rest[n:], (*ids, known[rest[:n]]), weight + vocabulary.log_weight[known[rest[:n]]])

    go(word, (), 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {ids: math.exp(w - total) for ids, w in out.items()}


@pytest.mark.parametrize("text", ["thing", "the in"])
def test_samples_against_enumeration(text):
    v = piece_sampling.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    n, plain = 6000, v.normalise(text)
    law = {(): 1.0}
    for word in plain.split("▁")[1:]:
        law = {a + b: p * q for a, p in law.items() for b, q in segmentations(v, "▁" + word).items()}
    rows = piece_sampling.sampled(piece_sampling.Lattices(v), [plain] * n, list(range(n)), 3, True)
    by = defaultdict(list)
    for r in sorted(rows, key=lambda r: r[:2]):
        by[r[0]].append((tuple(r[8].tolist()), *r[3:6], r[7]))
    for samples in by.values():
        assert len({s[0] for s in samples}) == 3 and all(s[4] for s in samples)
        assert all(math.isclose(s[1], math.log(law[s[0]]), abs_tol=1e-9) for s in samples)
        assert samples[0][2] > samples[1][2] > samples[2][2]
    # The first m samples are a draw without replacement.
    for m in (1, 2, 3):
        for ids, count in Counter(tuple(s[0] for s in samples[:m]) for samples in by.values()).most_common(6):
            p, left = 1.0, 1.0
            for x in ids:
                p, left = p * law[x] / left, left - law[x]
            assert abs(count / n - p) < 4.5 * math.sqrt(p * (1 - p) / n)
    # Weighted by the inclusion scores, the samples of a text add up to one on average.
    sums = [sum(math.exp(s[1] - s[3]) for s in samples) for samples in by.values()]
    assert abs(np.mean(sums) - 1) < 5 * np.std(sums) / math.sqrt(n) + 1e-9


def test_few_segmentations_and_batches(spark):
    """Texts with fewer ways than samples, and samples that no other row of the batch changes."""
    v = piece_sampling.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["\u00a0", "the thing in a place", "🙂 ½ x" * 30, "", "q" * 3000]
    texts = [v.normalise(t) for t in texts]
    whole = piece_sampling.sampled(piece_sampling.Lattices(v), texts, [5, 6, 7, 8, 9], 3, True)
    alone = [(k, *r[1:]) for k, t in enumerate(texts) for r in piece_sampling.sampled(piece_sampling.Lattices(v), [t], [5 + k], 3, True)]
    key = lambda r: (*r[:8], tuple(r[8]))
    assert sorted(map(key, whole)) == sorted(map(key, alone)) and all(r[7] for r in whole)
    counts = Counter(r[0] for r in whole)
    assert counts[3] == 1 and counts[1] == counts[4] == 3
    assert all(r[5] == 0 for r in whole if counts[r[0]] < 3)


def test_best_paths_need_no_walk(monkeypatch):
    """Draws that lead to a word's best path take no steps, and give what the steps give."""
    v = piece_sampling.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [v.normalise("the thing in a place and the time of that, thouorin.\nIs 555-3192 🙂 asjaez$$$ unbelievably " * 20)] * 30
    walked = [0]
    plain = piece_sampling.Lattices.walk

    def counted(self, nodes, *rest):
        walked[0] += len(nodes)
        return plain(self, nodes, *rest)

    monkeypatch.setattr(piece_sampling.Lattices, "walk", counted)
    lattices = piece_sampling.Lattices(v)
    key = lambda r: (*r[:8], tuple(r[8]))
    quick = list(map(key, piece_sampling.sampled(lattices, texts, list(range(30)), 3, True)))
    quick_steps, walked[0] = walked[0], 0
    lattices.best_below[:] = 0
    assert quick == list(map(key, piece_sampling.sampled(lattices, texts, list(range(30)), 3, True)))
    assert quick_steps < walked[0] / 2


def test_lattices_hold_nothing_of_other_words():
    """The sums of a word are the same to the last bit, alone and beside others."""
    v = piece_sampling.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    words = ["▁thing", "▁thouorin.\nIs", "▁½🙂x", "▁a", "▁" + "q" * 50, "▁unbelievably"]
    together, first = piece_sampling.Lattices(v), piece_sampling.Lattices(v)
    together.add(words)

    def edges(lattices, node):
        a, b = lattices.first_edge[node : node + 2].tolist()
        return [(x.p[i], x.run[i], x.log_p[i], x.others[i], x.tokens[i] >= 0, edges(x, t) if t >= 0 else ()) for x, i, t in zip([lattices] * (b - a), range(a, b), lattices.target[a:b].tolist())]

    for word in words[:4] + words[5:]:
        first.clear()
        first.add([word])
        assert edges(together, int(together.start[words.index(word)])) == edges(first, int(first.start[0]))


def test_kneser_ney_formula():
    """Probabilities of order 3 by the recursive formula, and their sum over all letters and unseen ones."""
    words = Counter({"abab": 3, "abba": 1, "baa": 2, "cab": 1})
    counts = Counter()
    for w, n in words.items():
        for g in language_id.grams_of(w, 3):
            counts[g] += n
    model = language_id.build({"xx": counts}, 3)
    levels = {3: counts}
    for k in (2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    letters = sorted({g[-1] for g in counts})

    def p(gram):
        if not gram:
            return 1 / (len(letters) + 1)
        level = levels[len(gram)]
        ones, twos = (sum(c == k for c in level.values()) for k in (1, 2))
        d = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5
        same = {g: c for g, c in level.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        return max(same.get(gram, 0) - d, 0) / total + d * len(same) / total * p(gram[1:])

    for context in ("ab", "ba", "ca", "zz"):
        assert math.isclose(sum(p(context + c) for c in [*letters, "?"]), 1)
    for w in ("abab", "cabba", "zab", "q"):
        want = sum(math.log(p(g)) for g in language_id.grams_of(w, 3))
        assert math.isclose(model.log_probabilities([w])[0, 0], want, rel_tol=1e-5)


def test_languages_known_and_unknown(spark):
    """On the given texts: held-out rows, a language left out, texts in two languages, signs that are no letters."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "n_chars"))
    rows = [r for r in docs.collect() if r.text and r.lang]
    model = language_id.train(docs.where(language_id.fold("doc_id", 3) != 1))
    scorer = language_id.Scorer(model)
    held = [r for r in rows if r.doc_id % 2]
    names, _, _, rejected = scorer.predict([r.text for r in held])
    assert np.mean([a == r.lang for a, r in zip(names, held)]) > 0.97 and rejected.mean() < 0.01
    both = [a.text[:400] + " " + b.text[:400] for a, b in zip([r for r in rows if r.lang == "de"], [r for r in rows if r.lang == "fr"])]
    assert scorer.predict(both)[3].mean() < 0.05
    names, score, _, rejected = scorer.predict(["½ ² Ⅷ 12", "", None])
    assert names == ["und"] * 3 and not score.any() and rejected.all()
    rnd = random.Random(4)
    noise = [" ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(30)) for _ in range(20)]
    assert scorer.predict(noise)[3].all()
    other = language_id.Scorer(language_id.train(docs.where("lang <> 'de'")))
    assert other.predict([r.text for r in rows if r.lang == "de"])[3].mean() > 0.8
    assert other.predict([r.text for r in rows if r.lang != "de"])[3].mean() < 0.02


def test_quality_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    machine = quality.train(docs, labels.where(~quality.held_out("doc_id")))
    score = {r.doc_id: r.score for r in quality.score(docs, machine).collect()}
    held = [(score[r.doc_id], r.quality) for r in labels.where(quality.held_out("doc_id")).collect()]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held if x for b, y in held if not y]
    assert np.mean(pairs) > 0.95 and np.mean([(s >= 0.3) == bool(y) for s, y in held]) > 0.9
    assert quality.score(docs.limit(0), machine).count() == 0


def test_thumbnails():
    """Thumbnails of a file are the means of its blocks, from an own inverse transform."""
    payload = jpeg.pad(bytes(random.Random(3).choices(range(256), k=3000)))
    (frame, c), = jpeg.decode([jpeg.store(payload)])
    thumb = jpeg.thumbnail(frame, c)
    w, h = frame.mcus
    assert thumb.shape == (h, w) == (-(-frame.height // 8), -(-frame.width // 8))
    spec = frame.quant[frame.components[0][3]]
    for k, block in enumerate(c[:, 0]):
        # The mean of an 8x8 block is its DC term over 8; other cosines add up to nothing.
        pixel = np.clip(round(block[0] * spec[0] / 8) + 128, 0, 255)
        assert thumb[k // w, k % w] == pixel
    grid = np.array([[thumb[i * h // 8, j * w // 8] for j in range(8)] for i in range(8)], float)
    assert jpeg.average_hash(thumb) == int("".join("1" if x > grid.mean() else "0" for x in grid.ravel()), 2)


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    source = spark.read.parquet(f"{SF}/documents.parquet")
    texts = edited(60, (0, 1, 2, 3, 5), 9, 120)
    rows = [(10_000 + i, t, "en", "own", len(t)) for i, t in texts]
    rows += [(20_000 + i, t.upper(), "en", "own", len(t)) for i, t in texts[:20]] + [(30_000, None, None, None, None), (30_001, "", "en", "own", 0)]
    docs = common.materialise(source.select(*[c.split()[0] for c in DOCUMENT.split(", ")]).union(spark.createDataFrame(rows, DOCUMENT)), "pipeline-test")
    every = docs.collect()
    low = lambda t: (t or "").translate(str.maketrans(common.UPPER, common.LOWER))
    best = {}
    for r in every:
        best[low(r.text)] = max(best.get(low(r.text), -1), r.doc_id)
    exact = stages["exact_dedup"](spark, docs, "")
    assert exact.columns == docs.columns and sorted(r.doc_id for r in exact.collect()) == sorted(best.values())
    exact = common.materialise(exact, "pipeline-test")
    left = [(r.doc_id, low(r.text)) for r in exact.collect()]
    want = [i for (i, _), c in zip(left, linked(left, 80)) if i == c]
    near = common.materialise(stages["near_dedup"](spark, exact, ""), "pipeline-test")
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.collect()) == sorted(want)
    data = {r.doc_id: (r.text or "").encode() for r in near.collect()}
    seen = Counter(d[k : k + 200] for d in data.values() for k in range(len(d) - 199))
    cut = stages["suffix_dedup"](spark, near, "")
    for r in cut.collect():
        d, cover = data[r.doc_id], bytearray(len(data[r.doc_id]))
        for k in range(len(d) - 199):
            if seen[d[k : k + 200]] > 1:
                cover[k : k + 200] = b"\1" * 200
        kept = [d[a:b].decode("utf-8", "ignore") for a, b in parts(cover)]
        assert (r.text or "") == "".join(kept)
    kept = {r.doc_id for r in stages["language_id"](spark, docs, "").collect()}
    model = language_id.train(docs)
    rejected = language_id.Scorer(model).predict([r.text for r in every])[3]
    assert kept == {r.doc_id for r, x in zip(every, rejected) if not x}
    packed_as_the_library_encodes(cut.collect(), stages["packing"](spark, cut, "").collect())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0, name


def packed_as_the_library_encodes(docs, pieces):
    """Each document's ids are in its pieces once and in order, and sequences have no gaps and a power of two of ids."""
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert sorted(by_doc) == sorted(r.doc_id for r in docs)
    for r in docs:
        ids, at = plain.encode(r.text or "", add_special_tokens=False).ids + [2], 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == held[0].seq_tokens <= 4096 and at & (at - 1) == 0


def parts(cover):
    """The ranges that are not covered."""
    at, out = 0, []
    for k in range(len(cover) + 1):
        if k == len(cover) or cover[k]:
            if at < k:
                out.append((at, k))
            at = k + 1
    return out
