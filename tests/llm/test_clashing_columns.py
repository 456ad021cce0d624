"""Extra columns with the names that operators use inside change nothing."""

from __future__ import annotations

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from marketloom.llm import common, exact_dedup, jpeg, line_dedup, near_dedup, packing, piece_sampling, suffix_dedup, token_files  # noqa: E402

NAMES = (
    "ids _group twin start length ids_crc32 doc_tokens sequence_id media payload feature n_bytes _lines lines line place h window path row shard before mask "
    "given data anchor bucket extent node component band key sample k pieces digest keep_id group_size kept whole runs"
).split()
TEXTS = [None, "", "a b c\nd\ne\nf", "one two three four five six seven " * 12, "one two three four five six seven " * 12, "x\ny\nz\nw", "d\ne\nf\ng", "zz " * 90]


def files(spark, docs):
    base = common.fresh_path(spark, "clash")
    return token_files.read_token_files(spark, base, token_files.write_token_files(docs, base, public_tokenizers.path("byte_bpe_50k.json"), length=16))


OPERATORS = {
    "packing": lambda s, d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json"), top=64, least=8),
    "token_files": files,
    "jpeg": lambda s, d: jpeg.media_features(jpeg.to_media(d)),
    "piece_sampling": lambda s, d: piece_sampling.sample_segmentations(d, public_tokenizers.path("piece_bpe_32k.model")),
    "line_dedup": lambda s, d: line_dedup.dedup_lines(d),
    "exact_dedup": lambda s, d: exact_dedup.exact_groups(d),
    "near_dedup": lambda s, d: near_dedup.near_groups(d),
    "suffix_dedup": lambda s, d: suffix_dedup.remove_repeats(d),
}


@pytest.fixture(scope="module")
def tables(spark):
    plain = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    return common.materialise(plain, "clash"), common.materialise(plain.selectExpr("*", *(f"'{n}' as `{n}`" for n in NAMES)), "clash")


@pytest.mark.parametrize("name", list(OPERATORS))
def test_extra_columns(spark, tables, name):
    plain, wide = (OPERATORS[name](spark, t) for t in tables)
    shown = [c for c in plain.columns if c in wide.columns]
    assert set(plain.columns) <= set(wide.columns)
    rows = lambda frame: sorted(map(str, frame.select(*shown).collect()))
    assert rows(plain) == rows(wide)


@pytest.mark.parametrize("cut", [exact_dedup.drop_exact_copies, near_dedup.drop_near_copies, suffix_dedup.without_repeats])
def test_filters_keep_extra_columns(tables, cut):
    out = cut(tables[1])
    assert out.columns == tables[1].columns
    assert {r.path for r in out.select("path").collect()} == {"path"}
