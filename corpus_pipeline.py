"""A corpus in five stages: language, exact copies, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; its result is written as
Parquet and read again as the docs of the next one. All stages but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common, exact_dedup, language_id, near_dedup, packing, suffix_dedup


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models know; the rejected ones go.

    Models are learnt from labelled rows of ``docs`` (with ``lang``; rows without are no samples). Null texts and texts
    without a letter, the empty ones among them, are rejected. Very long texts are judged whole. Repeated rows get one judgement each, the same for equal
    texts; ties between languages go to the first in alphabetical order. Without a labelled row nothing is known, and an empty table gives
    no rows. Other columns go along, whatever their names.
    """
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that are equal but for the case of A-Z, the one with the largest id.

    Null and empty texts are one class. Very long texts are compared whole. Rows that repeat id and text both stay
    if theirs is the id that stays; a row without an id stays only where no copy has one. An empty table gives no rows. Other columns go along, whatever their names.
    """
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five words, similarity 0.8 or more), the one with the smallest id.

    Texts without words, null and empty ones, are linked with nothing and stay, as do rows without an id whose shingles no row with an id
    has. Very long texts are read whole. Rows that repeat id and text share one decision; rows that share an id only are judged by
    their own texts. An empty table gives no rows. Other columns go along, whatever their names.
    """
    return near_dedup.drop_near_copies(docs, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the byte strings of 200 bytes and more that start at two places or more.

    Documents stay even if nothing of their text is left; null texts stay null, and texts under 200 bytes are as they were. Very
    long texts are read in parts that overlap. Rows that repeat id and text are copies, and each loses its text. A character that a cut
    divides goes as a whole. An empty table gives no rows. ``n_chars`` is that of the new text; other columns go along, whatever their names.
    """
    cut = suffix_dedup.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of several lengths, see ``packing.PIECES``.

    Null and empty texts give their end id alone. Very long texts are cut into windows. Repeated rows are packed each; ties are ordered by
    id, start and checksum. An empty table gives no pieces. Other columns are not read, whatever their names.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: SQL can express neither the language models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data directory; of the stored stages only the one that the result reads is kept."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        done = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if hasattr(docs, "stored_at"):
            common.discard(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
