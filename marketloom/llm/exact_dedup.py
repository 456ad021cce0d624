"""Exact de-duplication by a 128-bit content hash with byte comparison.

Two texts are equal when they are identical after lower-casing A-Z. The largest
id of each class of equal texts stays.

How it runs: rows are grouped by ``(md5, normalised text)``. The hash comes
first, and the text in the grouping key makes Spark compare the bytes of rows
that share a hash, so a collision gives two classes, never one. The grouping has
a map-side combine, so a class that holds a third of all rows reaches the
shuffle as one row per task. Each row then finds its class by joining on short
digests only; that is a plain equi-join, whose hot partitions adaptive execution
splits.

Defined results: null text counts as empty; empty texts form one class; very long
texts are grouped whole, one row for each task and class; rows with equal ids are judged each by
its own text, and a row that repeats both id and text is counted in ``group_size`` and shares
the decision of its twin, so both stay or both go; a row without an id goes where a copy has one,
and else stays; an empty table gives an empty result; columns other than
the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, row (see ``common.text_key``), keep_id, group_size, kept, text_sha256."""
    norm = common.ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), common.text_key(text_col).alias("row"), norm.alias("_norm"))
    rows = rows.withColumn("_h", F.unhex(F.md5("_norm")))
    classes = (
        rows.groupBy("_h", "_norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_h", F.unhex(F.sha2("_norm", 256)).alias("_sha"), "keep_id", "group_size")
    )
    members = rows.select("doc_id", "row", "_h", F.unhex(F.sha2("_norm", 256)).alias("_sha"))
    return members.join(classes, ["_h", "_sha"]).select(
        "doc_id",
        "row",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone = exact_groups(docs, id_col, text_col).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("_gone_id"), F.col("row").alias("_gone_row")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("_gone_id")) & (common.text_key(text_col) == F.col("_gone_row"))
    return docs.join(gone, same, "left_anti")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(common.table(spark, sf_dir, "documents")).drop("row")


OP3_SQL = f"""
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}') AS t
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM norm
"""
