"""Line de-duplication by overlapping windows of three lines.

A window is three consecutive lines of one document, compared byte for byte by a
128-bit hash. The first window of each kind, by (id, line number), stays; every
later one covers its three lines, covered positions are merged, and the covered
lines are removed. Only DataFrame functions run.

How it runs: windows are hashed inside the row with array functions, exploded to
short (hash, id, line number) rows, and grouped by hash with a map-side combine,
so a line block that half of the corpus holds costs one row per task. Later
occurrences are found by joining on the hash, a plain equi-join that adaptive
execution can split, and are merged per document.

Defined results: null text counts as empty; a text of fewer than three lines has
no window and stays as it is; windows that overlap inside one document (three
equal lines in a row and a fourth) are later occurrences too; rows with equal ids are told
apart by a key of their text, and lines go from the row they stand in only; rows that repeat id
and text count as one document; rows without an id come first in the order; very long texts are one
array of lines, looked up by position; an empty table gives an empty
result; columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common


def covered_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3
) -> DataFrame:
    """Per document with repeats: doc_id, row (see ``common.text_key``) and the sorted line numbers to remove."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"),
        common.text_key(text_col).alias("row"),
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("_lines"),
    ).where(F.size("_lines") >= window)
    hashes = F.transform(
        F.sequence(F.lit(1), F.size("_lines") - (window - 1)),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("_lines", i, window), "\n"))),
    )
    windows = lines.select("doc_id", "row", F.posexplode(hashes).alias("_pos", "_h"))
    place = F.struct("doc_id", "row", "_pos")
    first = (
        windows.groupBy("_h")
        .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
        .where(F.col("_first") != F.col("_last"))
        .select("_h", "_first")
    )
    later = windows.join(first, "_h").where(~place.eqNullSafe(F.col("_first")))
    spread = later.select(
        "doc_id", "row", F.explode(F.sequence(F.col("_pos"), F.col("_pos") + (window - 1))).alias("_line")
    )
    return spread.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("_line")).alias("covered"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3
) -> DataFrame:
    """One row per document: doc_id, kept_text, n_lines, n_removed, removed_lines."""
    covered = covered_lines(docs, id_col, text_col, window)
    covered = covered.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "covered")
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        common.text_key(text_col).alias("row"),
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("_lines"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))
    none = F.array().cast("array<int>")
    joined = base.join(covered, same, "left").withColumn("covered", F.coalesce("covered", none))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("covered"))
    kept = F.when(F.size("covered") == 0, F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    )
    return joined.select(
        "doc_id",
        kept.alias("kept_text"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size("covered").cast("bigint").alias("n_removed"),
        F.col("covered").alias("removed_lines"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(common.table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP5_SQL = """
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(ls) - 1)) AS pos, ls FROM lines WHERE len(ls) >= 3),
hashed AS (
  SELECT doc_id, pos, md5(ls[pos] || chr(10) || ls[pos + 1] || chr(10) || ls[pos + 2]) AS h FROM windows),
ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS rn FROM hashed),
covered AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM ranked WHERE rn > 1) x GROUP BY doc_id)
SELECT l.doc_id, CAST(len(ls) AS BIGINT) AS n_lines,
       CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN ps IS NULL THEN array_to_string(ls, chr(10))
         ELSE coalesce(array_to_string(
           list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(ps, i)), lambda i: ls[i]),
           chr(10)), '') END) AS kept_sha256
FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id
"""
