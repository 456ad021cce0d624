"""A report on raw CSV files: what breaks their contracts, file by file, with a few examples.

Files are read permissively, so what is wrong with a line is a row of the report and no exception. A record is a line;
files that need line breaks inside quotes must be rewritten first.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.sources.contracts import Contract
from marketloom.sources.scans import _invalid, _typed

_LINE = "_line"
ISSUES = "file string, code string, field string, example string, n long"
EXAMPLES = 5
#: The codes of references, by child table and parent.
NOT_FOUND = {
    ("purchases", "clients"): "purchase_client_not_found",
    ("purchases", "products"): "purchase_product_not_found",
    ("uplift_train", "clients"): "uplift_client_not_found",
    ("uplift_test", "clients"): "uplift_client_not_found",
}


def header(spark: SparkSession, path: str) -> list[str] | None:
    """The column names in the first line of a file or folder; None if there is none of that name."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def raw_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All lines as strings, a short one with nulls, and ``_line`` where a line has another number of values than the header."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _LINE]])
    # Pruned columns would leave the parser without the number of values.
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "columnPruning": False}
    return spark.read.schema(schema).options(**options).csv(path)


def _too_long(columns: list[str]) -> Column:
    """Whether a line has more values than the header: separators outside quotes are counted."""
    bare = F.regexp_replace(F.col(_LINE), '"(?:[^"]|"")*"', "")
    return F.col(_LINE).isNotNull() & (F.length(bare) - F.length(F.replace(bare, F.lit(","))) >= len(columns))


def line_issues(raw: DataFrame, contract: Contract) -> DataFrame:
    """Malformed rows, empty required values and values that the contract does not allow: code, field, example."""
    columns = [c for c in raw.columns if c != _LINE]
    found = [F.when(_too_long(columns), F.struct(F.lit("malformed_row").alias("code"), F.lit("").alias("field"), F.col(_LINE).alias("example")))]
    key = F.concat_ws("|", *(contract.primary_key or contract.columns[:2]))
    for f in contract.fields:
        text = F.nullif(F.trim(F.col(f.name)), F.lit(""))
        if not f.nullable:
            found.append(F.when(text.isNull(), F.struct(F.lit("null_required_value").alias("code"), F.lit(f.name).alias("field"), key.alias("example"))))
        wrong = text.isNotNull() & F.coalesce(_invalid(f, _typed(f)), F.lit(False))
        found.append(F.when(wrong, F.struct(F.lit("invalid_value").alias("code"), F.lit(f.name).alias("field"), text.alias("example"))))
    each = F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("i")
    return raw.select(each).select("i.code", "i.field", "i.example")


def _key(contract: Contract, columns: tuple[str, ...]) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.trim(F.col(c)), F.lit("")) for c in columns))


def repeated_keys(raw: DataFrame, contract: Contract) -> DataFrame:
    """Primary keys that come again: example, n (rows beyond the first)."""
    keys = raw.groupBy(_key(contract, contract.primary_key).alias("example")).agg(F.count(F.lit(1)).alias("n"))
    return keys.where("n > 1").select("example", F.col("n") - 1)


def lost_references(raw: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Values that the parent file has not; empty ones refer to nothing: example, n."""
    values = raw.select(F.trim(F.col(child_col)).alias("example")).where("example <> ''").groupBy("example").agg(F.count(F.lit(1)).alias("n"))
    return values.join(parent.select(F.trim(F.col(parent_col)).alias("example")).distinct(), "example", "left_anti")


def file_profile(raw: DataFrame, contract: Contract, cutoff: datetime | None) -> DataFrame:
    """A row per field, in one pass: n_rows, n_null, the range of valid times, rows before the cutoff and from it on."""
    aggs, times = [F.count(F.lit(1)).alias("_n")], [f.name for f in contract.fields if f.kind == "timestamp"]
    for f in contract.fields:
        aggs.append(F.count_if(F.nullif(F.trim(F.col(f.name)), F.lit("")).isNull()).alias(f"_null_{f.name}"))
        if f.name in times:
            at = _typed(f)
            aggs += [F.min(at).alias(f"_low_{f.name}"), F.max(at).alias(f"_high_{f.name}")]
            if cutoff is not None:
                aggs += [F.count_if(at < F.lit(cutoff)).alias(f"_before_{f.name}"), F.count_if(at >= F.lit(cutoff)).alias(f"_after_{f.name}")]
    kinds = {"low": "timestamp", "high": "timestamp", "before": "long", "after": "long"}
    known = {f"_{k}_{c}" for c in times for k in kinds if cutoff is not None or k in ("low", "high")}
    rows = [
        F.struct(
            F.lit(contract.name).alias("file"), F.lit(f.name).alias("field"), F.col("_n").alias("n_rows"), F.col(f"_null_{f.name}").alias("n_null"),
            *((F.col(f"_{k}_{f.name}") if f"_{k}_{f.name}" in known else F.lit(None)).cast(kind).alias(k) for k, kind in kinds.items()),
        )
        for f in contract.fields
    ]
    return raw.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumnsRenamed({"before": "rows_before", "after": "rows_after"})


def raw_file_report(
    spark: SparkSession, files: Mapping[str, str], contracts: Mapping[str, Contract], cutoff: datetime | None = None, leaking: tuple[str, str] | None = None, examples: int = EXAMPLES
) -> tuple[DataFrame, DataFrame]:
    """Issues and profile of the files (path by name of the contract).

    Issues: file, code, field, n_issues, examples (the smallest few, different ones). Codes: missing_file, missing_column, empty_file, malformed_row (more
    values than the header), null_required_value, invalid_value, duplicate_primary_key (each row beyond the first), ``NOT_FOUND``
    (not judged while the parent file can't be read), and feature_leakage, asked for by the (file, time column)
    ``leaking``: rows on or after the cutoff. A file that is missing or lacks a column is not read any further.
    Each file is read once for each kind of question, never whole on the driver.
    """
    found: list[DataFrame] = []
    profiles: list[DataFrame] = []
    readable: dict[str, DataFrame] = {}
    say = lambda file, code, field="": spark.createDataFrame([(file, code, field, None, 1)], ISSUES)
    put = lambda rows, file, code, field: found.append(rows.select(F.lit(file), F.lit(code), F.lit(field), "example", F.col(rows.columns[1])))
    for name, contract in contracts.items():
        columns = header(spark, files[name]) if name in files else None
        if columns is None:
            found.append(say(name, "missing_file"))
            continue
        lost = [c for c in contract.columns if c not in columns]
        found += [say(name, "missing_column", c) for c in lost]
        if lost:
            continue
        readable[name] = raw = raw_lines(spark, files[name], columns)
        profiles.append(file_profile(raw, contract, cutoff))
        if raw.limit(1).isEmpty():
            found.append(say(name, "empty_file"))
            continue
        found.append(line_issues(raw, contract).select(F.lit(name), "code", "field", "example", F.lit(1).cast("long")))
        if contract.primary_key:
            put(repeated_keys(raw, contract), name, "duplicate_primary_key", "|".join(contract.primary_key))
        for (child, *_), parent, (theirs, *_) in contract.references:
            if parent in readable:
                put(lost_references(raw, readable[parent], child, theirs), name, NOT_FOUND.get((name, parent), f"{parent}_not_found"), child)
        if leaking and leaking[0] == name:
            field = next(f for f in contract.fields if f.name == leaking[1])
            late = raw.where(_typed(field) >= F.lit(cutoff)).select(F.trim(F.col(field.name)).alias("example"), F.lit(1).cast("long").alias("n"))
            put(late, name, "feature_leakage", field.name)
    rows = reduce(DataFrame.union, found, spark.createDataFrame([], ISSUES))
    # Equal examples collapse in each task first; only the first few of an issue are ever sorted.
    each = rows.groupBy("file", "code", "field", "example").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("file", "code", "field").orderBy("example"))
    few = rows.where("example IS NOT NULL").select("file", "code", "field", "example").distinct().withColumn("_r", rank).where(F.col("_r") <= examples)
    shown = few.groupBy("file", "code", "field").agg(F.sort_array(F.collect_list("example")).alias("examples"))
    counts = each.groupBy("file", "code", "field").agg(F.sum("n").alias("n_issues"))
    issues = counts.join(shown, ["file", "code", "field"], "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))
    empty = spark.createDataFrame([], "file string, field string, n_rows long, n_null long, low timestamp, high timestamp, rows_before long, rows_after long")
    return issues, reduce(DataFrame.union, profiles, empty)
