"""Training tables: temporal observations, samples, splits, comparability."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from marketloom.functions.expressions import ordered_hash
from marketloom.operators.distributed import first_n_by_hash
from marketloom.sources.scans import label_scan
from marketloom.sources.shared import materialise, spread


def column_subset(frame: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """All columns but keys, lineage and others, in their order."""
    excluded = set(excluded)
    return frame.select(*(c for c in frame.columns if c not in excluded))


def validate_cutoffs(cutoffs: list[datetime], label_days: int) -> list[datetime]:
    """Growing cutoffs whose label windows do not overlap."""
    if len(cutoffs) < 2 or sorted(set(cutoffs)) != cutoffs:
        raise ValueError("at least two growing cutoffs are needed")
    if any((b - a).days < label_days for a, b in zip(cutoffs, cutoffs[1:])):
        raise ValueError("label windows overlap")
    return cutoffs


def bought_pairs(purchases: DataFrame, cutoff: datetime, label_days: int) -> DataFrame:
    """Pairs of the window that begins at the cutoff, marked by ``_y``; a pair may come several times."""
    return label_scan(purchases, "transaction_datetime", cutoff, label_days).select("client_id", "product_id", F.lit(1).alias("_y"))


def label_columns(cutoff: datetime, split: str) -> list[Column]:
    """Label, cutoff and split of candidates that are marked where they were bought."""
    return [F.coalesce("_y", F.lit(0)).alias("label"), F.lit(cutoff).cast("timestamp").alias("cutoff"), F.lit(split).alias("split")]


def observation(candidates: DataFrame, purchases: DataFrame, cutoff: datetime, label_days: int, split: str) -> DataFrame:
    """Candidates with the label "bought in the window that begins at the cutoff"."""
    bought = bought_pairs(purchases, cutoff, label_days).distinct()
    return candidates.join(spread(bought), ["client_id", "product_id"], "left").select(*candidates.columns, *label_columns(cutoff, split))


def positives_outside(candidates: DataFrame, purchases: DataFrame, cutoff: datetime, label_days: int) -> DataFrame:
    """Bought pairs of the label window that are no candidates."""
    bought = label_scan(purchases, "transaction_datetime", cutoff, label_days).select("client_id", "product_id").distinct()
    return bought.join(candidates.select("client_id", "product_id"), ["client_id", "product_id"], "left_anti")


def temporal_observations(by_cutoff: dict[datetime, DataFrame], purchases: DataFrame, label_days: int) -> DataFrame:
    """Observations of all cutoffs; the last one is for validation."""
    cutoffs = validate_cutoffs(sorted(by_cutoff), label_days)
    out = None
    for cutoff in cutoffs:
        one = observation(by_cutoff[cutoff], purchases, cutoff, label_days, "validation" if cutoff == cutoffs[-1] else "train")
        out = one if out is None else out.unionByName(one)
    return out


def hash_ordered_sample(frame: DataFrame, keys: list[str], strata: list[str], n: int, seed: int) -> DataFrame:
    """The first n rows of each stratum by a seeded hash of their keys."""
    quotas = frame.select(*strata).distinct().withColumn("quota", F.lit(n))
    return first_n_by_hash(frame, ordered_hash(seed, *keys), quotas, strata)


def negative_sampling(frame: DataFrame, keys: list[str], per_positive: float, seed: int, split: str = "split") -> DataFrame:
    """All positives, and per split ``per_positive`` times as many negatives, by a seeded hash."""
    quotas = frame.groupBy(split).agg(F.ceil(F.count_if(F.col("label") == 1) * F.lit(per_positive)).alias("quota"))
    kept = first_n_by_hash(frame.where("label = 0"), ordered_hash(seed, *keys), quotas, [split]).drop("sample_rank")
    return frame.where("label = 1").unionByName(kept)


def label_quotas(frame: DataFrame, most: int) -> DataFrame:
    """Rows of labels 0 and 1 when at most ``most`` are kept: label, n, quota.

    Label 1 gets its share, rounded half to even, and label 0 the rest, at least one row each; so the
    quotas add up to ``most``, or to all rows if there are fewer.
    """
    if most < 2:
        raise ValueError("both labels need a row")
    n = frame.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1"))
    share = F.bround(F.lit(most) * F.col("n1") / (F.col("n0") + F.col("n1")))
    n = n.withColumn("q1", F.least(F.greatest(share, F.lit(1)), "n1", F.greatest(F.lit(most) - F.least(F.lit(1), "n0"), F.lit(0))))
    n = n.withColumn("q0", F.least(F.lit(most) - F.col("q1"), "n0"))
    # Rows that the other label cannot fill.
    n = n.withColumn("q1", F.least("n1", F.lit(most) - F.col("q0")))
    both = F.array(*(F.struct(F.lit(k).alias("label"), F.col(f"n{k}").alias("n"), F.col(f"q{k}").cast("long").alias("quota")) for k in (0, 1)))
    rows = n.select(F.explode(both).alias("r")).select("r.*").where("n > 0")
    return rows.withColumn("label", F.col("label").cast(frame.schema["label"].dataType))


def stratified_cap(frame: DataFrame, keys: list[str], most: int, seed: int) -> DataFrame:
    """At most ``most`` rows with labels in proportion, by a seeded hash."""
    quotas = label_quotas(frame, most).select("label", "quota")
    return first_n_by_hash(frame, ordered_hash(seed, *keys), quotas, ["label"]).drop("sample_rank")


def stratified_split(frame: DataFrame, key: str, strata: list[str], share: float, seed: int) -> DataFrame:
    """Add ``split``: per stratum of n rows, clamp(round(n * share), 1, n - 1) are for validation."""
    sizes = frame.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    quota = F.least(F.col("_n") - 1, F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(share) + F.lit(0.5))))
    quotas = sizes.select(*strata, quota.cast("long").alias("quota"))
    held = first_n_by_hash(frame, ordered_hash(seed, key), quotas, strata).select(key, F.lit("validation").alias("_s"))
    return frame.join(held, key, "left").withColumn("split", F.coalesce("_s", F.lit("train"))).drop("_s")


def stratum_sizes(frame: DataFrame, strata: list[str]) -> DataFrame:
    """Rows with the size of their stratum, counted with a map-side combine."""
    sizes = frame.groupBy(*strata).agg(F.count(F.lit(1)).alias("stratum_size"))
    return frame.join(sizes, strata)


def uplift_dataset(labels: DataFrame, users: DataFrame, share: float, seed: int) -> DataFrame:
    """Labelled clients with their features and a split; every arm and outcome must occur."""
    joined = labels.join(users, "client_id")
    found = joined.groupBy("treatment", "target").agg(F.count(F.lit(1)).alias("n")).collect()  # four rows
    if len(found) != 4 or min(r["n"] for r in found) < 2:
        raise ValueError("each arm and outcome needs two rows")
    return stratified_split(joined, "client_id", ["treatment", "target"], share, seed)


def _moments(c: str, arm: int) -> list:
    value = F.when(F.col("treatment") == arm, F.col(c))
    return [F.avg(value).alias(f"m{arm}_{c}"), F.var_samp(value).alias(f"v{arm}_{c}"), F.avg(F.when(F.col("treatment") == arm, F.col(c).isNull().cast("int"))).alias(f"x{arm}_{c}")]


def smd_report(frame: DataFrame, columns: list[str], threshold: float = 0.1) -> DataFrame:
    """Standardised mean differences of all numeric columns in one pass, with warnings."""
    wide = frame.agg(*(x for c in columns for arm in (0, 1) for x in _moments(c, arm)))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), *(F.col(f"{k}{arm}_{c}").cast("double").alias(f"{k}{arm}") for k in "mvx" for arm in (0, 1))) for c in columns))
    r = wide.select(F.explode(rows).alias("r")).select("r.*")
    pooled = (F.coalesce("v0", F.lit(0.0)) + F.coalesce("v1", F.lit(0.0))) / 2
    smd = F.when(pooled > 0, (F.col("m1") - F.col("m0")) / F.sqrt(pooled)).when(F.col("m0") == F.col("m1"), 0.0)
    r = r.withColumn("smd", F.round(smd, 9))
    warning = F.when(F.col("smd").isNull(), "SMD_UNDEFINED").when(F.abs("smd") > threshold, "SMD_ABOVE_THRESHOLD")
    return r.select("feature", "smd", warning.alias("warning"), F.round("x0", 9).alias("missing_control"), F.round("x1", 9).alias("missing_treatment"))


def _summaries(long: DataFrame, keys: list[str], counters: int) -> DataFrame:
    """Frequent values of each task: keys, value, low (a count that is not too high), slack (how much too low any count may be).

    A task holds at most ``counters`` values of a key between batches. What would be one too many takes as much from all
    counts as the largest count that goes (a mergeable counter summary). A row with ``slack`` only tells what was taken.
    """
    schema = long.select(*keys, "value", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("slack")).schema

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Counter] = {}
        slack: Counter[tuple] = Counter()
        for batch in batches:
            counts = pa.Table.from_batches([batch]).group_by([*keys, "value"]).aggregate([([], "count_all")])
            for *key, value, n in zip(*(counts.column(c).to_pylist() for c in (*keys, "value", "count_all"))):
                held.setdefault(tuple(key), Counter())[value] += n
            for key, mine in held.items():
                if len(mine) > counters:
                    less = sorted(mine.values(), reverse=True)[counters]
                    slack[key] += less
                    held[key] = Counter({v: n - less for v, n in mine.items() if n > less})
        rows = [(*key, v, n, 0) for key, mine in held.items() for v, n in mine.items()] + [(*key, None, 0, n) for key, n in slack.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], [*keys, "value", "low", "slack"]).cast(to_arrow_schema(schema))

    return long.select(*keys, "value").mapInArrow(summarise, schema)


def frequent_values(long: DataFrame, keys: list[str], n: int, counters: int = 1000) -> DataFrame:
    """The n most frequent values of each key (few) with exact counts: keys, value, n; ties go to the smaller value, nulls last.

    Summaries of bounded size per task give each value a count that is at most ``slack`` too low. Values that can be among the first n are counted
    exactly; so a column with a million values moves those of the summaries only. Where values are so even that the summaries can't tell, all values of
    that key are counted.
    """
    found = _summaries(long, keys, counters).groupBy(*keys, "value").agg(F.sum("low").alias("low"), F.sum("slack").alias("slack"))
    found = materialise(found)
    taken = found.groupBy(*keys).agg(F.sum("slack").alias("_d"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("low")))
    least = found.where("low > 0").withColumn("_r", rank).where(F.col("_r") <= n).groupBy(*keys).agg(F.min("low").alias("_l"), F.count(F.lit(1)).alias("_k"))
    # A value that no summary holds came at most ``_d`` times.
    limits = taken.join(least, keys).withColumn("_sure", (F.col("_d") == 0) | (F.col("_k") == n) & (F.col("_d") < F.col("_l")))
    limits = materialise(limits)
    some = found.where("low > 0").join(limits.where("_sure"), keys).where(F.col("low") + F.col("_d") >= F.col("_l")).select(*keys, "value")
    counted = [_counts(long, keys, some)]
    if not limits.where("NOT _sure").isEmpty():
        counted.append(_counts(long.join(limits.where("NOT _sure").select(*keys), keys, "left_semi"), keys, None))
    order = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return reduce(DataFrame.unionByName, counted).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _counts(long: DataFrame, keys: list[str], some: DataFrame | None) -> DataFrame:
    """Exact counts, of some values or of all."""
    if some is not None:
        wanted = some.select(*(F.col(c).alias(f"_{c}") for c in (*keys, "value")))
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*keys, "value")))
        long = long.join(wanted, same, "left_semi")
    return long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def categorical_top_values(frame: DataFrame, columns: list[str], n: int = 20, counters: int = 1000) -> DataFrame:
    """The n most frequent values per arm and column, with their share."""
    long = frame.select("treatment", *(F.col(c).cast("string").alias(c) for c in columns)).unpivot(["treatment"], columns, "feature", "value")
    totals = long.groupBy("treatment", "feature").agg(F.count(F.lit(1)).alias("_all"))
    ranked = frequent_values(long, ["treatment", "feature"], n, counters).join(totals, ["treatment", "feature"])
    return ranked.select("treatment", "feature", "value", "n", F.round(F.col("n") / F.col("_all"), 9).alias("share"), "rank")


def treatment_balance(frame: DataFrame, age: str, gender: str, value: str) -> DataFrame:
    """Label rate, mean age and share of one gender per arm."""
    return frame.groupBy("treatment").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("target"), 9).alias("target_rate"),
        F.round(F.avg(F.col(age).cast("decimal(18,4)")).cast("double"), 6).alias("age_mean"),
        F.round(F.avg((F.col(gender) == value).cast("int")), 9).alias("gender_share"),
    )


def treatment_differences(frame: DataFrame, age: str, gender: str) -> DataFrame:
    """How the arms differ: measure, value, control, treatment, difference.

    Measures are the label rate, the age (the difference is standardised, null where it does not vary), and the share of each gender.
    """
    arm = lambda k, x: F.when(F.col("treatment") == k, x)
    exact = F.col(age).cast("decimal(18,4)").cast("double")
    wide = frame.agg(
        *(F.avg(arm(k, F.col("target"))).alias(f"t{k}") for k in (0, 1)), *(F.avg(arm(k, exact)).alias(f"m{k}") for k in (0, 1)),
        *(F.coalesce(F.var_samp(arm(k, exact)), F.lit(0.0)).alias(f"v{k}") for k in (0, 1)), *(F.count(arm(k, F.lit(1))).alias(f"n{k}") for k in (0, 1)),
    )
    pooled = F.sqrt((F.col("v0") + F.col("v1")) / 2)
    smd = F.when(pooled > 0, (F.col("m1") - F.col("m0")) / pooled)
    none = F.lit(None).cast("string")
    row = lambda name, a, b, d: F.struct(F.lit(name).alias("measure"), none.alias("value"), a.alias("control"), b.alias("treatment"), d.alias("difference"))
    both = F.array(row("target_rate", F.col("t0"), F.col("t1"), F.col("t1") - F.col("t0")), row("age_smd", F.col("m0"), F.col("m1"), smd))
    first = wide.select(F.explode(both).alias("r")).select("r.*")
    shares = frame.groupBy(F.col(gender).alias("value")).agg(*(F.count(arm(k, F.lit(1))).alias(f"g{k}") for k in (0, 1)))
    shares = shares.join(F.broadcast(wide.select("n0", "n1")), how="cross")  # one row
    rate = lambda k: F.coalesce(F.try_divide(f"g{k}", f"n{k}"), F.lit(0.0))
    second = shares.select(F.lit("gender_share").alias("measure"), F.col("value").cast("string").alias("value"), rate(0).alias("control"), rate(1).alias("treatment"), (rate(1) - rate(0)).alias("difference"))
    return first.unionByName(second)


def uplift_group_rates(frame: DataFrame) -> DataFrame:
    """Rows and label rate per split and arm, and the uplift of the split."""
    rates = frame.groupBy("split").agg(
        *(F.count_if(F.col("treatment") == a).alias(f"n_{a}") for a in (0, 1)),
        *(F.avg(F.when(F.col("treatment") == a, F.col("target"))).alias(f"rate_{a}") for a in (0, 1)),
    )
    return rates.select("split", "n_0", "n_1", F.round("rate_0", 9).alias("rate_0"), F.round("rate_1", 9).alias("rate_1"), F.round(F.col("rate_1") - F.col("rate_0"), 9).alias("uplift"))
