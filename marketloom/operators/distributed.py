"""Order over whole tables without a window in one partition: ranks, running sums, greedy budgets.

Rows are dealt to range buckets of the sort key; a window orders each bucket; the
totals of the buckets before it, from a tiny aggregate, are added. The number of buckets
follows the number of rows. Bounds are literals from an approximate quantile, so a task
that runs again deals its rows alike. A value of the leading key that fills whole buckets gets
one of its own, and where a second key is given, its rows are dealt further by that, so one
common value does not fill a task. Input is stored first, as it is read for the
bounds, the totals and the windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from decimal import ROUND_FLOOR, Decimal
from functools import reduce
from math import inf, nextafter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.sources.shared import discard, materialise

#: Rows that a bucket should hold, and the bounds of the number of buckets.
BUCKET_ROWS, LEAST, MOST = 500_000, 8, 4096


def _cuts(frame: DataFrame, key: Column, buckets: int) -> list[float]:
    found = frame.select(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], max(10_000, 50 * buckets))).first()[0]
    return sorted(map(float, found or []))


def _place(bounds: list[float], key: Column, chunk: int = 64) -> Column:
    """How many of the sorted bounds are below the key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    below = lambda values: F.array_size(F.filter(values, lambda b: b < key))
    parts = [bounds[i : i + chunk] for i in range(0, len(bounds), chunk)]
    if len(parts) == 1:
        return below(F.array(*map(F.lit, bounds)))
    part = below(F.array(*(F.lit(x[-1]) for x in parts[:-1])))
    return part * chunk + below(F.get(F.array(*(F.array(*map(F.lit, x)) for x in parts)), part))


def with_bucket(frame: DataFrame, lead: str, descending: bool, buckets: int, second: Column | None = None) -> DataFrame:
    """Add ``_bucket``, growing in the order of the numeric key ``lead``, then of ``second`` (ascending).

    Nulls of the leading key come first in a growing order and last in a falling one, in buckets of their own.
    """
    key = (-F.col(lead) if descending else F.col(lead)).cast("double")
    cuts = _cuts(frame, key, buckets)
    # A value that several quantiles hit gets a bucket that holds nothing else.
    common = [v for v, n in Counter(cuts).items() if n > 1]
    bounds = sorted({*cuts, *(nextafter(v, -inf) for v in common)})
    nulls = len(bounds) + 1 if descending else -1
    place = F.when(key.isNull(), nulls).otherwise(_place(bounds, key))
    out = frame.withColumn("_bucket", place.cast("long") * MOST)
    if second is None:
        return out
    alone = F.col("_bucket").isin([nulls * MOST, *(bounds.index(v) * MOST for v in common)])
    tie = second.cast("double")
    inner = sorted(set(_cuts(out.where(alone), tie, min(buckets, MOST // 2))))
    return out.withColumn("_bucket", F.when(alone & tie.isNotNull(), F.col("_bucket") + _place(inner, tie)).otherwise(F.col("_bucket")))


def global_row_number(
    frame: DataFrame, lead: str, order: list[Column], name: str, descending: bool = False, buckets: int | None = None, second: Column | None = None
) -> DataFrame:
    """Number all rows from 1 in the order ``order``, whose first key is the number ``lead``."""
    return running(frame, lead, order, {name: F.lit(1)}, descending, buckets, second)


def running(
    frame: DataFrame, lead: str, order: list[Column], sums: dict[str, Column], descending: bool = False, buckets: int | None = None,
    second: Column | None = None, stored: bool = False, within: Sequence[str] = (),
) -> DataFrame:
    """Running sums over all rows in an order whose first key is the number ``lead``.

    ``second`` is a number that grows along the order among rows of one leading value.
    With ``within`` sums begin anew for each group of these columns (null is a group too); a
    group with most of the rows is spread over the buckets as a whole table is.
    """
    if not stored:
        frame = materialise(frame)
    if buckets is None:
        buckets = max(LEAST, min(MOST, -(-frame.count() // BUCKET_ROWS)))
    dealt = with_bucket(frame, lead, descending, buckets, second)
    totals = dealt.groupBy(*within, "_bucket").agg(*(F.sum(c).alias(f"_t_{n}") for n, c in sums.items()))
    # One row per group and bucket: at most 2 * MOST by the leading key, and MOST / 2 for each of its common values.
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = [F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums]
    inside = Window.partitionBy(*within, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    if within:
        offsets = totals.select(F.col("_bucket").alias("_b"), *(F.col(g).alias(f"_g_{g}") for g in within), *offset)
        same = F.col("_bucket") == F.col("_b")
        for g in within:
            same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        out = local.join(offsets, same).drop("_b", *(f"_g_{g}" for g in within))
    else:
        out = local.join(F.broadcast(totals.coalesce(1).select("_bucket", *offset)), "_bucket")
    return out.withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in sums}).drop("_bucket", *(f"_o_{n}" for n in sums))


def global_percent_rank(frame: DataFrame, value: str, name: str, buckets: int | None = None) -> DataFrame:
    """percent_rank over all rows: equal values first collapse to one row with a count."""
    counts = materialise(frame.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    placed = running(counts, "_v", [F.col("_v")], {"_upto": F.col("_n")}, buckets=buckets, stored=True)
    total = counts.agg(F.sum("_n").alias("_all"))
    ranked = placed.join(F.broadcast(total), how="cross").select(
        "_v", F.when(F.col("_all") <= 1, F.lit(0.0)).otherwise((F.col("_upto") - F.col("_n")) / (F.col("_all") - 1)).alias(name)
    )
    return frame.join(ranked, frame[value].eqNullSafe(ranked["_v"]), "left").drop("_v")


def quantiles(frame: DataFrame, value: str, fractions: Mapping[str, str], within: Sequence[str] = ()) -> DataFrame:
    """Exact discrete quantiles of each group, one column a fraction (decimal text): the least value up to which that share of the rows comes.

    Equal values first collapse to one row with a count, which are summed up along range buckets of the value, so a
    group with most rows fills no task. Null values do not count; without groups there is one row, with nulls if no value is there.
    """
    counts = materialise(frame.where(F.col(value).isNotNull()).groupBy(*within, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    placed = running(counts, "_v", [F.col("_v")], {"_upto": F.col("_n")}, stored=True, within=within)
    sizes = counts.groupBy(*(F.col(g).alias(f"_g_{g}") for g in within)).agg(F.sum("_n").alias("_all"))
    if within:
        out = placed.join(sizes, reduce(Column.__and__, (F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in within)))
    else:
        out = placed.join(F.broadcast(sizes), how="cross")
    reached = lambda q: F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.col("_all") * F.lit(Decimal(q))).cast("long"))
    return out.groupBy(*within).agg(*(F.min(F.when(reached(q), F.col("_v"))).alias(n) for n, q in fractions.items()))


def first_n_by_hash(frame: DataFrame, mark: Column, quotas: DataFrame, strata: list[str], quota: str = "quota") -> DataFrame:
    """The first ``quota`` rows of each stratum in the order of a hash column.

    The rows of a stratum are counted by prefixes of the hash. Only prefixes that begin
    within the quota are ranked, so what is shuffled follows the quotas and not the table,
    and a stratum with most of the rows is spread over its prefixes.
    """
    marked = frame.withColumns({"_h": mark, "_p": F.substring(mark, 1, 3)})
    sizes = marked.groupBy(*strata, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*strata).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    # At most 4096 prefixes per stratum.
    offsets = sizes.withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    wanted = offsets.join(quotas, strata).where(F.col("_o") < F.col(quota))
    rank = F.row_number().over(Window.partitionBy(*strata, "_p").orderBy("_h"))
    ranked = marked.join(wanted, [*strata, "_p"]).withColumn("_r", rank).withColumn("sample_rank", F.col("_r") + F.col("_o"))
    return ranked.where(F.col("sample_rank") <= F.col(quota)).drop("_h", "_p", "_r", "_o", quota)


def running_by_rank(frame: DataFrame, rank: str, sums: dict[str, Column], width: int = BUCKET_ROWS) -> DataFrame:
    """Running sums along a rank that counts rows from 1; buckets are stretches of ranks, so no bounds are looked for.

    ``frame`` is read twice.
    """
    dealt = frame.withColumn("_bucket", F.floor((F.col(rank) - 1) / width).cast("long"))
    totals = dealt.groupBy("_bucket").agg(*(F.sum(c).alias(f"_t_{n}") for n, c in sums.items()))
    # One row for each stretch of ranks.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.coalesce(1).select("_bucket", *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums))
    inside = Window.partitionBy("_bucket").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    out = local.join(offsets, "_bucket").withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in sums})
    return out.drop("_bucket", *(f"_o_{n}" for n in sums))


#: A unit of cost, and the rows that one task may settle alone.
UNIT, TAIL = Decimal("0.000001"), 20_000
_ACCEPTED = "allocation_rank long, client_id {}, cost decimal(20,6)"


def settled(frame: pd.DataFrame, spare: Decimal, cap: int) -> pd.DataFrame:
    """The rows of a frame (allocation_rank, client_id, cost, held) that are accepted one by one."""
    frame, counts, kept = frame.sort_values("allocation_rank"), {}, []
    for k, r in enumerate(frame.itertuples(index=False)):
        count = counts.get(r.client_id, r.held)
        if count < cap and r.cost <= spare:
            spare -= r.cost
            counts[r.client_id] = count + 1
            kept.append(k)
    return frame.iloc[kept][["allocation_rank", "client_id", "cost"]]


def _tail(left: DataFrame, held: DataFrame, spare: Decimal, cap: int) -> DataFrame:
    """The accepted rows among the few that are left, settled in one group of at most ``TAIL`` rows."""
    kind = left.schema["client_id"].dataType.simpleString()
    rows = left.join(held, "client_id", "left").select("allocation_rank", "client_id", "cost", F.coalesce("_held", F.lit(0)).alias("held"), F.lit(0).alias("_one"))
    return rows.groupBy("_one").applyInPandas(lambda frame: settled(frame, spare, cap), _ACCEPTED.format(kind))


def _settle(rows: DataFrame, budget: float, cap: int, lead: str, tail: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``allocation_rank``, and the accepted ones (allocation_rank, client_id, cost), see ``budget_allocation``; both stored."""
    if budget <= 0 or cap <= 0:
        raise ValueError("budget and cap must be positive")
    order = [F.desc("roi"), F.desc("incremental_profit"), F.asc("cost"), F.asc("client_id"), F.asc("product_id")]
    rows = materialise(rows.withColumn("cost", F.col("cost").cast("decimal(20,6)")))
    if rows.where("cost < 0 OR cost IS NULL").limit(1).count():
        raise ValueError("cost must be finite and not negative")
    if lead == "roi":
        placed = running(rows, "roi", order, {"allocation_rank": F.lit(1)}, descending=True, second=-F.col("incremental_profit"), stored=True)
    else:
        placed = running(rows, lead, [F.desc(lead), *order], {"allocation_rank": F.lit(1)}, descending=True, second=-F.col("roi"), stored=True)
    ranked = materialise(placed)
    discard(rows)
    spark, kind = rows.sparkSession, ranked.schema["client_id"].dataType.simpleString()
    accepted = [spark.createDataFrame([], _ACCEPTED.format(kind))]
    left, stored = ranked.select("allocation_rank", "client_id", "cost"), []
    spare = Decimal(str(budget)).quantize(UNIT, ROUND_FLOOR)
    money = lambda x: F.lit(str(x)).cast("decimal(20,6)")
    while True:
        left = left.where(F.col("cost") <= money(spare))
        count, most = left.agg(F.count(F.lit(1)), F.max("cost")).first()
        if not count:
            break
        held = reduce(DataFrame.unionByName, accepted).groupBy("client_id").agg(F.count(F.lit(1)).alias("_held"))
        if count <= tail:
            accepted.append(materialise(_tail(left, held, spare, cap)))
            break
        half = (spare / 2).quantize(UNIT, ROUND_FLOOR)
        bound = min(half, most)
        turn = F.row_number().over(Window.partitionBy("client_id").orderBy("allocation_rank"))
        first = left.where(F.col("cost") <= money(bound)).withColumn("_turn", turn).where(F.col("_turn") <= cap)
        first = first.join(held, "client_id", "left").withColumn("_turn", F.col("_turn") + F.coalesce("_held", F.lit(0))).where(F.col("_turn") <= cap)
        first = materialise(first.select("allocation_rank", "client_id", "cost", "_turn"))
        # Larger rows come before the row with which their client is full.
        full = first.where(F.col("_turn") == cap).select("client_id", F.col("allocation_rank").alias("_full"))
        large = left.where(F.col("cost") > money(bound)).join(full, "client_id", "left").where("_full IS NULL OR allocation_rank < _full")
        small = first.select("allocation_rank", "client_id", "cost", F.lit(True).alias("small"))
        both = small.unionByName(large.select("allocation_rank", "client_id", "cost", F.lit(False).alias("small")))
        walk = materialise(running_by_rank(both, "allocation_rank", {"_sum": F.when(F.col("small"), F.col("cost")).otherwise(money(0))}))
        # Rows that cost nothing end no phase.
        small_ends = F.col("small") & (F.col("_sum") > 0) & (money(spare) - F.col("_sum") <= money(bound))
        large_ends = ~F.col("small") & (F.col("cost") <= money(spare) - F.col("_sum"))
        end = walk.where(small_ends | large_ends).agg(F.min("allocation_rank")).first()[0]
        taken = walk.where("small") if end is None else walk.where((F.col("allocation_rank") < end) & F.col("small") | (F.col("allocation_rank") == end))
        fresh = materialise(taken.select("allocation_rank", "client_id", "cost"))
        accepted.append(fresh)
        if end is None:
            discard(first, walk, *stored)
            break
        spare -= fresh.agg(F.sum("cost")).first()[0] or 0
        done = reduce(DataFrame.unionByName, accepted).groupBy("client_id").agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") >= cap)
        left = left.where((F.col("allocation_rank") > end) & (F.col("cost") <= money(spare))).join(done.select("client_id"), "client_id", "left_anti")
        left = materialise(left)
        discard(first, walk, *stored)
        stored = [left]
    taken = materialise(reduce(DataFrame.unionByName, accepted))
    discard(*accepted[1:])
    return ranked, taken


def accepted_rows(rows: DataFrame, budget: float, cap: int, lead: str = "roi", tail: int = TAIL) -> DataFrame:
    """The rows that ``budget_allocation`` accepts, with their ``allocation_rank``; refused rows are not told apart."""
    ranked, taken = _settle(rows, budget, cap, lead, tail)
    return ranked.join(taken.select("allocation_rank"), "allocation_rank", "left_semi")


def budget_allocation(rows: DataFrame, budget: float, cap: int, lead: str = "roi", tail: int = TAIL) -> DataFrame:
    """Greedy acceptance in the order ROI down, profit down, cost up, ids.

    Another numeric column as ``lead`` goes before that order, descending.
    ``rows`` has client_id, product_id, roi, incremental_profit, cost. Cost is taken as a
    decimal of six places, so running sums are exact. A row whose client has ``cap``
    accepted rows before it is refused for that; a row that does not fit what is left
    of the budget is skipped, and a cheaper later row may still be accepted.

    Rows are settled in phases. With R left of the budget and a bound b of at least R / 2, rows of at
    most b fit as long as more than b would be left, and are refused for their client's count alone. The
    phase ends at the first row after which no more than b is left: a small one, or a larger one that
    still fits, after which less than R - b is left. Each phase is one running sum and the search for that row, and
    decides all rows up to it. Where all costs are below R / 2, b is the largest cost instead, as
    rows fit until less than that is left. So what is left halves, or falls below the largest cost, in each phase,
    and log2(budget / 0.000001) + 2 phases settle everything, whatever the rows. Only rows behind that
    can still fit go on; once they are at most ``tail`` rows, one task settles them.
    """
    ranked, taken = _settle(rows, budget, cap, lead, tail)
    money = lambda x: F.lit(str(x)).cast("decimal(20,6)")
    # A client is full from its last accepted row on, if it has ``cap`` of them.
    full = taken.groupBy("client_id").agg(F.max("allocation_rank").alias("_full"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= cap).select("client_id", "_full")
    out = ranked.join(taken.select("allocation_rank", F.lit(1).alias("_ok")), "allocation_rank", "left").join(full, "client_id", "left")
    out = running_by_rank(out, "allocation_rank", {"budget_spent_after": F.when(F.col("_ok") == 1, F.col("cost")).otherwise(money(0))})
    decision = F.when(F.col("_ok") == 1, "DISCOUNT_ACCEPTED").when(F.col("allocation_rank") > F.col("_full"), "USER_CAP_REJECTED").otherwise("BUDGET_REJECTED")
    return out.select("client_id", "product_id", "cost", "roi", "incremental_profit", decision.alias("optimizer_decision"), "allocation_rank", "budget_spent_after")
