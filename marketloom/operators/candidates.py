"""Candidate items for each client from four sources, and their merge."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.operators.distributed import BUCKET_ROWS, LEAST
from marketloom.operators.features import category_affinity

DIGITS = 9
#: Rows that the four sources give a client at most.
CLIENT_ROWS = 90
SOURCES = ("category_popular", "global_popular", "item_to_item", "repeat_purchase")


def topk_per_group(frame: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark cuts groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return frame.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def _best(frame: DataFrame, k: int) -> DataFrame:
    return topk_per_group(frame, ["client_id"], [F.desc("raw_score"), F.asc("product_id")], k)


def interactions(lines: DataFrame, cutoff: datetime) -> DataFrame:
    seen = lines.groupBy("client_id", "product_id").agg(F.countDistinct("transaction_id").alias("times_bought"), F.max("transaction_datetime").alias("_last"))
    return seen.select("client_id", "product_id", "times_bought", F.datediff(F.lit(cutoff.date()), F.to_date("_last")).alias("days_since_last"))


def decay(days: str, scale: float = 45.0) -> Column:
    return F.exp(-F.col(days) / scale)


def cand_repeat(lines: DataFrame, cutoff: datetime, k: int = 20) -> DataFrame:
    """Items bought before, by how often and how lately."""
    score = F.round(F.log1p("times_bought") * decay("days_since_last"), DIGITS)
    return _best(interactions(lines, cutoff).select("client_id", "product_id", score.alias("raw_score")), k)


def cand_category(lines: DataFrame, items: DataFrame, k: int = 25, categories: int = 2, parts: int | None = None) -> DataFrame:
    """Popular items of the client's first categories.

    The best items of a category are the same for all clients, so each category is
    cut to its first k items before the join. Clients' categories are dealt to ``parts`` partitions, if given: the join
    makes many rows of few, so Spark would gather them for their size.
    """
    first = topk_per_group(category_affinity(lines), ["client_id"], [F.desc("affinity"), F.asc("level_2")], categories)
    popular = topk_per_group(items.select("product_id", "level_2", "unique_buyers"), ["level_2"], [F.desc("unique_buyers"), F.asc("product_id")], k)
    if parts is not None:
        first = first.repartition(parts, "client_id")
    score = F.round(F.col("affinity") * F.log1p("unique_buyers"), DIGITS)
    return _best(first.join(popular, "level_2").select("client_id", "product_id", score.alias("raw_score")), k)


def basket_blocks(baskets: DataFrame, block: int) -> DataFrame:
    """Items of receipts with the join keys in which they meet: a receipt, and two blocks of its items (_lo, _hi).

    A receipt of up to ``block`` items is one block. A larger one is cut by a hash of the item
    (_own is an item's block), and each two blocks are a key, so no key holds a whole large receipt.
    """
    receipt = ["client_id", "transaction_id"]
    large = baskets.groupBy(*receipt).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
    blocks = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1))
    cut = baskets.join(large, receipt, "left").withColumn("_m", blocks).withColumn("_own", F.pmod(F.xxhash64("product_id"), "_m"))
    met = cut.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)))
    return met.select(*receipt, "product_id", "_own", F.least("_own", "_other").alias("_lo"), F.greatest("_own", "_other").alias("_hi"))


def basket_cosine(lines: DataFrame, max_basket: int | None = None, block: int = 1000) -> DataFrame:
    """Items in one receipt: co / sqrt(n_a * n_b), in both directions.

    Only pairs a < b are joined, counted and then mirrored, which halves the shuffle.
    Items of large receipts meet block by block, see ``basket_blocks``.
    """
    baskets = lines.select("client_id", "transaction_id", "product_id").distinct()
    if max_basket is not None:
        size = F.count(F.lit(1)).over(Window.partitionBy("client_id", "transaction_id"))
        baskets = baskets.withColumn("_n", size).where(F.col("_n") <= max_basket).drop("_n")
    met = basket_blocks(baskets, block)
    receipts = baskets.groupBy("product_id").agg(F.count(F.lit(1)).alias("_receipts"))
    a, b = met.withColumnsRenamed({"product_id": "a", "_own": "_ka"}), met.withColumnsRenamed({"product_id": "b", "_own": "_kb"})
    # Items of one block meet in the key of this block alone.
    pairs = a.join(b, ["client_id", "transaction_id", "_lo", "_hi"]).where("a < b AND (_lo = _hi OR _ka <> _kb)").groupBy("a", "b").agg(F.count(F.lit(1)).alias("co_receipts"))
    named = lambda x: receipts.select(F.col("product_id").alias(x), F.col("_receipts").alias(f"_n{x}"))
    scored = pairs.join(named("a"), "a").join(named("b"), "b").withColumn("similarity", F.col("co_receipts") / F.sqrt(F.col("_na") * F.col("_nb")))
    both = F.explode(F.array(F.struct(F.col("a").alias("s"), F.col("b").alias("p")), F.struct(F.col("b").alias("s"), F.col("a").alias("p"))))
    return scored.select(both.alias("d"), "co_receipts", "similarity").select(F.col("d.s").alias("seed_product_id"), F.col("d.p").alias("product_id"), "co_receipts", "similarity")


def cand_item_to_item(lines: DataFrame, cutoff: datetime, k: int = 25, neighbours: int = 20) -> DataFrame:
    """Neighbours of the items a client bought, summed with decay."""
    near = topk_per_group(basket_cosine(lines), ["seed_product_id"], [F.desc("similarity"), F.asc("product_id")], neighbours)
    seeds = interactions(lines, cutoff).select("client_id", F.col("product_id").alias("seed_product_id"), "days_since_last")
    # Terms become whole billionths, so their sum does not depend on the order.
    unit = 10.0**DIGITS
    term = F.round(F.round(F.col("similarity") * decay("days_since_last"), DIGITS) * unit).cast("long")
    return _best(seeds.join(near, "seed_product_id").groupBy("client_id", "product_id").agg((F.sum(term) / unit).alias("raw_score")), k)


def topk_global(items: DataFrame, k: int = 20) -> DataFrame:
    """The most popular unrestricted items."""
    return items.where("is_alcohol = 0").orderBy(F.desc("unique_buyers"), F.desc("total_sales_qty"), "product_id").limit(k)


def cand_global(clients: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The same k items for everyone; k bounds what is broadcast."""
    top = topk_global(items, k).select("product_id", F.round(F.log1p("unique_buyers"), DIGITS).alias("raw_score"))
    return clients.select("client_id").join(F.broadcast(top), how="cross")


def normalise_source(frame: DataFrame, source: str | None = None, facts: Sequence[str] = ()) -> DataFrame:
    """percent_rank of the score within the client; 1 for a single row.

    Without ``source`` the frame names its sources in ``candidate_source``, and each is ranked for itself. Columns named as facts are kept.
    """
    named = frame if source is None else frame.withColumn("candidate_source", F.lit(source))
    mine = Window.partitionBy("client_id", *(["candidate_source"] if source is None else []))
    norm = F.when(F.count(F.lit(1)).over(mine) == 1, 1.0).otherwise(F.percent_rank().over(mine.orderBy("raw_score")))
    return named.select("client_id", "product_id", norm.alias("normalized_score"), "candidate_source", *facts)


def source_merge(sources: DataFrame, names: Sequence[str] = SOURCES, facts: Sequence[str] = ()) -> DataFrame:
    """Per pair: its sources in order of name, the best score, and a bonus for each further source.

    A flag per name is kept while rows are grouped; a source that is not among the names is an error. With facts, a row without a source
    tells only these of its pair (the largest of each is kept), and makes it no candidate.
    """
    source = F.col("candidate_source")
    known = F.when(source.isin(*names), F.col("normalized_score"))
    if facts:
        known = known.when(source.isNull(), F.lit(None).cast("double"))
    known = known.otherwise(F.raise_error(F.concat(F.lit("unknown source: "), source)))
    flags = {n: F.max(source == n).alias(f"_is_{n}") for n in sorted(names)}
    named = F.array_compact(F.array(*(F.when(F.col(f"_is_{n}"), n) for n in flags)))
    merged = (
        sources.groupBy("client_id", "product_id")
        .agg(F.max(known).alias("best_source_score"), *flags.values(), *(F.max(c).alias(c) for c in facts))
        .select("client_id", "product_id", named.alias("candidate_sources"), "best_source_score", *facts)
        .withColumn("recsys_score", F.round(F.col("best_source_score") + 0.05 * (F.size("candidate_sources") - 1), DIGITS))
    )
    return merged.where(F.size("candidate_sources") > 0) if facts else merged


def _facts(frame: DataFrame | None) -> list[str]:
    return [] if frame is None else [c for c in frame.columns if c not in ("client_id", "product_id")]


def normalised_sources(clients: DataFrame, items: DataFrame, lines: DataFrame, cutoff: datetime, facts: DataFrame | None = None) -> DataFrame:
    """All candidates of the four sources with their scores within the client.

    Cut to their first rows, the sources are dealt by client once; ranks, the merge and the
    order of a client's candidates then need no further shuffle. Facts about pairs are dealt with them, see ``source_merge``.
    """
    # The partitions follow the clients, so what a task sorts does not grow with them.
    parts = max(LEAST, -(-clients.count() * CLIENT_ROWS // BUCKET_ROWS))
    found = {
        "repeat_purchase": cand_repeat(lines, cutoff),
        "category_popular": cand_category(lines, items, 25, 2, parts),
        "item_to_item": cand_item_to_item(lines, cutoff),
        # All clients may be in one small file, which one task would multiply.
        "global_popular": cand_global(clients.select("client_id").repartition(parts), items),
    }
    named = [frame.select("client_id", "product_id", "raw_score", F.lit(name).alias("candidate_source")) for name, frame in found.items()]
    rows = reduce(DataFrame.unionByName, named)
    if facts is not None:
        rows = rows.unionByName(facts, allowMissingColumns=True)
    return normalise_source(rows.repartition(parts, "client_id"), facts=_facts(facts))


def candidates_top50(clients: DataFrame, items: DataFrame, lines: DataFrame, cutoff: datetime, k: int = 50, facts: DataFrame | None = None) -> DataFrame:
    """The first k candidates of every client.

    ``facts`` has client_id, product_id and more columns, which are added to the candidates, null where nothing is told of a pair.
    """
    rank = F.row_number().over(Window.partitionBy("client_id").orderBy(F.desc("recsys_score"), "product_id"))
    found = source_merge(normalised_sources(clients, items, lines, cutoff, facts), facts=_facts(facts))
    return found.withColumn("candidate_rank", rank).where(F.col("candidate_rank") <= k)
