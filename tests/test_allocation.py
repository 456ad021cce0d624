"""The budget allocation in phases against a plain loop: pairs that overflow one by one, random cases, ties and free rows."""

from __future__ import annotations

import os
import random
from decimal import Decimal

import pytest

from marketloom.operators import distributed
from marketloom.sources.shared import shared_dir

ROWS = "client_id long, product_id long, roi double, incremental_profit double, cost double"


def greedy(rows, budget, cap):
    """Rows in the order of their rank, with the loop's decisions and what is spent after each."""
    spent, held, out = Decimal(0), {}, []
    budget = Decimal(str(budget))
    for r in sorted(rows, key=lambda r: (-r[2], -r[3], r[4], r[0], r[1])):
        cost = Decimal(str(r[4])).quantize(Decimal("0.000001"))
        if held.get(r[0], 0) >= cap:
            d = "USER_CAP_REJECTED"
        elif spent + cost <= budget:
            d, spent, held[r[0]] = "DISCOUNT_ACCEPTED", spent + cost, held.get(r[0], 0) + 1
        else:
            d = "BUDGET_REJECTED"
        out.append((r[0], r[1], d, len(out) + 1, spent))
    return sorted(out)


def allocate(spark, rows, budget, cap, tail):
    out = distributed.budget_allocation(spark.createDataFrame(rows, ROWS), budget, cap, tail=tail)
    return sorted((r.client_id, r.product_id, r.optimizer_decision, r.allocation_rank, Decimal(r.budget_spent_after)) for r in out.collect())


def pairs(n, budget):
    """Pairs of a small cost and nearly all that is left, which needed a round each before."""
    rows, left = [], budget
    for k in range(n):
        rows += [(2 * k, 0, 1000.0 - 2 * k, 1.0, 0.01), (2 * k + 1, 0, 999.0 - 2 * k, 1.0, round(left - 0.005, 6))]
        left = round(left - 0.01, 6)
    return rows


@pytest.mark.parametrize("tail", [0, 20_000])
def test_pairs_need_few_phases(spark, tail, monkeypatch):
    rows = pairs(62, 400.0)
    phases = []
    walk = distributed.running_by_rank
    monkeypatch.setattr(distributed, "running_by_rank", lambda *a, **k: phases.append(1) or walk(*a, **k))
    got = allocate(spark, rows, 400.0, 1, tail)
    assert got == greedy(rows, 400.0, 1)
    assert sum(r[2] == "DISCOUNT_ACCEPTED" for r in got) == 62
    assert len(phases) <= 30


def cases(seed):
    rnd = random.Random(seed)
    kind = rnd.randrange(4)
    cost = {
        0: lambda: float(rnd.randrange(1, 30)),
        1: lambda: round(10 ** rnd.uniform(-6, 2), 6),
        2: lambda: rnd.choice([0.0, 0.0, 1.0, 2.0, 64.0]),
        3: lambda: round(rnd.choice([0.000001, 50.0]) * rnd.randrange(1, 4), 6),
    }[kind]
    n = rnd.randrange(1, 60)
    rows = [(rnd.randrange(rnd.choice([2, 9, 40])), i, float(rnd.randrange(6)), float(rnd.randrange(3)), cost()) for i in range(n)]
    return rows, rnd.choice([0.000001, 1.0, 64.0, 100.0, 5000.0]), rnd.choice([1, 2, 5])


@pytest.mark.parametrize("seed", range(12))
def test_phases_equal_the_loop(spark, seed):
    rows, budget, cap = cases(seed)
    assert allocate(spark, rows, budget, cap, 0) == greedy(rows, budget, cap)


def test_tail_equals_the_loop_on_many_cases(spark):
    """A thousand cases side by side: the last task of each is the same function on its own rows."""
    import pandas as pd

    for seed in range(1000):
        rows, budget, cap = cases(1000 + seed)
        order = sorted(rows, key=lambda r: (-r[2], -r[3], r[4], r[0], r[1]))
        frame = pd.DataFrame([(k + 1, r[0], Decimal(str(r[4])).quantize(Decimal("0.000001")), 0) for k, r in enumerate(order)], columns=["allocation_rank", "client_id", "cost", "held"])
        got = distributed.settled(frame, Decimal(str(budget)), cap)
        want = [(r[0], r[1]) for r in greedy(rows, budget, cap) if r[2] == "DISCOUNT_ACCEPTED"]
        assert sorted((order[k - 1][0], order[k - 1][1]) for k in got["allocation_rank"]) == want


def plain_phases(rows, budget, cap):
    """The phases in plain Python, with their number."""
    unit = Decimal("0.000001")
    ranked = [(k, r[0], Decimal(str(r[4])).quantize(unit)) for k, r in enumerate(sorted(rows, key=lambda r: (-r[2], -r[3], r[4], r[0], r[1])))]
    spare, held, taken, left, n = Decimal(str(budget)), {}, [], ranked, 0
    while left := [r for r in left if r[2] <= spare and held.get(r[1], 0) < cap]:
        n += 1
        bound = min((spare / 2).quantize(unit, "ROUND_FLOOR"), max(r[2] for r in left))
        spent, end = Decimal(0), None
        for k, client, cost in left:
            if held.get(client, 0) >= cap:
                continue
            if cost <= bound:
                spent += cost
            elif cost > spare - spent:
                continue
            else:
                spent, end = spent + cost, k
            held[client] = held.get(client, 0) + 1
            taken.append(k)
            if end is None and spent > 0 and spare - spent <= bound:
                end = k
            if end is not None:
                break
        spare -= spent
        if end is None:
            break
        left = [r for r in left if r[0] > end]
    return taken, n


def test_number_of_phases_follows_the_budget_alone():
    for seed in range(1000):
        rows, budget, cap = cases(seed)
        order = sorted(rows, key=lambda r: (-r[2], -r[3], r[4], r[0], r[1]))
        taken, n = plain_phases(rows, budget, cap)
        want = [(r[0], r[1]) for r in greedy(rows, budget, cap) if r[2] == "DISCOUNT_ACCEPTED"]
        assert sorted((order[k][0], order[k][1]) for k in taken) == want
        assert n <= (int(budget * 1_000_000)).bit_length() + 2


def test_stored_tables_are_deleted(spark):
    at = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    rows, budget, cap = pairs(20, 400.0), 400.0, 1
    allocate(spark, rows, budget, cap, 0)
    # What the result itself reads: the ranked rows and the accepted ones.
    assert len(set(os.listdir(at)) - before) == 2
