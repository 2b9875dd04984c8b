"""Breakpoints read at any capacity against the plain rating at that capacity."""

from __future__ import annotations

import random

import pytest

from greenledger.plans import breakpoints, capacity
from greenledger.sources.parameters import Scenario

LEDGER = "site int, week_id int, plant_hours double, harvest_hours double, trays_in_stock long"


@pytest.fixture(scope="module")
def ledger(spark):
    rng = random.Random(11)
    return spark.createDataFrame(
        [(s, w, rng.uniform(0, 40), rng.uniform(0, 90), rng.randrange(0, 60)) for s in (1, 2) for w in range(1, 15)],
        LEDGER)


@pytest.mark.parametrize("fixed, premium, reduction", [(60.0, 12.0, 0.2), (400.0, 30.0, 0.3), (5.0, 0.0, 0.1)])
def test_labor_at_any_capacity(spark, ledger, fixed, premium, reduction):
    scen = Scenario(overtime_block_hours=(8.0, 5.0), overtime_premium_per_hour=premium,
                    shift_fixed_cost_per_week=fixed, shift_labor_reduction_pct=reduction)
    found = sorted(tuple(r) for r in breakpoints.labor_breakpoints(ledger, scen, ["site"]).collect())
    rng = random.Random(5)
    for hours in [0.0, 300.0] + [rng.uniform(0, 140) for _ in range(12)]:
        rated = capacity.shift_choice(ledger.select("site", "week_id", "plant_hours", "harvest_hours"),
                                      scen.with_(base_labor_hours_per_week=hours), ["site"])
        for site in (1, 2):
            _, at, cost, slope, over = [r for r in found if r[0] == site and r[1] <= hours][-1]
            rows = [r for r in rated.collect() if r["site"] == site]
            assert cost + slope * (hours - at) == pytest.approx(sum(r["labor_cost"] for r in rows), abs=1e-3)
            assert over == sum(not r["overtime_feasible"] for r in rows)


def test_loads_at_any_capacity(ledger):
    found = sorted(tuple(r) for r in breakpoints.load_breakpoints(ledger, "trays_in_stock", ["site"]).collect())
    loads = [(r["site"], r["trays_in_stock"]) for r in ledger.collect()]
    for cap in range(0, 65):
        for site in (1, 2):
            over = [r for r in found if r[0] == site and r[1] <= cap][-1][2]
            assert over == sum(s == site and n > cap for s, n in loads)
    assert min(r[1] for r in found if r[0] == 1 and r[2] == 0) == max(n for s, n in loads if s == 1)
