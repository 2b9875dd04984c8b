"""Labor-aware schedules and proofs against every plan of small instances."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from greenledger.plans import labor, ledger, schedule, selection
from greenledger.sources.parameters import CropParam, Scenario, params_table, scenario_table

DEMAND = "facility int, crop string, week_id int, demand_lbs double"
PRICE = "week_id int, price_per_kwh double"
ONE = (CropParam("a", 1, 3, 1.0, 0.0, 1.0, 0.5, 1.0, 0.5, 1.0),)
TWO = (CropParam("a", 1, 3, 1.0, 0.0, 1.0, 0.5, 1.0, 0.5, 1.0),
       CropParam("b", 2, 3, 1.0, 0.0, 1.0, 0.25, 1.0, 0.5, 1.0))
MIXED = (CropParam("a", 1, 2, 1.0, 0.0, 1.0, 0.5, 1.0, 0.5, 1.0),
         CropParam("b", 1, 3, 1.0, 0.0, 2.5, 0.25, 1.0, 0.5, 1.0))
WEEKS = 7
REDUCTION, BLOCK = 0.2, 1.0


def instances(crops, n, seed):
    """(facility, demand {(crop, week): trays}, base hours, rack)."""
    rng = random.Random(seed)
    out = []
    for f in range(n):
        demand = {(c.crop, w): rng.choice((0, 0, 1, 2, 3)) for c in crops for w in range(1, WEEKS + 1)
                  if w > c.g_min_weeks}
        out.append((f, demand, rng.choice((1.0, 1.5, 2.0, 2.5, 3.0, 4.0)), rng.choice((4, 7, 99))))
    return out


def fits(crops, demand, base, rack=10**9):
    """Whether some choice of planting weeks fits the labor of every week (and the racks)."""
    by = {c.crop: c for c in crops}
    room = {w: base + BLOCK - sum(n * by[c].harvest_hours_per_tray * (1 - REDUCTION)
                                  for (c, h), n in demand.items() if h == w) for w in range(0, WEEKS + 1)}
    if any(room[w] < -1e-6 for w in range(1, WEEKS + 1)):
        return False
    trays = [(c, h) for (c, h), n in sorted(demand.items(), key=lambda x: (x[0][1], x[0][0])) for _ in range(n)]
    seen = set()

    def place(k, left, stock):
        if k == len(trays):
            return True
        if (k, left, stock) in seen:
            return False
        seen.add((k, left, stock))
        c, h = trays[k]
        for p in range(max(1, h - by[c].g_max_weeks), h - by[c].g_min_weeks + 1):
            rest = left[p - 1] - by[c].plant_hours_per_tray
            full = tuple(s + (p <= w + 1 < h) for w, s in enumerate(stock))
            if rest >= -1e-6 and max(full) <= rack:
                if place(k + 1, left[: p - 1] + (round(rest, 9),) + left[p:], full):
                    return True
        return False

    return place(0, tuple(round(room[w], 9) for w in range(1, WEEKS + 1)), (0,) * WEEKS)


def tables(spark, crops, cases):
    params = params_table(spark, crops)
    demand = spark.createDataFrame(
        [(f, c.crop, w, float(d.get((c.crop, w), 0))) for f, d, _, _ in cases for c in crops
         for w in range(1, WEEKS + 1)], DEMAND)
    sites = spark.createDataFrame([(f, base, float(rack)) for f, _, base, rack in cases],
                                  "facility int, base double, rack double")
    scen = scenario_table(
        sites, Scenario(shift_labor_reduction_pct=REDUCTION, overtime_block_hours=(BLOCK,)),
        base_labor_hours_per_week=F.col("base"), rack_capacity_trays_per_week=F.col("rack"),
        base_process_capacity_trays_per_week=F.lit(999.0)).drop("base", "rack")
    price = spark.createDataFrame([(w, 0.1) for w in range(1, WEEKS + 1)], PRICE)
    return params, demand, scen, price


@pytest.mark.parametrize("crops, exact", [(ONE, True), (TWO, True), (MIXED, False)])
def test_certificate_against_every_plan(spark, crops, exact):
    cases = instances(crops, 120, len(crops) + exact)
    params, demand, scen, price = tables(spark, crops, cases)
    got = {r["facility"]: r for r in labor.labor_certificate(
        demand, params, price, scen, WEEKS, ["facility"]).collect()}
    before = {r["facility"]: r for r in selection.plan_certificate(
        demand, params, price, scen, WEEKS, ["facility"]).collect()}
    seen = {"moved": 0, "refuted": 0, "open": 0}
    for f, d, base, rack in cases:
        if not any(d.values()):
            continue
        possible = fits(crops, d, base, rack)
        row, old = got[f], before[f]
        if row["status"] == "infeasible_proven":
            assert not possible
        elif row["status"] in ("optimal", "feasible_gap"):
            assert possible and row["total_cost"] >= row["lower_bound"] - 1e-6
        else:
            assert row["status"] == "undecided"
            seen["open"] += 1
            # The racks, or whole trays of unequal hours, may leave a case open; labor alone never does.
            assert not exact or rack < 99
        if old["status"] != "undecided":
            assert row["status"] == old["status"]
            assert row["total_cost"] is None or row["total_cost"] == pytest.approx(old["total_cost"])
        elif possible and exact:
            assert row["plan"] == "labor_schedule"
            seen["moved"] += 1
        seen["refuted"] += old["status"] == "undecided" and row["status"] == "infeasible_proven"
    assert seen["moved"] > 3 or not exact
    assert seen["refuted"] > 3


def test_no_plan_that_fits_has_less_stock(spark):
    cases = [(f, d, base, 99) for f, d, base, _ in instances(ONE, 60, 5) if any(d.values())]
    params, demand, scen, _ = tables(spark, ONE, cases)
    plan = labor.labor_schedule(demand, params, scen, ["facility"])
    stock = {}
    for r in ledger.occupancy(plan, WEEKS, ["facility"]).collect():
        stock[r["facility"], r["week_id"]] = r["trays_in_stock"]
    for f, d, base, _ in cases:
        most = max([stock.get((f, w), 0) for w in range(1, WEEKS + 1)])
        if fits(ONE, d, base):
            assert most == 0 or not fits(ONE, d, base, most - 1)


def test_intervals_equal_all_runs_of_weeks(spark):
    cases = [c for c in instances(MIXED, 40, 8) if any(c[1].values())]
    params, demand, scen, _ = tables(spark, MIXED, cases)
    got = {(r["facility"], r["last_week"]): r for r in labor.labor_intervals(
        demand, params, scen, ["facility"]).collect()}
    by = {c.crop: c for c in MIXED}
    for f, d, base, _ in cases:
        last = max(w for (f2, w) in got if f2 == f)
        room = {w: base + BLOCK - sum(n * by[c].harvest_hours_per_tray * (1 - REDUCTION)
                                      for (c, h), n in d.items() if h == w) for w in range(1, last + 1)}
        used = {by[c].plant_hours_per_tray for (c, h), n in d.items() if n}
        if len(used) == 1:  # equal trays: whole ones only
            tray, = used
            room = {w: math.floor((v + 1e-6) / tray) * tray for w, v in room.items()}
        for j in range(1, last + 1):
            want = max(sum(n * by[c].plant_hours_per_tray for (c, h), n in d.items()
                           if max(1, h - by[c].g_max_weeks) >= i and h - by[c].g_min_weeks <= j)
                       - sum(room[w] for w in range(i, j + 1)) for i in range(1, j + 1))
            assert got[f, j]["excess_hours"] == pytest.approx(want, abs=1e-6)


def test_schedule_without_keys_moves_only_what_must_move(spark):
    params = params_table(spark, ONE)
    demand = spark.createDataFrame([(0, "a", 4, 5.0), (0, "a", 5, 1.0), (0, "a", 9, 2.0)], DEMAND).drop("facility")
    scen = Scenario(base_labor_hours_per_week=2.0, overtime_block_hours=(1.0,), shift_labor_reduction_pct=0.0)
    plan = sorted(tuple(r) for r in labor.labor_schedule(demand, params, scen).collect())
    # Week 3 has room for three plantings, week 4 for none: 2.5 of its 3 hours go to harvest.
    assert plan == [("a", 2, 4, 3), ("a", 3, 4, 2), ("a", 3, 5, 1), ("a", 8, 9, 2)]
    enough = Scenario()
    assert sorted(tuple(r) for r in labor.labor_schedule(demand, params, enough).collect()) == sorted(
        tuple(r) for r in schedule.back_schedule(demand, params).collect())
    assert labor.labor_schedule(demand.limit(0), params, scen).count() == 0
