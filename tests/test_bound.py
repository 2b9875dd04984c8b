"""The bound with overtime against the cheapest plan of small instances."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from greenledger.plans import bound, selection
from greenledger.sources.parameters import CropParam, Scenario, params_table, scenario_table

CROP = CropParam("a", 1, 3, 1.0, 0.0, 1.0, 0.4, 1.0, 0.05, 0.1)
WEEKS, BLOCK, PREMIUM, WAGE, FIXED, RED, DISPOSAL = 6, 4.0, 12.0, 10.0, 3.0, 0.25, 0.3


def cheapest(demand, base):
    """The least cost of any plan, by trying every planting week of every tray."""
    trays = [w for w, n in demand.items() for _ in range(n)]
    best = float("inf")
    for ages in itertools.product(range(CROP.g_min_weeks, CROP.g_max_weeks + 1), repeat=len(trays)):
        if any(w - a < 1 for w, a in zip(trays, ages, strict=True)):
            continue
        cost = sum(CROP.seed_cost_per_tray + a * (CROP.nutrient_cost_per_tray_week
                   + 0.2 * CROP.energy_kwh_per_tray_week) for a in ages)
        for w in range(1, WEEKS + 1):
            plant = sum(t - a == w for t, a in zip(trays, ages, strict=True)) * CROP.plant_hours_per_tray
            harvest = demand.get(w, 0) * CROP.harvest_hours_per_tray
            options = []
            for on in (0, 1):
                hours = plant + harvest * (1 - RED * on)
                over = max(0.0, hours - base)
                if over <= BLOCK + 1e-6:
                    options.append(WAGE * hours + PREMIUM * over + FIXED * on)
            cost += min(options, default=float("inf"))
        best = min(best, cost)
    return best


def test_bound_never_exceeds_the_cheapest_plan(spark):
    rng = random.Random(3)
    cases = []
    for f in range(80):
        demand = {w: rng.choice((0, 0, 1, 2, 3)) for w in range(2, WEEKS + 1)}
        while not 1 <= sum(demand.values()) <= 7:
            demand = {w: rng.choice((0, 0, 1, 2, 3)) for w in range(2, WEEKS + 1)}
        cases.append((f, demand, rng.choice((0.5, 1.0, 2.0, 3.0))))
    rows = spark.createDataFrame([(f, "a", w, float(d.get(w, 0))) for f, d, _ in cases for w in range(1, WEEKS + 1)],
                                 "facility int, crop string, week_id int, demand_lbs double")
    sites = spark.createDataFrame([(f, b) for f, _, b in cases], "facility int, base double")
    scen = scenario_table(
        sites, Scenario(overtime_block_hours=(BLOCK,), overtime_premium_per_hour=PREMIUM, base_wage_per_hour=WAGE,
                        shift_fixed_cost_per_week=FIXED, shift_labor_reduction_pct=RED,
                        disposal_cost_per_lb_waste=DISPOSAL),
        base_labor_hours_per_week=F.col("base")).drop("base")
    price = spark.createDataFrame([(w, 0.2) for w in range(1, WEEKS + 1)], "week_id int, price_per_kwh double")
    params = params_table(spark, (CROP,))
    got = {r["facility"]: r for r in bound.overtime_bound(
        rows, params, price, scen, WEEKS, ["facility"]).collect()}
    old = {r["facility"]: r for r in selection.plan_certificate(
        rows, params, price, scen, WEEKS, ["facility"]).collect()}
    before = after = 0.0
    for f, demand, base in cases:
        best = cheapest(demand, base)
        assert got[f]["overtime_bound"] <= best + 1e-6
        assert got[f]["overtime_bound"] >= got[f]["free_overtime_bound"] - 1e-9
        assert got[f]["free_overtime_bound"] == pytest.approx(old[f]["lower_bound"], abs=1e-6)
        if best < float("inf"):
            before += best - got[f]["free_overtime_bound"]
            after += best - got[f]["overtime_bound"]
    assert after < 0.5 * before  # the gap to the cheapest plan shrinks by more than half
