"""Policies chosen by prices against the rating of every combination."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from greenledger.plans import costs, policy, selection
from greenledger.sources.parameters import CropParam, Scenario, params_table, scenario_table

DEMAND = "facility int, crop string, week_id int, demand_lbs double"
PRICE = "week_id int, price_per_kwh double"
WEEKS = 10


def crops(n):
    rng = random.Random(n)
    return tuple(CropParam(f"c{k:03d}", 1, 1 + rng.randrange(1, 3), 1.0, 0.0, 1.0 + rng.random(), 0.3,
                           1.0, 0.02, 0.1) for k in range(n))


def tables(spark, kinds, sites, seed, labor=(14, 28), rack=(14, 40)):
    rng = random.Random(seed)
    demand = spark.createDataFrame(
        [(f, c.crop, w, float(rng.choice((0, 1, 2, 3))) if w > c.g_min_weeks else 0.0)
         for f in range(sites) for c in kinds for w in range(1, WEEKS + 1)], DEMAND)
    rows = spark.createDataFrame([(f, float(rng.uniform(*labor)), float(rng.uniform(*rack)))
                                  for f in range(sites)], "facility int, base double, rack double")
    scen = scenario_table(
        rows, Scenario(overtime_block_hours=(2.0, 2.0), overtime_premium_per_hour=30.0,
                       shift_fixed_cost_per_week=8.0),
        base_labor_hours_per_week=F.col("base"), rack_capacity_trays_per_week=F.col("rack"),
        base_process_capacity_trays_per_week=F.lit(9e9)).drop("base", "rack")
    price = spark.createDataFrame([(w, 0.1) for w in range(1, WEEKS + 1)], PRICE)
    return params_table(spark, kinds), demand, scen, price


def test_choice_against_every_combination(spark):
    kinds = crops(5)
    params, demand, scen, price = tables(spark, kinds, 40, 1)
    by = ["facility"]
    best = {r["facility"]: r for r in selection.policy_sweep(demand, params, price, scen, WEEKS, by).collect()}
    choice = policy.policy_choice(demand, params, price, scen, WEEKS, by)
    rows = choice.collect()
    cost = {r["facility"]: r["total_cost"] for r in rows if r["feasible"]}
    assert len(rows) == 40 * 5
    possible = {f for f, r in best.items() if r["feasible_policies"]}
    assert set(cost) <= possible and len(possible) > 10
    assert len(cost) >= 0.9 * len(possible)
    same = sum(cost[f] <= best[f]["best_cost"] + 1e-3 for f in cost)
    assert all(cost[f] >= best[f]["best_cost"] - 1e-3 for f in cost)
    assert same >= 0.8 * len(cost)
    assert sum(cost[f] <= 1.05 * best[f]["best_cost"] for f in cost) >= 0.95 * len(cost)
    # Not all of them leave every crop at its shortest time.
    assert len({r["facility"] for r in rows if r["feasible"] and r["age_offset"]}) > 3
    # The plan is the one that was rated.
    plan = policy.policy_plan(demand, params, choice, by)
    paid = costs.cost_breakdown(costs.evaluate_weeks(plan, demand, params, price, scen, WEEKS, by), by)
    for r in paid.collect():
        if r["facility"] in cost:
            assert r["total_cost"] == pytest.approx(cost[r["facility"]], abs=1e-3)


def test_a_hundred_crops_and_more_rack(spark):
    kinds = crops(100)
    params, demand, _, price = tables(spark, kinds, 1, 7)
    demand = demand.drop("facility")
    base = Scenario(base_labor_hours_per_week=330.0, overtime_block_hours=(40.0, 40.0),
                    base_process_capacity_trays_per_week=9e9)
    paid = []
    for rack in (150.0, 300.0, 900.0):
        choice = policy.policy_choice(demand, params, price, base.with_(rack_capacity_trays_per_week=rack),
                                      WEEKS, rounds=3, passes=1)
        rows = choice.collect()
        assert len(rows) == 100
        paid.append(rows[0]["total_cost"] if rows[0]["feasible"] else float("inf"))
    assert paid[0] >= paid[1] - 1e-6 >= paid[2] - 2e-6 and paid[2] < float("inf")
