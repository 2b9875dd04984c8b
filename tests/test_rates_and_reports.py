"""Rates given as columns, keyed reports, filled prices and expanded counts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from greenledger import session
from greenledger.operators.calendar import week_grid
from greenledger.operators.densify import densify_mean
from greenledger.operators.rollup import expand_counts, join_price
from greenledger.operators import quality
from greenledger.plans import feasibility, jobs, schedule, selection
from greenledger.sources import parameters, schemas
from greenledger.sources.parameters import Scenario, params_table, scenario_table
from greenledger.sources.tables import read_csv

DEMAND = "facility int, crop string, week_id int, demand_lbs double"


def small(spark, sites=1):
    demand = spark.createDataFrame(
        [(f, "arugula", w, 20.0 if w > 4 else 0.0) for f in range(sites) for w in range(1, 9)], DEMAND)
    price = spark.createDataFrame([(w, 0.1) for w in range(1, 9)], "week_id int, price_per_kwh double")
    return demand, price


@pytest.mark.parametrize("field", ["base_wage_per_hour", "overtime_premium_per_hour", "shift_fixed_cost_per_week",
                                   "disposal_cost_per_lb_waste", "shift_labor_reduction_pct"])
def test_a_negative_rate_in_a_column_is_never_optimal(spark, field):
    demand, price = small(spark)
    demand, params = demand.drop("facility"), params_table(spark)
    good = selection.plan_certificate(demand, params, price, Scenario(), 8).first()
    assert good["status"] == "optimal" and good["lower_bound"] is not None
    bad = selection.plan_certificate(demand, params, price, Scenario(**{field: F.lit(-0.5)}), 8).first()
    assert bad["status"] != "optimal" and bad["lower_bound"] is None and bad["gap"] is None


@pytest.mark.parametrize("rate", ["seed_cost_per_tray", "energy_kwh_per_tray_week", "plant_hours_per_tray"])
def test_a_negative_crop_rate_is_never_optimal(spark, rate):
    demand, price = small(spark)
    params = params_table(spark).withColumn(rate, -F.col(rate))
    row = selection.plan_certificate(demand.drop("facility"), params, price, Scenario(), 8).first()
    assert row["status"] != "optimal" and row["lower_bound"] is None


def test_keyed_runs_over_given_tables_write_their_lines(spark, params, tmp_path):
    days = [(f"2026-01-{d:02d}", 1 + (d - 1) // 7, f, "arugula", 5.0 + f) for d in range(1, 29) for f in (1, 2)]
    daily = spark.createDataFrame(days, "date string, week_id int, facility int, crop string, demand_lbs double")
    frames = {
        "demand_daily": daily,
        "prices_energy_daily": daily.select("date", "week_id", "facility", F.lit(0.1).alias("energy_price_per_kwh")),
        "crop_params": params,
        "telemetry_tray_daily": daily.select("date", "week_id", "facility", "crop", F.lit("t").alias("tray_id"),
                                             F.lit(3).alias("stage_age_days"), F.lit(1.0).alias("kwh_used")),
    }
    scen = scenario_table(daily.select("facility").distinct(), Scenario())
    paths = jobs.run_given(spark, frames, str(tmp_path), params, scen, 4, keys=["facility"])
    lines = spark.read.option("header", True).csv(paths["report_lines"]).collect()
    assert len(lines) == 2 * 17 and {r["facility"] for r in lines} == {"1", "2"}
    totals = {r["facility"]: r["line"] for r in lines if "Total demand" in r["line"]}
    assert totals == {"1": "- Total demand (lbs): 168.00", "2": "- Total demand (lbs): 196.00"}
    written = jobs.write_daily(frames, str(tmp_path / "raw"))
    assert set(written) == set(jobs.DAILY) and all(os.path.isdir(p) for p in written.values())


def test_a_filled_price_is_joined_as_it_is(spark):
    some = spark.createDataFrame([(2, 0.2), (3, 0.4)], "week_id int, price_per_kwh double")
    dense = densify_mean(some, week_grid(spark, 5), "price_per_kwh", weeks=5)
    weeks = spark.createDataFrame([(w,) for w in range(1, 6)], "week_id int")
    fast = join_price(weeks, dense, weeks=5)
    slow = join_price(weeks, dense.select("week_id", (F.col("price_per_kwh") + 0).alias("price_per_kwh")), weeks=5)
    rows = sorted(tuple(r) for r in fast.collect())
    assert rows == sorted(tuple(r) for r in slow.collect())
    assert [r[1] for r in rows] == pytest.approx([0.3, 0.2, 0.4, 0.3, 0.3])

    def aggregates(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")

    assert aggregates(fast) < aggregates(slow)
    assert join_price(weeks, dense, weeks=9).count() == 5  # beyond its weeks it is filled again


def test_expanded_counts(spark):
    counts = spark.createDataFrame(
        [("2026-01-05", 1, "kale", 25, 4, 50.0), ("2026-01-06", 1, "kale", 0, 5, 0.0), ("2026-01-06", 1, "basil", 3, 6, 0.0)],
        "date string, week_id int, crop string, active_trays long, stage_age_days int, kwh_used double")
    rows = expand_counts(counts, chunk=10).collect()
    assert len(rows) == 28 == len({r["tray_id"] for r in rows})
    assert {r["kwh_used"] for r in rows if r["crop"] == "kale"} == {2.0}
    assert {r["kwh_used"] for r in rows if r["crop"] == "basil"} == {0.01}
    assert "kale_20260105_00024" in {r["tray_id"] for r in rows}
    assert expand_counts(counts).columns == [f.name for f in schemas.TELEMETRY_ROWS.fields]


def test_planned_demand(spark, params):
    grid = spark.createDataFrame([("kale", w) for w in (4, 5, 6, 7)], "crop string, week_id int")
    trays = spark.createDataFrame([("kale", 5, 3), ("kale", 6, 10)], "crop string, week_id int, trays long")
    got = sorted((r["week_id"], r["demand_trays_est"], round(r["demand_lbs"], 6)) for r in schedule.planned_demand(
        trays, grid, params, 0.9).collect())
    assert got == [(4, 0, 0.0), (5, 0, 0.0), (6, 10, round(10 * 2.10 * 0.95 * 0.9, 6)), (7, 0, 0.0)]


def test_scratch_folders_are_marked_for_removal(spark):
    folder = session.scratch_dir(spark)
    assert os.path.isdir(folder.removeprefix("file:"))
    assert folder != session.scratch_dir(spark)


def test_keyed_checks(spark, params):
    demand, _ = small(spark, 3)
    demand = demand.withColumn("demand_lbs", F.when(
        (F.col("facility") == 1) & (F.col("week_id") == 2), 9.0).otherwise(F.col("demand_lbs")))
    got = {r["facility"]: (r["feasible"], r["issues"]) for r in feasibility.feasibility_only(
        demand, params, Scenario(), keys=["facility"]).collect()}
    assert got == {0: (True, 0), 1: (False, 1), 2: (True, 0)}
    whole = feasibility.feasibility_only(demand.filter("facility = 0").drop("facility"), params, Scenario()).first()
    assert whole["feasible"] and whole["issues"] == 0
    prices = demand.select("facility", F.when(F.col("facility") == 2, 0.0).otherwise(0.1).alias("energy_price_per_kwh"))
    broken = {(r["facility"], r["rule"]): r["violations"] for r in quality.range_violations(
        demand, prices, ["facility"]).collect()}
    assert broken == {**{(f, "demand_not_negative"): 0 for f in range(3)}, (0, "price_positive"): 0,
                      (1, "price_positive"): 0, (2, "price_positive"): 8}
    crops = spark.createDataFrame([(1, "kale"), (1, "fern"), (2, "kale")], "facility int, crop string")
    assert [tuple(r) for r in quality.missing_params(crops, params, ["facility"]).collect()] == [(1, "fern")]
    init = spark.createDataFrame([(1, 0), (2, 3)], "facility int, qty long")
    assert {tuple(r) for r in parameters.has_initial(init, ["facility"]).collect()} == {(1, False), (2, True)}
