"""Whole runs of one site: the four raw tables, the plan, the report."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import synth_tables
from greenledger.plans import jobs, selection
from greenledger.sources import schemas
from greenledger.sources.parameters import Scenario, initial_wip_table
from greenledger.sources.tables import read_csv, read_json, read_table, write_table

WEEKS, SEED, START = 12, 20260225, "2026-01-05"


@pytest.fixture(scope="module", params=["rows", "counts"])
def run(request, spark, params, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("run"))
    paths = synth_tables.run_all(spark, base, params, Scenario(), START, WEEKS, SEED, mode=request.param)
    return request.param, base, paths


def test_raw_tables_have_their_columns_and_ranges(spark, run):
    mode, base, _ = run
    raw = f"{base}/raw"
    expected = {
        "telemetry_tray_daily": schemas.TELEMETRY_ROWS if mode == "rows" else schemas.TELEMETRY_COUNTS,
        "demand_daily": schemas.DEMAND_DAILY,
        "prices_energy_daily": schemas.PRICES_DAILY,
        "crop_params": schemas.CROP_PARAMS,
    }
    for name, schema in expected.items():
        found = {f.name: f.dataType for f in read_table(spark, raw, name).schema.fields}
        assert found == {f.name: f.dataType for f in schema.fields}
    assert read_table(spark, raw, "demand_daily").filter("demand_lbs < 0").count() == 0
    assert read_table(spark, raw, "prices_energy_daily").filter(
        "energy_price_per_kwh <= 0").count() == 0
    assert read_table(spark, raw, "demand_daily").count() == 504


def test_shipped_setting_is_planned_optimally_and_meets_demand(spark, run):
    _, _, paths = run
    summary = spark.read.json(paths["solve_summary"]).first()
    assert summary.feasible and summary.termination_condition == "optimal"
    harvest = read_csv(spark, paths["solution_harvest"], schemas.SOLUTION_HARVEST)
    assert harvest.count() == 72
    assert harvest.filter("produced_lbs + 1e-6 < demand_lbs").count() == 0
    costs = read_json(spark, paths["cost_breakdown"], schemas.COST_BREAKDOWN).first()
    assert summary.objective_value == pytest.approx(costs.total_cost)
    assert sum(list(costs)[:7]) == pytest.approx(costs.total_cost)


def test_no_issue_is_found(spark, run):
    _, _, paths = run
    assert spark.read.option("header", True).csv(paths["issues"]).count() == 0


def test_run_with_initial_stock(spark, params, tmp_path):
    """Stock covers demand that planting cannot reach; optimality is not claimed."""
    weekly, out = str(tmp_path / "weekly"), str(tmp_path / "out")
    demand = spark.createDataFrame([("kale", 2, 19.95), ("kale", 7, 19.95)],
                                   "crop string, week_id int, demand_lbs double")
    price = spark.createDataFrame([(1, 0.1)], "week_id int, price_per_kwh double")
    write_table(demand, weekly, "demand_weekly")
    write_table(price, weekly, "energy_price_weekly")
    init = initial_wip_table(spark, {"kale": {4: 6, 3: 4}})
    paths = jobs.plan_and_write(spark, weekly, out, params, Scenario(), 8, init=init)
    plan = {tuple(r) for r in read_table(spark, out, "plan").select(
        "plant_week", "harvest_week", "trays").collect()}
    assert plan == {(-4, 2, 6), (-3, 2, 4), (2, 7, 10)}
    summary = spark.read.json(paths["solve_summary"]).first()
    assert summary.termination_condition == "feasible" and summary.outputs_dir == out
    planting = read_csv(spark, paths["solution_planting"], schemas.SOLUTION_PLANTING)
    assert planting.agg(F.sum("trays_planted")).first()[0] == 10


def test_outputs_and_report(spark, run):
    _, base, paths = run
    usage = read_csv(spark, paths["utilization_weekly"], schemas.UTILIZATION_WEEKLY)
    assert usage.count() == WEEKS and usage.filter("rack_utilization > 1").count() == 0
    planting = read_csv(spark, paths["solution_planting"], schemas.SOLUTION_PLANTING)
    harvest = read_csv(spark, paths["solution_harvest"], schemas.SOLUTION_HARVEST)
    assert planting.agg(F.sum("trays_planted")).first()[0] == harvest.agg(
        F.sum("trays_harvested")).first()[0]
    report = read_json(spark, paths["report_summary"], schemas.REPORT_SUMMARY).first()
    assert report.weeks == WEEKS and report.num_crops == 6
    demand = read_table(spark, f"{base}/weekly", "demand_weekly")
    assert report.total_demand_lbs == pytest.approx(demand.agg(F.sum("demand_lbs")).first()[0])
    lines = spark.read.option("header", True).csv(paths["report_lines"]).collect()
    assert len(lines) == 17
    assert "- Weeks: 12" in {r.line for r in lines}
    copies = spark.read.option("header", True).csv(f"{base}/weekly/demand_weekly.csv")
    assert copies.count() == demand.count()


def test_objective_does_not_rise_with_more_rack(spark, params, run):
    _, base, _ = run
    demand = read_table(spark, f"{base}/outputs", "demand_dense")
    price = read_table(spark, f"{base}/weekly", "energy_price_weekly")
    knobs = {"rack_capacity_trays_per_week": (1000.0, 1400.0)}
    sweep = selection.scenario_sweep(demand, params, price, Scenario(), knobs, WEEKS)
    low, high = sweep.orderBy(*knobs).collect()
    assert low.feasible and high.feasible
    assert high.total_cost <= low.total_cost + 1e-6
