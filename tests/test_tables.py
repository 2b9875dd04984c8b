"""Small hand-computed cases of the table operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from greenledger.functions.columns import clamp, trays_needed, week_index
from greenledger.operators import calendar as cal
from greenledger.operators import quality
from greenledger.operators.densify import densify_mean, densify_zero
from greenledger.operators.rollup import (
    rollup_demand,
    rollup_price,
    rollup_telemetry,
    telemetry_mode,
)
from greenledger.session import scratch_dir
from greenledger.sources import parameters as par
from greenledger.sources import schemas, tables

DAILY = "date string, week_id int, crop string, demand_lbs double"


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_week_index_counts_down_before_the_anchor(spark):
    days = ["2026-01-04", "2026-01-05", "2026-01-11", "2026-01-12", "2025-12-28"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    got = {r.d: r.w for r in df.select("d", week_index("d", "2026-01-05").alias("w")).collect()}
    assert got == {"2026-01-04": 0, "2026-01-05": 1, "2026-01-11": 1, "2026-01-12": 2,
                   "2025-12-28": -1}


def test_calendar(spark):
    days = cal.calendar(spark, "2026-01-05", 12).orderBy("date").collect()
    assert len(days) == 84
    assert tuple(days[0]) == ("2026-01-05", 1, 0)
    assert tuple(days[6]) == ("2026-01-11", 1, 6)
    assert tuple(days[-1]) == ("2026-03-29", 12, 6)


def test_clamp_prefers_the_lower_bound(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (99.0,)], "v double")
    assert rows(df.select(clamp(F.col("v"), 0.0, 10.0).alias("v")), "v") == [(0.0,), (5.0,), (10.0,)]
    assert rows(df.select(clamp(F.col("v"), 40.0, 10.0).alias("v")), "v") == [(40.0,)] * 3


def test_trays_needed(spark):
    df = spark.createDataFrame([(0.0, 2.0), (2.0, 2.0), (2.1, 2.0), (3.0, 0.0)], "d double, y double")
    got = [r.n for r in df.select(trays_needed(F.col("d"), F.col("y")).alias("n")).collect()]
    assert got == [0, 1, 2, None]


def test_rollups(spark):
    demand = spark.createDataFrame(
        [("d", 1, "kale", 1.5), ("e", 1, "kale", 2.0), ("f", 2, "kale", 4.0)], DAILY
    )
    assert rows(rollup_demand(demand), "crop", "week_id", "demand_lbs") == [
        ("kale", 1, 3.5), ("kale", 2, 4.0)]
    price = spark.createDataFrame(
        [("d", 1, 0.1), ("e", 1, 0.3)], "date string, week_id int, energy_price_per_kwh double"
    )
    assert rows(rollup_price(price), "week_id", "price_per_kwh") == [(1, pytest.approx(0.2))]


def test_telemetry_modes_weigh_ages_differently(spark):
    by_tray = spark.createDataFrame(
        [(1, "kale", "a", 10, 1.0), (1, "kale", "b", 10, 1.0), (1, "kale", None, 40, 2.0)],
        "week_id int, crop string, tray_id string, stage_age_days int, kwh_used double",
    )
    assert telemetry_mode(by_tray) == "rows"
    assert rows(rollup_telemetry(by_tray), "active_tray_rows", "avg_stage_age_days", "kwh_used") == [
        (2, 20.0, 4.0)]
    counts = spark.createDataFrame(
        [(1, "kale", 99, 10, 1.0), (1, "kale", 1, 40, 2.0)],
        "week_id int, crop string, active_trays long, stage_age_days int, kwh_used double",
    )
    assert telemetry_mode(counts) == "counts"
    assert rows(rollup_telemetry(counts), "active_trays", "avg_stage_age_days") == [(100, 25.0)]
    with pytest.raises(ValueError):
        rollup_telemetry(counts, "other")


def test_densify_drops_foreign_cells_and_fills_gaps(spark, params):
    grid = cal.crop_week_grid(params, 3)
    facts = spark.createDataFrame(
        [("kale", 1, 5.0), ("kale", 1, 1.0), ("kale", 9, 7.0), ("tulip", 1, 3.0)],
        "crop string, week_id int, demand_lbs double",
    )
    dense = densify_zero(facts, grid, "demand_lbs")
    got = {(r.crop, r.week_id): r.demand_lbs for r in dense.collect()}
    assert len(got) == 18 and got["kale", 1] == 6.0 and sum(got.values()) == 6.0


def test_densify_mean_uses_present_weeks_then_the_default(spark):
    grid = cal.week_grid(spark, 4)
    prices = spark.createDataFrame(
        [(1, 0.1), (1, 0.3), (2, 0.4), (9, 50.0)], "week_id int, price_per_kwh double"
    )
    got = dict(rows(densify_mean(prices, grid, "price_per_kwh"), "week_id", "price_per_kwh"))
    assert got == pytest.approx({1: 0.2, 2: 0.4, 3: 0.3, 4: 0.3})
    empty = prices.filter("week_id > 100")
    got = dict(rows(densify_mean(empty, grid, "price_per_kwh"), "week_id", "price_per_kwh"))
    assert set(got.values()) == {0.13}


def test_densify_mean_per_key(spark):
    sites = spark.createDataFrame([(1,), (2,)], "facility long")
    prices = spark.createDataFrame(
        [(1, 1, 0.1), (2, 1, 0.5), (2, 2, 0.7)],
        "facility long, week_id int, price_per_kwh double",
    )
    filled = densify_mean(prices, cal.cross_weeks(sites, 3), "price_per_kwh", keys=["facility"])
    got = {(r.facility, r.week_id): r.price_per_kwh for r in filled.collect()}
    assert got == pytest.approx({(1, 1): 0.1, (1, 2): 0.1, (1, 3): 0.1,
                                 (2, 1): 0.5, (2, 2): 0.7, (2, 3): 0.6})


def test_parameters(spark, params):
    assert params.count() == 6 and par.max_age(params).first()[0] == 6
    profile = par.mean_crop_profile(params).first()
    assert profile.avg_grow_weeks == pytest.approx(4.5)
    twice = params.unionByName(params.withColumn("shrink", F.col("shrink") + 0.5))
    assert rows(par.dedup_params(twice), *params.columns) == rows(params, *params.columns)
    assert par.select_crops(params, ["kale"]).count() == 1


def test_initial_stock_and_blocks(spark, params):
    init = par.initial_wip_table(spark, {"kale": {1: 40, 2: 30}, "basil": {0: 0}})
    assert rows(init, "crop", "age", "qty") == [("basil", 0, 0), ("kale", 1, 40), ("kale", 2, 30)]
    assert par.has_initial(init).first()[0] is True
    assert par.has_initial(init.filter("qty = 0")).first()[0] is False
    assert par.has_initial(init.filter("qty < 0")).first()[0] is False
    site = spark.range(1).select(F.array(F.lit(40.0), F.lit(25.0)).alias("overtime_block_hours"))
    assert rows(par.overtime_blocks(site), "block", "block_hours", "ceiling_hours") == [
        (1, 40.0, 40.0), (2, 25.0, 65.0)]


def test_scenarios_are_checked(spark):
    with pytest.raises(ValueError):
        par.Scenario(base_wage_per_hour=-1.0)
    with pytest.raises(ValueError):
        par.Scenario(shift_labor_reduction_pct=1.5)
    with pytest.raises(ValueError):
        par.attach_scenario(spark.range(1), spark.range(1), ["facility"])


def test_quality(spark, params):
    demand = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "demand_lbs double")
    price = spark.createDataFrame([(0.1,), (0.0,)], "energy_price_per_kwh double")
    assert rows(quality.range_violations(demand, price), "rule", "checked", "violations") == [
        ("demand_not_negative", 3, 2), ("price_positive", 2, 1)]
    crops = spark.createDataFrame([("kale",), ("tulip",), ("tulip",)], "crop string")
    assert rows(quality.missing_params(crops, params), "crop") == [("tulip",)]


def test_sources_round_trip(spark, params):
    out = scratch_dir(spark)
    tables.write_table(params, out, "crop_params")
    back = tables.read_table(spark, out, "crop_params", schemas.CROP_PARAMS)
    assert rows(back, *params.columns) == rows(params, *params.columns)
    csv = tables.write_csv(params, tables.table_path(out, "p", "csv"))
    assert rows(tables.read_csv(spark, csv, schemas.CROP_PARAMS), *params.columns) == rows(
        params, *params.columns)
    js = tables.write_json(params, tables.table_path(out, "p", "json"))
    assert rows(tables.read_json(spark, js, schemas.CROP_PARAMS), *params.columns) == rows(
        params, *params.columns)


def test_scratch_dir_follows_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_dir(spark).startswith(shared) and scratch_dir(spark) != scratch_dir(spark)
