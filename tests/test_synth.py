"""Invariants of the synthetic tables, for one site and for many."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from greenledger.functions.columns import noise_int, noise_normal, noise_uniform
import synth_tables as synth
from greenledger.sources.parameters import Scenario, scenario_table

WEEKS, SEED, START = 12, 20260225, "2026-01-05"
KEYS = ["facility"]


@pytest.fixture(scope="module")
def sites(spark):
    rows = spark.range(7).select(F.col("id").alias("facility"))
    return scenario_table(rows, Scenario(), rack_capacity_trays_per_week=200 + F.col("facility") * 50)


@pytest.fixture(scope="module")
def weekly(sites, params):
    return synth.synth_demand_weekly(sites, params, WEEKS, SEED, KEYS).cache()


@pytest.fixture(scope="module")
def counts(sites, params):
    return synth.synth_telemetry_counts(sites, params, START, WEEKS, SEED, KEYS).cache()


def test_noise_stays_in_bounds_and_looks_random(spark):
    df = spark.range(20000).select(
        noise_uniform(1, "u", F.col("id"), low=0.8, high=1.2).alias("u"),
        noise_normal(1, "n", F.col("id"), mean=1.0, std=0.5).alias("n"),
        noise_int(1, "i", F.col("id"), low=1, high=4).alias("i"),
    )
    r = df.agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("mu"),
               F.avg("n").alias("mn"), F.stddev("n").alias("sd"),
               F.array_sort(F.collect_set("i")).alias("ints")).first()
    assert 0.8 <= r.lo < 0.81 and 1.19 < r.hi < 1.2 and abs(r.mu - 1.0) < 0.01
    assert abs(r.mn - 1.0) < 0.02 and abs(r.sd - 0.5) < 0.02 and r.ints == [1, 2, 3]


def test_tray_limit_of_the_shipped_setting(spark, params):
    site = scenario_table(spark.range(1), Scenario())
    row = synth.tray_limit(site, params).first()
    assert row.tray_limit == pytest.approx(240.0) and row.target_total_trays == 168


def test_weekly_demand(weekly, sites, params):
    assert weekly.count() == 7 * 6 * WEEKS
    early = weekly.join(params, "crop").filter("week_id <= g_min_weeks")
    assert early.agg(F.sum("demand_lbs"), F.sum("demand_trays_est")).first() == (0.0, 0)
    totals = synth.weekly_total_trays(synth.tray_limit(sites, params), WEEKS, SEED, KEYS)
    split = weekly.groupBy("facility", "week_id").agg(F.sum("demand_trays_est").alias("n"))
    off = totals.join(split, ["facility", "week_id"]).filter("week_id > 5 AND n != total_trays")
    assert off.count() == 0
    top = totals.filter(F.col("total_trays") > F.bround(F.col("tray_limit") * 0.92))
    assert top.count() == 0


def test_apportion_keeps_totals_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [(1, "a", 10, 1 / 3), (1, "b", 10, 1 / 3), (1, "c", 10, 1 / 3), (2, "a", 5, 1.0),
         (2, "b", 5, 0.0), (3, "a", 4, 0.0)],
        "w int, crop string, total long, weight double")
    got = {(r.w, r.crop): r.trays for r in synth.apportion(df, "total", "weight", ["w"]).collect()}
    assert got == {(1, "a"): 4, (1, "b"): 3, (1, "c"): 3, (2, "a"): 5, (2, "b"): 0, (3, "a"): 0}


def test_days_add_up_to_their_week(weekly):
    daily = synth.disaggregate(weekly, START, SEED, KEYS)
    assert daily.count() == 7 * weekly.count()
    cells = ["facility", "crop", "week_id"]
    sums = daily.groupBy(*cells).agg(F.sum("demand_lbs").alias("total"), F.min("demand_lbs").alias("low"))
    bad = sums.join(weekly, cells).filter("abs(total - demand_lbs) > 1e-9 OR low < 0")
    assert bad.count() == 0
    assert daily.agg(F.min("date"), F.max("date")).first() == ("2026-01-05", "2026-03-29")


def test_prices(sites):
    prices = synth.synth_price_daily(sites, START, WEEKS, SEED, KEYS)
    assert prices.count() == 7 * 84
    low, high = prices.agg(F.min("energy_price_per_kwh"), F.max("energy_price_per_kwh")).first()
    assert 0.02 <= low and high < 0.16


def test_telemetry_counts(counts, params):
    assert counts.count() == 7 * 84 * 6
    bad = counts.join(params, "crop").filter(
        "stage_age_days < 1 OR stage_age_days > g_max_weeks * 7 - 1 OR active_trays < 0 "
        "OR is_active != (active_trays > 0)")
    assert bad.count() == 0


def test_rows_match_counts_across_chunks(counts, params, monkeypatch):
    def expanded():
        return synth.expand_rows(counts, params, SEED, KEYS)

    whole = expanded()
    assert whole.count() == counts.agg(F.sum("active_trays")).first()[0]
    assert whole.select("tray_id").distinct().count() == whole.count()
    monkeypatch.setattr(synth, "EXPAND_CHUNK", 3)
    assert expanded().exceptAll(whole).count() == 0 and whole.exceptAll(expanded()).count() == 0


def test_redraw_does_not_depend_on_partitioning(spark, sites, params):
    """A lost task redraws the same rows, however they are partitioned."""
    a = synth.synth_telemetry_counts(sites, params, START, 2, SEED, KEYS)
    b = synth.synth_telemetry_counts(sites.repartition(3), params, START, 2, SEED, KEYS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
