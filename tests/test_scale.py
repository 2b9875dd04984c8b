"""What makes the plans hold at size: pruned scans, skew, spread and reuse."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import synth_tables as synth
from greenledger.operators.calendar import restrict
from greenledger.operators.rollup import rollup_demand
from greenledger.plans import selection
from greenledger.registry.catalog import QUERIES
from greenledger.registry.inputs import WEEKS, Inputs
from greenledger.session import scratch_dir
from greenledger.sources import schemas
from greenledger.sources.parameters import Scenario, scenario_table
from greenledger.sources.tables import read_table, write_table


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def set_(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_demand_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = Inputs(spark, sf_dir).demand._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "l_shipdate" in line and "FileScan" in line)
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>", scan)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan


def test_stored_weekly_table_is_filtered_in_the_scan(spark, sf_dir):
    out = scratch_dir(spark)
    write_table(Inputs(spark, sf_dir).demand_weekly, out, "demand_weekly", partition_by=("week_id",))
    part = restrict(read_table(spark, out, "demand_weekly"), ["PROMO"], 3)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*week_id", plan)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(crop,PROMO\)|PushedFilters: \[[^\]]*crop", plan)
    assert part.count() <= 3


def test_hot_crop_is_combined_before_the_shuffle(spark):
    """A third of the rows in one cell reaches the shuffle as one row per task."""
    rows = spark.range(0, 300000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50))
        .alias("crop"),
        F.lit(1).alias("week_id"), F.lit(1.0).alias("demand_lbs"),
    )
    weekly = rollup_demand(rows)
    plan = executed(weekly)
    assert "partial_sum(" in plan
    assert weekly.filter("crop = 'hot'").first().demand_lbs == 100000.0


def test_hot_part_is_split_in_the_join(spark, tmp_path, conf):
    """Line items of one part make a third of all rows; the join splits them."""
    lines = spark.range(0, 400000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).alias("l_partkey"),
        F.col("id").alias("l_suppkey"),
        F.expr("timestamp_ntz'1995-02-01 00:00:00'").alias("l_shipdate"),
        F.lit(1.0).alias("l_quantity"), F.col("id").alias("l_orderkey"),
        F.lit(1).alias("l_linenumber"),
    )
    parts = spark.range(997).select(
        F.col("id").alias("p_partkey"),
        F.when(F.col("id") == 7, "PROMO").otherwise("SMALL").alias("p_type"),
    )
    write_table(lines, str(tmp_path), "lineitem")
    write_table(parts, str(tmp_path), "part")
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="100kb",
         spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200kb",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
         spark__sql__shuffle__partitions="8")
    weekly = Inputs(spark, str(tmp_path)).demand_weekly
    assert "SortMergeJoin(skew=true)" in executed(weekly)
    got = {r.crop: r.demand_lbs for r in weekly.collect()}
    small = sum(1 for i in range(400000) if i % 3 and i % 997 != 7)
    assert got == {"PROMO": 400000.0 - small, "SMALL": float(small)}


def test_synthetic_rows_are_spread_before_they_multiply(spark, params):
    site = scenario_table(spark.range(40).select(F.col("id").alias("facility")), Scenario())
    counts = synth.synth_telemetry_counts(site, params, "2026-01-05", 12, 1, ["facility"])
    rows = synth.expand_rows(counts, params, 1, ["facility"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for df in (counts, rows):
        used = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(used) == parts


def final_plan(df) -> str:
    """The executed plan, without the initial plans of it and of its subqueries."""
    top = executed(df).split("\n+- == Initial Plan ==")[0]
    kept, skip = [], None
    for line in top.splitlines():
        indent = len(line) - len(line.lstrip(" :"))
        if "== Initial Plan ==" in line:
            skip = indent
        elif skip is None or indent < skip:
            skip = None
            kept.append(line)
    return "\n".join(kept)


ONE_SCAN = ["cost_breakdown", "constraint_audit", "utilization_weekly", "scenario_sweep",
            "policy_sweep", "plan_certificate_by_facility", "issue_rack_or_process_exact"]


@pytest.mark.parametrize("name", ONE_SCAN)
def test_big_tables_are_scanned_once(spark, sf_dir, name):
    """Several operators share the weekly demand and price; their exchange is reused."""
    plan = final_plan(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    assert len(re.findall(r"FileScan parquet \[o_", plan)) <= 1
    assert "ReusedExchange" in plan


def test_sweep_expands_weeks_not_rows(spark, sf_dir):
    """The grid meets the week ledger: no scenario column reaches the line items."""
    i = Inputs(spark, sf_dir)
    knobs = {"rack_capacity_trays_per_week": tuple(float(10 * n) for n in range(1, 21))}
    sweep = selection.scenario_sweep(i.late_demand, i.params, i.price, Scenario(), knobs, WEEKS)
    assert sweep.count() == 20
    plan = sweep._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grid = next(n for n, line in enumerate(plan) if "explode" in line and "rack_cap" in line)
    scan = next(n for n, line in enumerate(plan) if "l_partkey" in line and "Relation" in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    assert depth[grid] < depth[scan]


def test_keyed_and_single_runs_agree(spark, sf_dir):
    """The nations' demand adds up to the whole demand in every cell."""
    i = Inputs(spark, sf_dir)
    both = (
        i.nation_demand.groupBy("crop", "week_id").agg(F.sum("demand_lbs").alias("by_key"))
        .join(i.demand, ["crop", "week_id"])
    )
    assert both.count() == i.demand.count()
    assert both.filter("abs(by_key - demand_lbs) > 1e-6").count() == 0


def test_written_schema_is_the_stated_one(spark, sf_dir):
    out = scratch_dir(spark)
    write_table(Inputs(spark, sf_dir).demand_weekly, out, "demand_weekly")
    assert read_table(spark, out, "demand_weekly").schema == schemas.DEMAND_WEEKLY
