"""Whole runs over a directory. Each stage writes tables and the next reads them, so a
lost executor never recomputes more than one stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from greenledger.operators.calendar import cross_weeks, crop_week_grid, week_grid
from greenledger.operators.densify import densify_mean, densify_zero
from greenledger.operators.rollup import rollup_demand, rollup_price, rollup_telemetry
from greenledger.plans.costs import (
    cost_breakdown,
    evaluate_weeks,
    solution_harvest,
    utilization_weekly,
)
from greenledger.plans.feasibility import issues_all
from greenledger.plans.ledger import planting_by_week
from greenledger.plans.report import report_lines, report_summary
from greenledger.plans.schedule import back_schedule, initial_wip_fifo
from greenledger.plans.selection import certify, plan_summary
from greenledger.sources.parameters import Scenario, dedup_params
from greenledger.sources.schemas import (
    COST_BREAKDOWN,
    SOLUTION_HARVEST,
    UTILIZATION_WEEKLY,
)
from greenledger.sources.tables import (
    read_csv,
    read_json,
    read_table,
    table_path,
    write_csv,
    write_json,
    write_table,
)

DAILY = ("demand_daily", "prices_energy_daily", "crop_params", "telemetry_tray_daily")
WEEKLY_CSV = ("demand_weekly", "energy_price_weekly", "crop_params")


def aggregate_frames(
    spark: SparkSession, frames: Mapping[str, DataFrame], out_dir: str, mode: str | None = None,
    keys: Sequence[str] = (),
) -> dict[str, str]:
    """Roll four daily tables up to weekly parquet tables, three with CSV copies.

    The daily tables are read where they are and only weekly ones are written; the
    copies are made from the written tables, so nothing is rolled up twice.
    """
    tables = {
        "demand_weekly": rollup_demand(frames["demand_daily"], keys),
        "energy_price_weekly": rollup_price(frames["prices_energy_daily"], keys),
        "crop_params": dedup_params(frames["crop_params"]),
        "telemetry_weekly": rollup_telemetry(frames["telemetry_tray_daily"], mode, keys),
    }
    paths = {name: write_table(df, out_dir, name) for name, df in tables.items()}
    for name in WEEKLY_CSV:
        write_csv(read_table(spark, out_dir, name), table_path(out_dir, name, "csv"))
    return paths


def aggregate_tables(
    spark: SparkSession, raw_dir: str, out_dir: str, mode: str | None = None,
    keys: Sequence[str] = (),
) -> dict[str, str]:
    """The same from four written daily tables."""
    frames = {name: read_table(spark, raw_dir, name) for name in DAILY}
    return aggregate_frames(spark, frames, out_dir, mode, keys)


def plan_and_write(
    spark: SparkSession, weekly_dir: str, out_dir: str, params: DataFrame,
    scen: Scenario | DataFrame, weeks: int, keys: Sequence[str] = (),
    init: DataFrame | None = None,
) -> dict[str, str]:
    """Plan from the weekly tables and write the issues, the plan, its use and costs.

    With keys, the sites are those of the scenario table, or, under one scenario for all,
    those of the demand. Initial stock, if given, is used up before anything is planted.
    """
    sites = None
    if keys:
        named = read_table(spark, weekly_dir, "demand_weekly") if isinstance(scen, Scenario) else scen
        sites = named.select(*keys).distinct()
    grid = crop_week_grid(params, weeks, sites)
    week_cells = cross_weeks(sites, weeks) if keys else week_grid(spark, weeks)
    demand = densify_zero(
        read_table(spark, weekly_dir, "demand_weekly"), grid, "demand_lbs", weeks
    )
    price = densify_mean(
        read_table(spark, weekly_dir, "energy_price_weekly"), week_cells, "price_per_kwh",
        keys=keys, weeks=weeks,
    )
    # The dense demand, the plan and the evaluated weeks feed several outputs: each is
    # written once and read back.
    write_table(demand, out_dir, "demand_dense")
    demand = read_table(spark, out_dir, "demand_dense")
    if init is None:
        plan = back_schedule(demand, params, keys)
    else:
        plan = initial_wip_fifo(demand, init, params, keys)
    write_table(plan, out_dir, "plan")
    plan = read_table(spark, out_dir, "plan")
    evaluated = evaluate_weeks(plan, demand, params, price, scen, weeks, keys)
    write_table(evaluated, out_dir, "weeks")
    evaluated = read_table(spark, out_dir, "weeks")

    outputs = {
        "issues": issues_all(demand, params, scen, init, keys),
        "solution_planting": planting_by_week(plan, grid, keys),
        "solution_harvest": solution_harvest(plan, demand, params, weeks, keys),
        "utilization_weekly": utilization_weekly(evaluated, keys),
    }
    paths = {name: write_csv(df, table_path(out_dir, name, "csv")) for name, df in outputs.items()}
    summary = plan_summary(certify(evaluated, keys, init is not None), keys)
    for name, df in (("cost_breakdown", cost_breakdown(evaluated, keys)),
                     ("solve_summary", summary.withColumn("outputs_dir", F.lit(out_dir)))):
        paths[name] = write_json(df, table_path(out_dir, name, "json"))
    return paths


def _keyed(schema: StructType, keyed_by: StructType) -> StructType:
    return StructType(keyed_by.fields + schema.fields)


def report_and_write(
    spark: SparkSession, weekly_dir: str, out_dir: str, params: DataFrame, weeks: int,
    keyed_by: StructType = StructType([]),
) -> dict[str, str]:
    """Report over the written outputs. ``keyed_by`` is the schema of the key columns."""
    keys = keyed_by.fieldNames()
    costs = read_json(
        spark, table_path(out_dir, "cost_breakdown", "json"), _keyed(COST_BREAKDOWN, keyed_by)
    )
    harvest = read_csv(spark, table_path(out_dir, "solution_harvest", "csv"),
                       _keyed(SOLUTION_HARVEST, keyed_by))
    usage = read_csv(spark, table_path(out_dir, "utilization_weekly", "csv"),
                     _keyed(UTILIZATION_WEEKLY, keyed_by))
    demand = read_table(spark, weekly_dir, "demand_weekly")
    summary = report_summary(demand, harvest, usage, costs, params, weeks, keys)
    paths = {
        "report_summary": write_json(summary, table_path(out_dir, "report_summary", "json"))
    }
    paths["report_lines"] = write_csv(
        report_lines(summary, costs, keys), table_path(out_dir, "report_lines", "csv")
    )
    return paths


def write_daily(frames: Mapping[str, DataFrame], directory: str) -> dict[str, str]:
    """Write the four daily tables and return their paths."""
    return {name: write_table(frames[name], directory, name) for name in DAILY}


def run_given(
    spark: SparkSession, frames: Mapping[str, DataFrame], directory: str, params: DataFrame,
    scen: Scenario | DataFrame, weeks: int, mode: str | None = None, init: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> dict[str, str]:
    """Aggregate, plan and report over daily tables that exist: one site, or one per key."""
    weekly, out = f"{directory}/weekly", f"{directory}/outputs"
    keyed_by = StructType([frames["demand_daily"].schema[key] for key in keys])
    paths = aggregate_frames(spark, frames, weekly, mode, keys)
    paths.update(plan_and_write(spark, weekly, out, params, scen, weeks, keys, init))
    paths.update(report_and_write(spark, weekly, out, params, weeks, keyed_by))
    return paths
