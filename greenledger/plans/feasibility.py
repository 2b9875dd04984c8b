"""Reasons why demand cannot be met, as rows instead of exceptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.functions.columns import CHECK_TOLERANCE, effective_yield
from greenledger.plans.capacity import overtime_ceiling, process_usage, rack_usage
from greenledger.plans.schedule import back_schedule
from greenledger.sources.parameters import Scenario, attach_scenario

# The texts of the issues.
EARLY_TEXT = (
    "Demand for crop=%s, week=%d is %.2f lbs but no initial WIP is configured and "
    "harvest cannot occur that early."
)
YIELD_TEXT = "Crop=%s has non-positive effective yield."
PROCESS_TEXT = "Week %d: required harvested trays %.1f exceeds process cap %.1f."
LABOR_TEXT = "Week %d: required labor %.1f hours exceeds max labor cap %.1f."
EXACT_TEXT = "Week %d: the least possible %s use %.1f exceeds its cap %.1f, so no plan exists."


def _issue(
    df: DataFrame, kind: str, value: Column, limit: Column, message: Column,
    keys: Sequence[str], crop: Column | None = None,
) -> DataFrame:
    return df.select(
        *keys,
        F.lit(kind).alias("kind"),
        (F.lit(None).cast("string") if crop is None else crop).alias("crop"),
        "week_id",
        value.cast("double").alias("value"),
        limit.cast("double").alias("limit"),
        message.alias("message"),
    )


def issue_early_demand(
    demand: DataFrame, params: DataFrame, init: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Demand before any planting can be harvested. Any row of initial stock, of
    whatever crop and quantity, turns the check off."""
    rows = demand.join(params, "crop").filter(
        (F.col("demand_lbs") > CHECK_TOLERANCE) & (F.col("week_id") <= F.col("g_min_weeks"))
    )
    if init is not None:
        shared = [k for k in keys if k in init.columns]
        if shared:
            rows = rows.join(init.select(*shared).distinct(), shared, "left_anti")
        else:
            rows = rows.filter(init.agg(F.count(F.lit(1)) == 0).scalar())
    return _issue(
        rows, "early_demand", F.col("demand_lbs"), F.lit(0.0),
        F.format_string(EARLY_TEXT, "crop", "week_id", "demand_lbs"), keys, F.col("crop"),
    )


def issue_nonpositive_yield(
    demand: DataFrame, params: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Crops that produce nothing, once per week of the dense demand."""
    rows = demand.join(params, "crop").filter(effective_yield() <= 0)
    return _issue(
        rows, "nonpositive_yield", effective_yield(), F.lit(0.0),
        F.format_string(YIELD_TEXT, "crop"), keys, F.col("crop"),
    )


def required_by_week(
    demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Fractional trays and hours the demand of a week asks for, with the shift on.

    The pre-check books planting in the harvest week and ignores rack space.
    """
    trays = F.col("demand_lbs") / effective_yield()
    weekly = (
        demand.join(params, "crop")
        .filter(effective_yield() > 0)
        .groupBy(*keys, "week_id")
        .agg(
            F.sum(trays).alias("required_trays"),
            F.sum(trays * F.col("plant_hours_per_tray")).alias("required_plant_hours"),
            F.sum(trays * F.col("harvest_hours_per_tray")).alias("required_harvest_hours"),
        )
    )
    kept = F.lit(1.0) - F.col("shift_labor_reduction_pct")
    return attach_scenario(weekly, scen, keys).withColumn(
        "required_labor",
        F.col("required_plant_hours") + F.col("required_harvest_hours") * kept,
    )


def _process(required: DataFrame, keys: Sequence[str]) -> DataFrame:
    value, limit = F.col("required_trays"), F.col("base_process_capacity_trays_per_week")
    return _issue(
        required.filter(value > limit + CHECK_TOLERANCE), "process_cap", value, limit,
        F.format_string(PROCESS_TEXT, "week_id", value, limit), keys,
    )


def _labor(required: DataFrame, keys: Sequence[str]) -> DataFrame:
    value = F.col("required_labor")
    limit = F.col("base_labor_hours_per_week") + overtime_ceiling()
    return _issue(
        required.filter(value > limit + CHECK_TOLERANCE), "labor_cap", value, limit,
        F.format_string(LABOR_TEXT, "week_id", value, limit), keys,
    )


def issue_process_cap(demand, params, scen, keys: Sequence[str] = ()) -> DataFrame:
    return _process(required_by_week(demand, params, scen, keys), keys)


def issue_labor_cap(demand, params, scen, keys: Sequence[str] = ()) -> DataFrame:
    return _labor(required_by_week(demand, params, scen, keys), keys)


def issues_all(
    demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame,
    init: DataFrame | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """Every issue of the pre-check in one table."""
    required = required_by_week(demand, params, scen, keys)
    return (
        issue_early_demand(demand, params, init, keys)
        .unionByName(issue_nonpositive_yield(demand, params, keys))
        .unionByName(_process(required, keys))
        .unionByName(_labor(required, keys))
    )


def issue_rack_or_process_exact(
    demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Weeks in which even the back-scheduled plan breaks the rack or process cap.

    That plan uses the fewest trays, each for the shortest time, so such a week
    proves that no plan exists (without initial stock).
    """
    plan = back_schedule(demand, params, keys)

    def over(usage: DataFrame, name: str) -> DataFrame:
        value, limit = F.col(f"{name}_used_trays"), F.col(f"{name}_capacity_trays")
        return _issue(
            usage.filter("over_capacity"), f"{name}_exact", value, limit,
            F.format_string(EXACT_TEXT, "week_id", F.lit(name), value, limit), keys,
        )

    return over(rack_usage(plan, scen, weeks, keys), "rack").unionByName(
        over(process_usage(plan, scen, weeks, keys), "process")
    )


def feasibility_only(
    demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame,
    init: DataFrame | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """The pre-check in one row (per key of the demand): status texts, a flag and how many
    issues there are."""
    found = issues_all(demand, params, scen, init, keys).select(*keys, F.lit(1).alias("n"))
    if keys:  # a key without an issue has a row as well
        found = found.unionByName(demand.select(*keys).distinct().withColumn("n", F.lit(0)))
    count = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    return found.groupBy(*keys).agg(
        F.lit("not_run").alias("solver_status"),
        F.when(count == 0, "feasible_precheck_passed")
        .otherwise("feasible_precheck_failed")
        .alias("termination_condition"),
        (count == 0).alias("feasible"),
        count.alias("issues"),
    )
