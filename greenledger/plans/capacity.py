"""Rack, process and labor use against capacity; overtime and shift choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.functions.columns import CHECK_TOLERANCE
from greenledger.plans.ledger import occupancy
from greenledger.sources.parameters import Scenario, attach_scenario

SHIFT_OUTPUTS = (
    "shift_on",
    "labor_used_hours",
    "overtime_hours",
    "overtime_blocks_enabled",
    "overtime_feasible",
    "labor_cost",
    "labor_cost_floor",
)


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def rack_ratio(used: Column) -> Column:
    return used / F.greatest(F.col("rack_capacity_trays_per_week"), F.lit(1.0))


def process_ratio(used: Column) -> Column:
    return used / F.greatest(F.col("base_process_capacity_trays_per_week"), F.lit(1.0))


def _usage(df: DataFrame, prefix: str, capacity: str, ratio, keys: Sequence[str]) -> DataFrame:
    used = F.col(f"{prefix}_used_trays")
    return df.select(
        *keys, "week_id", used,
        F.col(capacity).alias(f"{prefix}_capacity_trays"),
        ratio(used).alias(f"{prefix}_utilization"),
        (used > F.col(capacity) + CHECK_TOLERANCE).alias("over_capacity"),
    )


def rack_usage(
    plan: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Trays in the racks per week against the rack capacity."""
    used = occupancy(plan, weeks, keys).groupBy(*keys, "week_id").agg(
        F.sum("trays_in_stock").cast("double").alias("rack_used_trays")
    )
    return _usage(attach_scenario(used, scen, keys), "rack", "rack_capacity_trays_per_week",
                  rack_ratio, keys)


def process_usage(
    plan: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Trays harvested per week against the process capacity."""
    inside = F.col("harvest_week") >= 1
    if weeks is not None:
        inside = F.col("harvest_week").between(1, weeks)
    used = (
        plan.filter(inside)
        .groupBy(*keys, F.col("harvest_week").alias("week_id"))
        .agg(F.sum("trays").cast("double").alias("process_used_trays"))
    )
    return _usage(attach_scenario(used, scen, keys), "process",
                  "base_process_capacity_trays_per_week", process_ratio, keys)


def labor_base(
    plan: DataFrame, params: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Planting hours in the planting week, harvest hours in the harvest week."""
    zero = F.lit(0.0)
    parts = F.array(
        F.struct(
            F.col("plant_week").alias("week_id"),
            (F.col("trays") * F.col("plant_hours_per_tray")).alias("plant_hours"),
            zero.alias("harvest_hours"),
        ),
        F.struct(
            F.col("harvest_week").alias("week_id"),
            zero.alias("plant_hours"),
            (F.col("trays") * F.col("harvest_hours_per_tray")).alias("harvest_hours"),
        ),
    )
    inside = F.col("week_id") >= 1
    if weeks is not None:
        inside = F.col("week_id").between(1, weeks)
    return (
        plan.join(params, "crop")
        .select(*keys, F.inline(parts))
        .filter(inside)
        .groupBy(*keys, "week_id")
        .agg(F.sum("plant_hours").alias("plant_hours"),
             F.sum("harvest_hours").alias("harvest_hours"))
    )


def shift_hours(on: bool) -> Column:
    """Labor hours of a week with the shift off or on."""
    if not on:
        return F.col("plant_hours") + F.col("harvest_hours")
    return F.col("plant_hours") + F.col("harvest_hours") * (
        F.lit(1.0) - F.col("shift_labor_reduction_pct")
    )


def labor_hours(
    plan: DataFrame, params: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Weekly labor hours, with the shift off and on."""
    hours = attach_scenario(labor_base(plan, params, weeks, keys), scen, keys)
    return hours.select(
        *keys, "week_id", "plant_hours", "harvest_hours",
        shift_hours(False).alias("labor_hours_shift_off"),
        shift_hours(True).alias("labor_hours_shift_on"),
    )


def overtime_ceiling() -> Column:
    """Hours all overtime blocks give together."""
    return F.aggregate("overtime_block_hours", F.lit(0.0), lambda acc, h: acc + h)


def overtime_hours(labor: Column) -> Column:
    return F.greatest(labor - F.col("base_labor_hours_per_week"), F.lit(0.0))


def overtime_blocks_used(overtime: Column) -> Column:
    """Fewest ordered blocks that cover the hours; all of them when none suffices."""
    covers = F.transform(
        "overtime_block_hours",
        lambda _h, i: F.aggregate(
            F.slice("overtime_block_hours", F.lit(1), i + 1), F.lit(0.0), lambda acc, h: acc + h
        ) + CHECK_TOLERANCE >= overtime,
    )
    first = F.array_position(covers, True)
    return (
        F.when(overtime <= CHECK_TOLERANCE, 0)
        .when(first > 0, first)
        .otherwise(F.size("overtime_block_hours"))
        .cast("int")
    )


def overtime_fits(overtime: Column) -> Column:
    return overtime <= overtime_ceiling() + CHECK_TOLERANCE


def overtime_need(
    labor: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Overtime for given weekly hours (keys.., week_id, labor_used_hours)."""
    need = attach_scenario(labor, scen, keys).withColumn(
        "overtime_hours", overtime_hours(F.col("labor_used_hours"))
    )
    hours = F.col("overtime_hours")
    return need.select(
        *keys, "week_id", "labor_used_hours", "overtime_hours",
        overtime_blocks_used(hours).alias("overtime_blocks_enabled"),
        overtime_fits(hours).alias("overtime_feasible"),
    )


def with_shift_choice(df: DataFrame) -> DataFrame:
    """Choose shift off or on for each week with hours and scenario columns.

    Cheapest of the options whose overtime fits, off on a tie; when neither fits, the
    one with fewer hours. ``labor_cost_floor`` is the cheaper of both with overtime
    taken as free, a bound no plan with these hours can beat.
    """
    names = df.columns
    options = df.withColumns(
        {
            "hours_off": shift_hours(False),
            "hours_on": shift_hours(True),
            "ceiling": overtime_ceiling() + CHECK_TOLERANCE,
        }
    )
    # Later columns of this select build on the earlier ones by name.
    chosen = options.selectExpr(
        *names,
        "hours_off",
        "hours_on",
        "greatest(hours_off - base_labor_hours_per_week, 0D) AS over_off",
        "greatest(hours_on - base_labor_hours_per_week, 0D) AS over_on",
        "base_wage_per_hour * hours_off AS plain_off",
        "base_wage_per_hour * hours_on + shift_fixed_cost_per_week AS plain_on",
        "plain_off + overtime_premium_per_hour * over_off AS cost_off",
        "plain_on + overtime_premium_per_hour * over_on AS cost_on",
        """CASE WHEN over_off <= ceiling AND over_on <= ceiling THEN cost_on < cost_off
                WHEN over_off <= ceiling THEN false
                WHEN over_on <= ceiling THEN true
                ELSE hours_on < hours_off END AS on""",
        "CAST(on AS INT) AS shift_on",
        "IF(on, hours_on, hours_off) AS labor_used_hours",
        "IF(on, over_on, over_off) AS overtime_hours",
        "overtime_hours <= ceiling AS overtime_feasible",
        "IF(on, cost_on, cost_off) AS labor_cost",
        "least(plain_off, plain_on) AS labor_cost_floor",
    )
    blocks = overtime_blocks_used(F.col("overtime_hours")).alias("overtime_blocks_enabled")
    return chosen.select(*names, *(n for n in SHIFT_OUTPUTS if n != "overtime_blocks_enabled"), blocks)


def shift_choice(
    labor: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Shift decision per week of (keys.., week_id, plant_hours, harvest_hours)."""
    return with_shift_choice(attach_scenario(labor, scen, keys)).select(
        *keys, "week_id", *SHIFT_OUTPUTS
    )
