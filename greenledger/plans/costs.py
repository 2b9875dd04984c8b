"""Cost parts of a plan, weekly evaluation and the output tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.operators.rollup import join_price
from greenledger.plans.capacity import (
    labor_base,
    process_ratio,
    rack_ratio,
    with_shift_choice,
)
from greenledger.plans.ledger import demand_balance, occupancy, week_ledger
from greenledger.sources.parameters import Scenario, attach_scenario
from greenledger.sources.schemas import COST_PARTS

#: Fixed value: smallest labor capacity the ratio divides by.
MIN_LABOR_CAPACITY = 1e-6


def _total(df: DataFrame, value: Column, name: str, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias(name))


def cost_seed(plan: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    seeds = plan.filter(F.col("plant_week") >= 1).join(params, "crop")
    return _total(seeds, F.col("trays") * F.col("seed_cost_per_tray"), "seed_cost", keys)


def cost_nutrient(
    plan: DataFrame, params: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    stock = occupancy(plan, weeks, keys).join(params, "crop")
    money = F.col("trays_in_stock") * F.col("nutrient_cost_per_tray_week")
    return _total(stock, money, "nutrient_cost", keys)


def energy_by_week(
    plan: DataFrame, params: DataFrame, price: DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Energy money per week of standing trays."""
    kwh = (
        occupancy(plan, weeks, keys)
        .join(params, "crop")
        .groupBy(*keys, "week_id")
        .agg(F.sum(F.col("trays_in_stock") * F.col("energy_kwh_per_tray_week"))
             .alias("energy_kwh"))
    )
    return join_price(kwh, price, keys, weeks).select(
        *keys, "week_id", "energy_kwh", "price_per_kwh",
        (F.col("price_per_kwh") * F.col("energy_kwh")).alias("energy_cost"),
    )


def cost_energy(
    plan: DataFrame, params: DataFrame, price: DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    weekly = energy_by_week(plan, params, price, weeks, keys)
    return _total(weekly, F.col("energy_cost"), "energy_cost", keys)


def _chosen_labor(plan, params, scen, weeks, keys) -> DataFrame:
    return with_shift_choice(attach_scenario(labor_base(plan, params, weeks, keys), scen, keys))


def cost_labor_base(
    plan: DataFrame, params: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    money = F.col("base_wage_per_hour") * F.col("labor_used_hours")
    return _total(_chosen_labor(plan, params, scen, weeks, keys), money, "labor_base_cost", keys)


def cost_overtime(
    plan: DataFrame, params: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    money = F.col("overtime_premium_per_hour") * F.col("overtime_hours")
    return _total(_chosen_labor(plan, params, scen, weeks, keys), money,
                  "overtime_premium_cost", keys)


def cost_shift(
    plan: DataFrame, params: DataFrame, scen: Scenario | DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    money = F.col("shift_fixed_cost_per_week") * F.col("shift_on")
    return _total(_chosen_labor(plan, params, scen, weeks, keys), money, "shift_fixed_cost", keys)


def cost_disposal(
    plan: DataFrame, demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    waste = demand_balance(plan, demand, params, weeks, keys)
    money = F.col("disposal_cost_per_lb_waste") * F.col("waste_lbs")
    return _total(attach_scenario(waste, scen, keys), money, "disposal_cost", keys)


def with_week_costs(df: DataFrame) -> DataFrame:
    """Cost parts of a week, from the ledger, the shift choice and scenario columns."""
    return df.selectExpr(
        "*",
        "price_per_kwh * energy_kwh AS energy_cost",
        "base_wage_per_hour * labor_used_hours AS labor_base_cost",
        "overtime_premium_per_hour * overtime_hours AS overtime_premium_cost",
        "shift_fixed_cost_per_week * shift_on AS shift_fixed_cost",
        "disposal_cost_per_lb_waste * waste_lbs AS disposal_cost",
        f"{' + '.join(COST_PARTS)} AS total_cost",
    )


def evaluate_weeks(
    plan: DataFrame, demand: DataFrame, params: DataFrame, price: DataFrame,
    scen: Scenario | DataFrame, weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """The week ledger with its scenario, shift choice and cost parts."""
    ledger = week_ledger(plan, demand, params, price, weeks, keys)
    return with_week_costs(with_shift_choice(attach_scenario(ledger, scen, keys)))


def cost_breakdown(evaluated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The seven cost parts and their total, one row per key."""
    return evaluated.groupBy(*keys).agg(
        *(F.coalesce(F.sum(part), F.lit(0.0)).alias(part) for part in (*COST_PARTS, "total_cost"))
    )


def cost_cube(valued: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Tray-bound costs for every set of dimensions, in one aggregate over the valued ledger.

    ``level`` has one bit per dimension, the first one highest, set where it is summed over.
    Money that depends on a whole week, such as labor, does not split by crop and is not here.
    """
    return valued.cube(*dims).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("trays_in_stock").alias("tray_weeks"),
        *(F.sum(c).alias(c) for c in ("seed_cost", "nutrient_cost", "waste_lbs")),
    )


def utilization_weekly(evaluated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Use of racks, labor and process per week; labor divides by base plus used overtime."""
    rack = F.col("trays_in_stock").cast("double")
    process = F.col("trays_harvested").cast("double")
    labor_capacity = F.col("base_labor_hours_per_week") + F.col("overtime_hours")
    return evaluated.select(
        *keys, "week_id",
        rack.alias("rack_used_trays"),
        F.col("rack_capacity_trays_per_week").alias("rack_capacity_trays"),
        rack_ratio(rack).alias("rack_utilization"),
        "labor_used_hours",
        labor_capacity.alias("labor_capacity_hours"),
        (F.col("labor_used_hours") / F.greatest(labor_capacity, F.lit(MIN_LABOR_CAPACITY)))
        .alias("labor_utilization"),
        process.alias("process_used_trays"),
        F.col("base_process_capacity_trays_per_week").alias("process_capacity_trays"),
        process_ratio(process).alias("process_utilization"),
        "overtime_hours", "overtime_blocks_enabled", "shift_on", "energy_cost",
    )


def solution_harvest(
    plan: DataFrame, demand: DataFrame, params: DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Harvested trays, produced, demanded and wasted pounds per crop and week."""
    return demand_balance(plan, demand, params, weeks, keys).select(
        *keys, "crop", "week_id", "trays_harvested", "produced_lbs", "demand_lbs", "waste_lbs"
    )
