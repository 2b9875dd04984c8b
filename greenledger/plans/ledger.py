"""What a plan does in each week: plantings, harvests, stock, and their value.

One generator turns a plan row into the weeks it touches, and one aggregate turns
those into the ledger. Every usage, cost and audit below reads the same ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.functions.columns import CHECK_TOLERANCE, effective_yield
from greenledger.operators.rollup import join_price

#: The rates of a crop that bounds on cost take as not negative.
RATES = ("plant_hours_per_tray", "harvest_hours_per_tray", "seed_cost_per_tray",
         "nutrient_cost_per_tray_week", "energy_kwh_per_tray_week")
TRAY_COLUMNS = ("trays_planted", "trays_harvested", "trays_in_stock")


def _when_trays(condition: Column) -> Column:
    return F.when(condition, F.col("trays")).otherwise(F.lit(0).cast("long"))


def plan_weeks(
    plan: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per plan row and week from planting to harvest, inside the horizon.

    A tray stands in the racks from its planting week to the week before harvest.
    """
    first = F.greatest(F.col("plant_week"), F.lit(1))
    last = F.col("harvest_week") if weeks is None else F.least("harvest_week", F.lit(weeks))
    # ``sequence`` counts down when its end is smaller, so empty spans go first.
    spans = plan.filter(
        (F.col("trays") > 0) & (F.col("plant_week") <= F.col("harvest_week")) & (first <= last)
    )
    week = F.col("week_id")
    return spans.select(
        *keys, "crop", "plant_week", "harvest_week", "trays",
        F.explode(F.sequence(first, last)).alias("week_id"),
    ).select(
        *keys, "crop", "week_id",
        _when_trays(week == F.col("plant_week")).alias("trays_planted"),
        _when_trays(week == F.col("harvest_week")).alias("trays_harvested"),
        _when_trays(week < F.col("harvest_week")).alias("trays_in_stock"),
    )


def occupancy(plan: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Trays standing in the racks per crop and week."""
    return (
        plan_weeks(plan, weeks, keys)
        .filter(F.col("trays_in_stock") > 0)
        .groupBy(*keys, "crop", "week_id")
        .agg(F.sum("trays_in_stock").alias("trays_in_stock"))
    )


def crop_ledger(
    plan: DataFrame, demand: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Trays planted, harvested and in stock beside the demand, per crop and week.

    A dense demand table makes a dense ledger: its rows join the same aggregate.
    """
    zero = F.lit(0).cast("long")
    wanted = demand.select(*keys, "crop", "week_id", *(zero.alias(c) for c in TRAY_COLUMNS),
                           "demand_lbs")
    done = plan_weeks(plan, weeks, keys).withColumn("demand_lbs", F.lit(0.0))
    return wanted.unionByName(done).groupBy(*keys, "crop", "week_id").agg(
        *(F.sum(c).alias(c) for c in (*TRAY_COLUMNS, "demand_lbs"))
    )


def valued_ledger(ledger: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The crop ledger in pounds, hours, kWh and tray-bound money."""
    planted, harvested, stock = (F.col(c) for c in TRAY_COLUMNS)
    produced = harvested * effective_yield()
    surplus = produced - F.col("demand_lbs")
    # A shortage below the tolerance is rounding of the pounds, not a shortage.
    return ledger.join(params, "crop").select(
        *keys, "crop", "week_id", *TRAY_COLUMNS, "demand_lbs",
        produced.alias("produced_lbs"),
        F.greatest(surplus, F.lit(0.0)).alias("waste_lbs"),
        F.greatest(F.lit(0.0) - surplus, F.lit(0.0)).alias("shortfall_lbs"),
        (surplus < -CHECK_TOLERANCE).alias("is_short"),
        ((F.col("demand_lbs") > CHECK_TOLERANCE) & (F.col("week_id") <= F.col("g_min_weeks")))
        .alias("is_early"),
        (planted * F.col("plant_hours_per_tray")).alias("plant_hours"),
        (harvested * F.col("harvest_hours_per_tray")).alias("harvest_hours"),
        (planted * F.col("seed_cost_per_tray")).alias("seed_cost"),
        (stock * F.col("nutrient_cost_per_tray_week")).alias("nutrient_cost"),
        (stock * F.col("energy_kwh_per_tray_week")).alias("energy_kwh"),
        (F.least(*RATES) < 0).alias("has_negative_rate"),
    )


WEEK_SUMS = (
    *TRAY_COLUMNS,
    "demand_lbs",
    "produced_lbs",
    "waste_lbs",
    "plant_hours",
    "harvest_hours",
    "seed_cost",
    "nutrient_cost",
    "energy_kwh",
)


def sum_weeks(valued: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The valued ledger over crops: one row per week."""
    return valued.groupBy(*keys, "week_id").agg(
        *(F.sum(c).alias(c) for c in WEEK_SUMS),
        F.count_if("is_short").alias("short_cells"),
        F.count_if("is_early").alias("early_cells"),
        F.count_if("has_negative_rate").alias("negative_rate_cells"),
    )


def week_ledger(
    plan: DataFrame, demand: DataFrame, params: DataFrame, price: DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """One row per week with everything a plan uses, and the energy price."""
    valued = valued_ledger(crop_ledger(plan, demand, weeks, keys), params, keys)
    return join_price(sum_weeks(valued, keys), price, keys, weeks)


def demand_balance(
    plan: DataFrame, demand: DataFrame, params: DataFrame, weeks: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Produced against demanded pounds per crop and week, with surplus and shortage."""
    return valued_ledger(crop_ledger(plan, demand, weeks, keys), params, keys).select(
        *keys, "crop", "week_id", "trays_harvested", "produced_lbs", "demand_lbs", "waste_lbs",
        "shortfall_lbs", "is_short",
    )


def planting_by_week(plan: DataFrame, grid: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trays planted per crop and week of the grid, 0 where nothing is planted."""
    cells = [*keys, "crop", "week_id"]
    rows = plan.select(*keys, "crop", F.col("plant_week").alias("week_id"), "trays",
                       F.lit(0).alias("_on_grid"))
    empty = grid.select(*cells, F.lit(0).cast("long").alias("trays"), F.lit(1).alias("_on_grid"))
    return (
        rows.unionByName(empty).groupBy(*cells)
        .agg(F.sum("trays").alias("trays_planted"), F.max("_on_grid").alias("_on_grid"))
        .filter(F.col("_on_grid") == 1)
        .drop("_on_grid")
    )


def wip_by_age(
    planted: DataFrame, harvested: DataFrame, params: DataFrame, weeks: int,
    init: DataFrame | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """Stock after harvest by crop, week and age.

    Trays planted in one week (the cohort) keep ``week - age`` fixed. A planting adds
    its trays to every age of its cohort and a harvest takes its trays from the ages
    that follow it, so stock is one sum per cell: no recurrence, window or self-join.
    ``planted`` and ``harvested`` may disagree, for audits.
    """
    cohort = [*keys, "crop", "cohort"]
    planted_in = F.col("plant_week").alias("cohort")
    changes = planted.select(
        *keys, "crop", planted_in, F.col("plant_week").alias("since"), "trays"
    ).unionByName(
        harvested.select(
            *keys, "crop", planted_in, F.col("harvest_week").alias("since"),
            (-F.col("trays")).alias("trays"),
        )
    )
    if init is not None:
        lots = init.join(params.select("crop", "g_max_weeks"), "crop").filter(
            (F.col("age") >= 0) & (F.col("age") < F.col("g_max_weeks"))
        )
        started = -F.col("age")
        changes = changes.unionByName(
            lots.select(*keys, "crop", started.alias("cohort"), started.alias("since"),
                        F.col("qty").alias("trays"))
        )
    top = params.agg(F.max("g_max_weeks")).scalar()
    week = F.col("cohort") + F.col("age")
    return (
        changes.withColumn("_ages", F.sequence(F.lit(0), top))
        .select(*cohort, "since", "trays", F.explode("_ages").alias("age"))
        .filter(week.between(1, weeks))
        .groupBy(*keys, "crop", week.alias("week_id"), "age")
        .agg(F.sum(_when_trays(week >= F.col("since"))).alias("wip"))
    )


def join_age_lag(wip: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Beside each stock cell, the cell it came from: one week and one age before.

    Both cells share ``week - age``, so this is a lag within the cohort.
    """
    cohort = Window.partitionBy(*keys, "crop", F.col("week_id") - F.col("age")).orderBy("week_id")
    return wip.withColumn("previous_wip", F.lag("wip").over(cohort)).filter(
        F.col("previous_wip").isNotNull()
    )


def age_class(params: DataFrame) -> DataFrame:
    """Per crop and age: before, in or past the harvest window."""
    top = params.agg(F.max("g_max_weeks")).scalar()
    age = F.col("age")
    return (
        params.withColumn("_ages", F.sequence(F.lit(0), top))
        .select("crop", "g_min_weeks", "g_max_weeks", F.explode("_ages").alias("age"))
        .select(
            "crop", "age",
            F.when(age < F.col("g_min_weeks"), "before_window")
            .when(age <= F.col("g_max_weeks"), "in_window")
            .otherwise("past_window")
            .alias("age_class"),
        )
    )


def in_window(harvested: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Harvest rows with their age and whether the crop may be harvested at it."""
    age = F.col("harvest_week") - F.col("plant_week")
    return harvested.join(params.select("crop", "g_min_weeks", "g_max_weeks"), "crop").select(
        *keys, "crop", "plant_week", "harvest_week", "trays", age.alias("age"),
        age.between(F.col("g_min_weeks"), F.col("g_max_weeks")).alias("in_window"),
        "g_min_weeks", "g_max_weeks",
    )
