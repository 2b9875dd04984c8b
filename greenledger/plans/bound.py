"""A lower bound on the cost of any plan that counts overtime.

The certificate's bound takes overtime as free. Here a price per week on planting and
harvest hours, between 0 and the overtime premium, stands for it: whatever the prices,
priced hours less the priced base hours never exceed the premium that a plan pays. Given
the prices each demand cell takes its cheapest age alone, so the bound is a sum; the
prices follow the hours that the cheapest ages use, and the best bound met is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenledger.functions.columns import clamp, effective_yield, trays_needed
from greenledger.operators.rollup import join_price
from greenledger.session import written
from greenledger.sources.parameters import Scenario, attach_scenario

#: How far prices move in the first round, per share of the base hours that lacks.
STEP = 4.0
ROUNDS = 8


def planting_options(
    demand: DataFrame, params: DataFrame, price: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Each demand cell at each age of its window: what its trays cost apart from labor."""
    cell = [*keys, "crop", "harvest_week"]
    cells = demand.join(params, "crop").select(
        *keys, "crop", F.col("week_id").alias("harvest_week"), "g_min_weeks", "g_max_weeks",
        trays_needed(F.col("demand_lbs"), effective_yield()).alias("trays"), "demand_lbs",
        effective_yield().alias("yield_lbs"), "plant_hours_per_tray", "harvest_hours_per_tray",
        "seed_cost_per_tray", "nutrient_cost_per_tray_week", "energy_kwh_per_tray_week",
    ).filter((F.col("trays") > 0) & (F.col("harvest_week") > F.col("g_min_weeks")))
    aged = cells.withColumn("age", F.explode(F.sequence(
        "g_min_weeks", F.least(F.col("g_max_weeks"), F.col("harvest_week") - 1))))
    standing = aged.withColumn("week_id", F.explode(F.sequence(
        F.col("harvest_week") - F.col("age"), F.col("harvest_week") - 1)))
    priced = join_price(standing, price, keys, weeks)
    kwh = F.sum(F.col("price_per_kwh") * F.col("energy_kwh_per_tray_week"))
    trays = F.first("trays")
    return priced.groupBy(*cell, "age").agg(
        (F.first("harvest_week") - F.first("age")).cast("int").alias("plant_week"),
        (trays * (F.first("seed_cost_per_tray") + F.first("nutrient_cost_per_tray_week") * F.first("age") + kwh))
        .alias("tray_cost"),
        (trays * F.first("plant_hours_per_tray")).alias("plant_hours"),
        (trays * F.first("harvest_hours_per_tray")).alias("harvest_hours"),
        (trays * F.first("yield_lbs") - F.first("demand_lbs")).alias("waste_lbs"),
    ).select(*cell, F.col("age").cast("int").alias("age"), "plant_week", "tray_cost", "plant_hours",
             "harvest_hours", "waste_lbs")


def overtime_bound(
    demand: DataFrame, params: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (), rounds: int = ROUNDS,
) -> DataFrame:
    """(keys.., free_overtime_bound, overtime_bound): bounds no plan of the demand beats.

    The first takes overtime as free, as the certificate does; the second is the best one
    of ``rounds`` price steps and never less. Rates must not be negative.
    """
    names = list(keys)
    cell = [*names, "crop", "harvest_week"]
    options = written(planting_options(demand, params, price, weeks, keys))
    once = options.groupBy(*cell).agg(F.first("harvest_hours").alias("harvest_hours"),
                                      F.first("waste_lbs").alias("waste_lbs"))
    zero = F.lit(0.0)
    weekly = once.select(*names, F.col("harvest_week").alias("week"), "harvest_hours", "waste_lbs").unionByName(
        options.select(*names, F.col("plant_week").alias("week"), zero.alias("harvest_hours"),
                       zero.alias("waste_lbs")))
    weekly = written(attach_scenario(weekly.groupBy(*names, "week").agg(
        F.sum("harvest_hours").alias("harvest_hours"), F.sum("waste_lbs").alias("waste_lbs")), scen, keys))
    rate = F.col("base_wage_per_hour") + F.col("hour_price")
    off = rate * F.col("harvest_hours")
    on = off * (1 - F.col("shift_labor_reduction_pct")) + F.col("shift_fixed_cost_per_week")
    base = F.col("base_labor_hours_per_week")
    wages = weekly.select(*names, F.col("week").alias("plant_week"), "base_wage_per_hour")
    prices = weekly.select(*names, "week", zero.alias("hour_price"))
    bounds = None
    for k in range(rounds):
        priced = options.join(prices.withColumnRenamed("week", "plant_week"), [*names, "plant_week"]).join(
            wages, [*names, "plant_week"])
        money = F.col("tray_cost") + (F.col("base_wage_per_hour") + F.col("hour_price")) * F.col("plant_hours")
        chosen = priced.groupBy(*cell).agg(F.min(F.struct(
            F.round(money, 6).alias("rank"), F.col("age"), F.col("plant_week"), F.col("plant_hours"),
            money.alias("money"))).alias("best"))
        planted = chosen.groupBy(*names, F.col("best.plant_week").alias("week")).agg(
            F.sum("best.plant_hours").alias("plant_hours"), F.sum("best.money").alias("money"))
        met = weekly.join(prices, [*names, "week"]).join(planted, [*names, "week"], "left").fillna(
            0.0, ["plant_hours", "money"])
        used = F.col("plant_hours") + F.when(on < off, F.col("harvest_hours") * (
            1 - F.col("shift_labor_reduction_pct"))).otherwise(F.col("harvest_hours"))
        step = F.lit(STEP / (k + 1)) * F.col("overtime_premium_per_hour") * (used - base) / F.greatest(base, F.lit(1.0))
        met = written(met.select(
            *names, "week", F.lit(k).alias("round"),
            (F.col("money") + F.least(off, on) - F.col("hour_price") * base
             + F.col("disposal_cost_per_lb_waste") * F.col("waste_lbs")).alias("part"),
            clamp(F.col("hour_price") + step, 0.0, F.col("overtime_premium_per_hour")).alias("hour_price")))
        prices = met.select(*names, "week", "hour_price")
        total = met.groupBy(*names, "round").agg(F.sum("part").alias("bound"))
        bounds = total if bounds is None else bounds.unionByName(total)
    return bounds.groupBy(*names).agg(
        F.max(F.when(F.col("round") == 0, F.col("bound"))).alias("free_overtime_bound"),
        F.max("bound").alias("overtime_bound"))
