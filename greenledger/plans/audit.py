"""Constraint audits of any plan, also of one whose plantings and harvests disagree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.functions.columns import CHECK_TOLERANCE
from greenledger.plans.capacity import overtime_ceiling, with_shift_choice
from greenledger.plans.ledger import (
    crop_ledger,
    in_window,
    sum_weeks,
    valued_ledger,
    wip_by_age,
)
from greenledger.plans.schedule import planted as plantings_of
from greenledger.sources.parameters import Scenario, attach_scenario


def audit_harvest_available(wip: DataFrame) -> DataFrame:
    """Cells where more was harvested than stood there."""
    return wip.filter(F.col("wip") < 0)


def audit_harvest_window(
    harvested: DataFrame, params: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Harvests of trays too young or too old."""
    return in_window(harvested, params, keys).filter(~F.col("in_window") & (F.col("trays") > 0))


def audit_max_age_clear(
    wip: DataFrame, params: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Trays still standing at or past the longest growing time of their crop."""
    return (
        wip.join(params.select("crop", "g_max_weeks"), "crop")
        .filter((F.col("age") >= F.col("g_max_weeks")) & (F.col("wip") > 0))
        .select(*keys, "crop", "week_id", "age", "wip", "g_max_weeks")
    )


def constraint_audit(
    plan: DataFrame, demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame,
    weeks: int, planted: DataFrame | None = None, init: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Every broken constraint: kind, crop, week, age, value and limit.

    Stock checks read one stock table, the other checks one ledger; each row names the
    checks it breaks in one pass.
    """
    if planted is None:
        planted = plantings_of(plan, keys)
    wip = wip_by_age(planted, plan, params, weeks, init, keys)
    valued = valued_ledger(crop_ledger(plan, demand, weeks, keys), params, keys)
    weekly = with_shift_choice(attach_scenario(sum_weeks(valued, keys), scen, keys))

    def check(kind: str, broken: Column, value: Column, limit: Column) -> Column:
        row = F.struct(
            F.lit(kind).alias("kind"), value.cast("double").alias("value"),
            limit.cast("double").alias("limit"),
        )
        return F.when(broken, row)

    def broken_rows(df: DataFrame, *checks: Column, age: Column | None = None,
                    crop: Column | None = None) -> DataFrame:
        no_crop, no_age = F.lit(None).cast("string"), F.lit(None)
        return df.select(
            *keys, (no_crop if crop is None else crop).alias("crop"), "week_id",
            (no_age if age is None else age).cast("int").alias("age"),
            F.explode(F.array_compact(F.array(*checks))).alias("found"),
        ).select(*keys, "found.kind", "crop", "week_id", "age", "found.value", "found.limit")

    crop, age, stock, nothing = F.col("crop"), F.col("age"), F.col("wip"), F.lit(0)
    early = age < F.col("g_min_weeks")
    harvested = in_window(plan, params, keys).withColumnRenamed("harvest_week", "week_id")
    rack, process = F.col("rack_capacity_trays_per_week"), F.col(
        "base_process_capacity_trays_per_week"
    )
    return (
        broken_rows(
            wip.join(params.select("crop", "g_max_weeks"), "crop"),
            check("harvest_available", stock < 0, stock, nothing),
            check("max_age_clear", (age >= F.col("g_max_weeks")) & (stock > 0), stock, nothing),
            age=age, crop=crop,
        )
        .unionByName(
            broken_rows(
                harvested.filter(F.col("week_id").between(1, weeks) & (F.col("trays") > 0)),
                check("harvest_window", ~F.col("in_window"), age,
                      F.when(early, F.col("g_min_weeks")).otherwise(F.col("g_max_weeks"))),
                age=age, crop=crop,
            )
        )
        .unionByName(
            broken_rows(
                valued,
                check("demand_balance", F.col("is_short"), F.col("produced_lbs"),
                      F.col("demand_lbs")),
                crop=crop,
            )
        )
        .unionByName(
            broken_rows(
                weekly,
                check("rack_capacity", F.col("trays_in_stock") > rack + CHECK_TOLERANCE,
                      F.col("trays_in_stock"), rack),
                check("process_capacity", F.col("trays_harvested") > process + CHECK_TOLERANCE,
                      F.col("trays_harvested"), process),
                check("labor_capacity", ~F.col("overtime_feasible"), F.col("overtime_hours"),
                      overtime_ceiling()),
            )
        )
    )
