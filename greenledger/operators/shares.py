"""Shares of a week: what fits, which crops take part, and whole trays by weight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.functions.columns import clamp
from greenledger.sources.parameters import mean_crop_profile

# Fixed value: the least target of a week.
MIN_TARGET_TRAYS = 8


def tray_limit(entities: DataFrame, params: DataFrame) -> DataFrame:
    """Trays a week the tightest capacity allows, and the target for demand."""
    profile = mean_crop_profile(params)
    overtime = F.aggregate("overtime_block_hours", F.lit(0.0), lambda acc, h: acc + h)
    sized = entities.withColumns(
        {
            "avg_grow_weeks": profile.select("avg_grow_weeks").scalar(),
            "avg_labor_hours": profile.select("avg_labor_hours").scalar(),
        }
    ).withColumn(
        "tray_limit",
        clamp(
            F.least(
                F.col("rack_capacity_trays_per_week") / clamp(F.col("avg_grow_weeks"), 1.0),
                F.col("base_process_capacity_trays_per_week"),
                (F.col("base_labor_hours_per_week") + overtime)
                / clamp(F.col("avg_labor_hours"), 1e-6),
            ),
            1.0,
        ),
    )
    target = F.bround(F.col("tray_limit") * F.col("utilization_target")).cast("long")
    return sized.withColumn(
        "target_total_trays", clamp(target, F.lit(MIN_TARGET_TRAYS).cast("long"))
    )


def eligible(grid: DataFrame, params: DataFrame) -> DataFrame:
    """Grid cells in which a crop planted in week 1 can already be harvested."""
    return grid.join(params, "crop").filter(F.col("week_id") > F.col("g_min_weeks"))


def normalized(df: DataFrame, weight: str, by: Sequence[str]) -> DataFrame:
    """Scale weights to sum 1 in each group, or 0 where all are 0. A group is the crops
    of one week, so a window never holds more rows than that."""
    total = F.sum(weight).over(Window.partitionBy(*by))
    return df.withColumn(weight, F.coalesce(F.try_divide(F.col(weight), total), F.lit(0.0)))


def apportion(
    df: DataFrame, total: str, weight: str, by: Sequence[str], tie: str = "crop",
    out: str = "trays",
) -> DataFrame:
    """Split an integer total over weights that sum to 1 by largest remainder; a weight
    of 0 gets nothing."""
    group = Window.partitionBy(*by)
    whole = F.floor(F.col(total) * F.col(weight))
    # The remainder is rounded so that equal shares tie, and the tie goes by name.
    part = F.round(F.col(total) * F.col(weight) - whole, 9)
    ranked = df.withColumns({"_whole": whole, "_part": part}).withColumns(
        {
            "_left": F.col(total) - F.sum("_whole").over(group),
            "_rank": F.row_number().over(group.orderBy(F.desc("_part"), F.asc(tie))),
        }
    )
    takes_one = (F.col("_rank") <= F.col("_left")) & (F.col(weight) > 0)
    extra = F.when(takes_one, 1).otherwise(0)
    return ranked.withColumn(out, (F.col("_whole") + extra).cast("long")).drop(
        "_whole", "_part", "_left", "_rank"
    )


def active_flag() -> Column:
    return F.col("active_trays") > 0
