"""Every capacity at which a plan's status or cost changes its course, instead of a grid.

Between two neighbouring capacities of these tables the number of weeks over capacity is
constant and the labor money is a straight line, so any capacity can be read off exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.plans.capacity import overtime_ceiling, shift_hours, with_shift_choice
from greenledger.sources.parameters import Scenario, attach_scenario

#: Capacities that differ by less are one.
PLACES = 9


def _running(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("capacity").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def load_breakpoints(ledger: DataFrame, load: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., capacity, weeks_over): the weeks whose load is above each weekly load, and 0.

    From one capacity up to the next the number of weeks over it stays the same; the
    greatest is the least capacity that every week fits.
    """
    at = F.explode(F.array(
        F.struct(F.lit(0.0).alias("capacity"), F.lit(1).alias("over")),
        F.struct(F.round(F.col(load).cast("double"), PLACES).alias("capacity"), F.lit(-1).alias("over"))))
    steps = ledger.select(*keys, at.alias("at")).groupBy(*keys, "at.capacity").agg(F.sum("at.over").alias("over"))
    return steps.select(*keys, "capacity", F.sum("over").over(_running(keys)).cast("long").alias("weeks_over"))


def labor_breakpoints(
    ledger: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys.., capacity, labor_cost, slope, weeks_over) along the base hours of a week.

    ``ledger`` has planting and harvest hours per week. From one capacity up to the next
    the labor money of all weeks is ``labor_cost + slope * (hours - capacity)``. A week
    changes its course where its hours with the shift off or on meet the base hours or
    the overtime ceiling above them, and where both options cost the same.
    """
    rows = attach_scenario(ledger.select(*keys, "week_id", "plant_hours", "harvest_hours"), scen, keys)
    off, on = shift_hours(False), shift_hours(True)
    saved = F.col("shift_fixed_cost_per_week") - F.col("base_wage_per_hour") * (off - on)
    even = off - F.try_divide(saved, F.col("overtime_premium_per_hour"))
    corners = F.array(F.lit(0.0), off, on, off - overtime_ceiling(), on - overtime_ceiling(), even)
    corners = F.array_sort(F.array_distinct(F.transform(
        F.filter(corners, lambda b: b.isNotNull() & (b >= 0)), lambda b: F.round(b, PLACES))))
    after = F.coalesce(F.get("corners", F.col("pos") + 1), F.col("capacity") + 2.0)
    pieces = rows.withColumn("corners", corners).select("*", F.posexplode("corners").alias("pos", "capacity"))
    # The course of a piece is that of its middle.
    pieces = with_shift_choice(pieces.withColumn("base_labor_hours_per_week", (F.col("capacity") + after) / 2))
    slope = F.when(F.col("overtime_hours") > 0, -F.col("overtime_premium_per_hour")).otherwise(0.0)
    pieces = pieces.withColumn("slope", slope).withColumn(
        "level", F.col("labor_cost") - F.col("slope") * F.col("base_labor_hours_per_week")).withColumn(
        "over", (~F.col("overtime_feasible")).cast("int"))
    before = Window.partitionBy(*keys, "week_id").orderBy("pos")

    def change(name: str) -> Column:
        return (F.col(name) - F.coalesce(F.lag(name).over(before), F.lit(0))).alias(name)

    steps = pieces.select(*keys, "capacity", *(change(c) for c in ("level", "slope", "over")))
    steps = steps.groupBy(*keys, "capacity").agg(*(F.sum(c).alias(c) for c in ("level", "slope", "over")))
    along = _running(keys)
    level, slope = F.sum("level").over(along), F.sum("slope").over(along)
    return steps.select(
        *keys, "capacity", (level + slope * F.col("capacity")).alias("labor_cost"), slope.alias("slope"),
        F.sum("over").over(along).cast("long").alias("weeks_over"))
