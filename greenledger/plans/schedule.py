"""Plans: tables (keys.., crop, plant_week, harvest_week, trays), one row per cohort harvest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.functions.columns import effective_yield, trays_needed


def demand_trays(demand: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Demand in whole trays, with the growing window of its crop."""
    return demand.join(params, "crop").select(
        *keys, "crop", "week_id", "g_min_weeks", "g_max_weeks",
        trays_needed(F.col("demand_lbs"), effective_yield()).alias("trays"),
    )


def planned_demand(
    trays: DataFrame, grid: DataFrame, params: DataFrame, safety: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Weekly demand that whole trays can meet: (keys.., crop, week_id, demand_lbs, demand_trays_est).

    ``trays`` counts trays per crop and week. Their sellable pounds, less a safety margin,
    are demand in weeks the crop can be grown by; other cells of the grid have none.
    """
    cells = [*keys, "crop", "week_id"]
    filled = grid.join(trays.select(*cells, "trays"), cells, "left").join(params, "crop")
    counted = F.when(F.col("week_id") > F.col("g_min_weeks"), F.coalesce("trays", F.lit(0))).otherwise(0).cast("long")
    return filled.select(
        *cells, (counted * effective_yield() * F.lit(float(safety))).alias("demand_lbs"),
        counted.alias("demand_trays_est"))


def _plant_before(needed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return needed.select(
        *keys, "crop",
        (F.col("week_id") - F.col("g_min_weeks")).alias("plant_week"),
        F.col("week_id").alias("harvest_week"),
        "trays",
    ).filter((F.col("trays") > 0) & (F.col("plant_week") >= 1))


def back_schedule(demand: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Harvest the fewest trays in each demand week, planted the shortest time before.

    A map over the demand rows. Weeks no planting can reach are left out; the
    feasibility checks report them.
    """
    return _plant_before(demand_trays(demand, params, keys), keys)


def planted(plan: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trays planted per crop and week; initial stock (week 0 and before) is not planting."""
    return plan.filter(F.col("plant_week") >= 1).groupBy(*keys, "crop", "plant_week").agg(
        F.sum("trays").alias("trays")
    )


def initial_lots(
    init: DataFrame, params: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Initial stock per age; lots already at or past the longest growing time drop out."""
    lots = init.join(params.select("crop", "g_min_weeks", "g_max_weeks"), "crop").filter(
        (F.col("qty") > 0) & (F.col("age") >= 0) & (F.col("age") < F.col("g_max_weeks"))
    )
    return lots.groupBy(*keys, "crop", "g_min_weeks", "g_max_weeks", "age").agg(
        F.sum("qty").cast("long").alias("qty")
    )


SERVED = "array<struct<age: int, week_id: int, served: bigint>>"


def _serve(lots: Column, needs: Column, low: Column, high: Column) -> Column:
    """What each lot delivers to each week: weeks in order, each from its oldest fitting lot.

    ``lots`` are (age, qty) from the oldest, ``needs`` (week_id, trays) from the first.
    Older lots open and expire no later than younger ones, so taking the one that
    expires first serves as many trays as any matching can.
    """
    def meetings(n: Column, k: Column) -> Column:
        each = F.transform(lots, lambda lot, j: F.struct(
            j.alias("lot"), k.alias("need"), lot["age"].alias("age"), n["week_id"].alias("week_id")))
        return F.filter(each, lambda m: (m["age"] + m["week_id"]).between(low, high))

    def less(values: Column, at: Column, taken: Column) -> Column:
        return F.transform(values, lambda v, i: F.when(i == at, v - taken).otherwise(v))

    def step(acc: Column, m: Column) -> Column:
        taken = F.least(F.get(acc["lots"], m["lot"]), F.get(acc["needs"], m["need"]))
        row = F.array(F.struct(m["age"].alias("age"), m["week_id"].alias("week_id"),
                               taken.alias("served"))).cast(SERVED)
        return F.struct(
            less(acc["lots"], m["lot"], taken).alias("lots"),
            less(acc["needs"], m["need"], taken).alias("needs"),
            F.concat(acc["served"], row).alias("served"))

    start = F.struct(F.transform(lots, lambda lot: lot["qty"]).alias("lots"),
                     F.transform(needs, lambda n: n["trays"]).alias("needs"),
                     F.array().cast(SERVED).alias("served"))
    return F.aggregate(F.flatten(F.transform(needs, meetings)), start, step, lambda acc: acc["served"])


def initial_wip_fifo(
    demand: DataFrame, init: DataFrame, params: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Serve what initial stock can serve, oldest lots first, and plant for the rest.

    Each lot serves only weeks at which its age is inside the growing window, so no lot
    is used up by a week it cannot serve. What a lot does not deliver is harvested at
    the longest growing time. Only weeks up to the longest growing time can meet initial
    stock, so the two arrays of a crop have at most that many entries each.
    """
    lots = initial_lots(init, params, keys)
    needed = demand_trays(demand, params, keys).filter(F.col("trays") > 0)
    stock = lots.groupBy(*keys, "crop", "g_min_weeks", "g_max_weeks").agg(
        F.sort_array(F.collect_list(F.struct(F.col("age").cast("int").alias("age"), "qty")), asc=False)
        .alias("lots"))
    early = needed.filter(F.col("week_id") <= F.col("g_max_weeks")).groupBy(*keys, "crop").agg(
        F.sort_array(F.collect_list(F.struct(F.col("week_id").cast("int").alias("week_id"), "trays")))
        .alias("needs"))
    served = (
        stock.join(early, [*keys, "crop"])
        .select(*keys, "crop", "g_min_weeks", "g_max_weeks", F.inline(_serve(
            F.col("lots"), F.col("needs"), F.col("g_min_weeks"), F.col("g_max_weeks"))))
        .filter("served > 0")
        .select(*keys, "crop", "age", "week_id", "g_min_weeks", "g_max_weeks", "served")
    )
    used = served.select(
        *keys, "crop", (-F.col("age")).alias("plant_week"),
        F.col("week_id").alias("harvest_week"), F.col("served").alias("trays"),
    )
    unused = (
        lots.select(*keys, "crop", "age", "g_max_weeks", F.col("qty").alias("trays"))
        .unionByName(served.select(*keys, "crop", "age", "g_max_weeks",
                                   (-F.col("served")).alias("trays")))
        .groupBy(*keys, "crop", "age", "g_max_weeks")
        .agg(F.sum("trays").alias("trays"))
        .filter(F.col("trays") > 0)
        .select(*keys, "crop", (-F.col("age")).alias("plant_week"),
                (F.col("g_max_weeks") - F.col("age")).alias("harvest_week"), "trays")
    )
    window = [*keys, "crop", "week_id", "g_min_weeks"]
    rest = _plant_before(
        needed.select(*window, "trays")
        .unionByName(served.select(*window, (-F.col("served")).alias("trays")))
        .groupBy(*window)
        .agg(F.sum("trays").alias("trays")),
        keys,
    )
    return (
        used.unionByName(unused)
        .groupBy(*keys, "crop", "plant_week", "harvest_week")
        .agg(F.sum("trays").alias("trays"))
        .unionByName(rest)
    )
