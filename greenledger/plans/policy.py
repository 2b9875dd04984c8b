"""Choosing an age offset per crop when there are too many combinations to rate each.

Crops meet only in the weekly loads on racks and labor. A price per week on both makes
the crops independent: each takes its cheapest offset alone, and the prices of weeks that
are over capacity rise. The policies met on the way are rated exactly, and the best of
them is improved by changing one crop at a time. Work grows with crops times offsets
times weeks, whatever the number of combinations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.functions.columns import clamp
from greenledger.operators.rollup import join_price
from greenledger.plans.capacity import overtime_ceiling, with_shift_choice
from greenledger.plans.costs import with_week_costs
from greenledger.plans.ledger import WEEK_SUMS, crop_ledger, valued_ledger
from greenledger.plans.selection import certify, offset_plans
from greenledger.session import written
from greenledger.sources.parameters import Scenario, attach_scenario

#: What adds up over the crops of a week.
LOADS = (*WEEK_SUMS, "short_cells", "early_cells", "negative_rate_cells")
ROUNDS, PASSES = 6, 4


def offset_loads(
    demand: DataFrame, params: DataFrame, weeks: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """What each crop does in each week at each offset of its window, alone."""
    width = F.col("g_max_weeks") - F.col("g_min_weeks")
    wanted = demand.join(params.select("crop", "g_min_weeks", "g_max_weeks"), "crop").select(
        *keys, "crop", "week_id", "demand_lbs", F.explode(F.sequence(F.lit(0), width)).alias("age_offset"))
    by = [*keys, "age_offset"]
    valued = valued_ledger(crop_ledger(offset_plans(demand, params, keys), wanted, weeks, by), params, by)
    return valued.select(
        *keys, "crop", "age_offset", "week_id", *(F.col(c).cast("double").alias(c) for c in WEEK_SUMS),
        F.col("is_short").cast("double").alias("short_cells"), F.col("is_early").cast("double").alias("early_cells"),
        F.col("has_negative_rate").cast("double").alias("negative_rate_cells"))


def _summed(loads: DataFrame, by: Sequence[str]) -> DataFrame:
    return loads.groupBy(*by, "week_id").agg(*(F.sum(c).alias(c) for c in LOADS))


def _rated(loads: DataFrame, price: DataFrame, scen: Scenario | DataFrame, weeks: int | None,
           keys: Sequence[str], trial: str) -> DataFrame:
    """(keys.., trial, rank): the lower the rank, the better; feasible ones come first."""
    weekly = attach_scenario(join_price(loads, price, keys, weeks), scen, keys)
    rated = certify(with_week_costs(with_shift_choice(weekly)), [*keys, trial])
    broken = F.when(F.col("status").isin("optimal", "feasible_gap"), F.lit(0).cast("long")).otherwise(
        1 + F.col("rack_over_weeks") + F.col("process_over_weeks") + F.col("labor_over_weeks"))
    # Costs that differ only by the order of addition must tie, so they are rounded.
    return rated.select(*keys, trial, F.struct(
        broken.alias("broken"), F.round("total_cost", 4).alias("cost")).alias("rank"), "total_cost")


def _prices(chosen: DataFrame, old: DataFrame | None, unit: DataFrame, scen: Scenario | DataFrame,
            keys: Sequence[str], step: float) -> DataFrame:
    """(keys.., week_id, rack_price, labor_price) after a policy was met, from its loads."""
    weekly = attach_scenario(chosen.join(unit, list(keys)) if keys else chosen.withColumn(
        "unit", unit.scalar()), scen, keys)
    if old is None:
        weekly = weekly.withColumns({"rack_price": F.lit(0.0), "labor_price": F.lit(0.0)})
    else:
        weekly = weekly.join(old, [*keys, "week_id"])
    rack_cap = F.greatest("rack_capacity_trays_per_week", F.lit(1.0))
    hours = F.col("plant_hours") + F.col("harvest_hours") * (1 - F.col("shift_labor_reduction_pct"))
    base = F.greatest("base_labor_hours_per_week", F.lit(1.0))
    full = F.col("base_labor_hours_per_week") + overtime_ceiling()
    over_rack = (F.col("trays_in_stock") - rack_cap) / rack_cap
    over_labor = F.when(hours > full, (hours - full) / base + 0.1).otherwise((hours - base) / base)
    rack = clamp(F.col("rack_price") + step * 20 * F.col("unit") * over_rack, 0.0)
    labor = clamp(F.col("labor_price") + step * 20 * F.col("overtime_premium_per_hour") * over_labor, 0.0)
    # Overtime within its ceiling is never worth more than its premium.
    labor = F.when(hours <= full, F.least(labor, F.col("overtime_premium_per_hour"))).otherwise(labor)
    return weekly.select(*keys, "week_id", rack.alias("rack_price"), labor.alias("labor_price"))


def policy_choice(
    demand: DataFrame, params: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (), rounds: int = ROUNDS, passes: int = PASSES,
) -> DataFrame:
    """(keys.., crop, age_offset, total_cost, feasible): the offsets chosen for each key.

    ``rounds`` price steps and at most ``passes`` single changes are made. A policy that is
    called feasible is, by the same audit as any plan; that no feasible one was met proves
    nothing. Each step is written, so a lost executor costs one step.
    """
    names = list(keys)
    crop_offset = [*names, "crop", "age_offset"]
    loads = written(offset_loads(demand, params, weeks, keys))
    # What the crop pays for its weeks whatever the other crops do.
    own = attach_scenario(join_price(loads, price, keys, weeks), scen, keys).select(
        *crop_offset, "week_id", "trays_in_stock", "plant_hours",
        (F.col("seed_cost") + F.col("nutrient_cost") + F.col("price_per_kwh") * F.col("energy_kwh")
         + F.col("disposal_cost_per_lb_waste") * F.col("waste_lbs")
         + F.col("base_wage_per_hour") * F.col("plant_hours")).alias("own_cost"))
    own = written(own)
    first = own.filter("age_offset = 0").groupBy(*names).agg(
        F.coalesce(F.try_divide(F.sum("own_cost"), F.sum("trays_in_stock")), F.lit(0.0)).alias("unit"))

    def cheapest(prices: DataFrame | None) -> DataFrame:
        each = own if prices is None else own.join(prices, [*names, "week_id"])
        money = F.col("own_cost")
        if prices is not None:
            money = money + F.col("rack_price") * F.col("trays_in_stock") + F.col("labor_price") * F.col("plant_hours")
        scored = each.groupBy(*crop_offset).agg(F.round(F.sum(money), 4).alias("score"))
        return scored.groupBy(*names, "crop").agg(
            F.min_by("age_offset", F.struct("score", "age_offset")).alias("age_offset"))

    tried, prices = None, None
    for k in range(rounds):
        policy = written(cheapest(prices).withColumn("trial", F.lit(k)))
        tried = policy if tried is None else tried.unionByName(policy)
        if k + 1 < rounds:
            chosen = _summed(loads.join(policy.drop("trial"), crop_offset), names)
            prices = written(_prices(chosen, prices, first, scen, keys, 1.0 / (k + 1)))
    rated = _rated(_summed(loads.join(tried, crop_offset), [*names, "trial"]), price, scen, weeks, keys, "trial")
    best = rated.groupBy(*names).agg(F.min(F.struct("rank", "trial", "total_cost")).alias("best"))
    best = best.select(*names, "best.trial", "best.rank", "best.total_cost")
    policy = written(tried.join(best, [*names, "trial"]).drop("trial"))
    for _ in range(passes):
        better = written(_one_change(loads, policy, price, scen, weeks, keys))
        if not better.head(1):
            break
        policy = written(_changed(policy, better, names))
    return policy.select(*crop_offset, "total_cost", (F.col("rank.broken") == 0).alias("feasible"))


def _one_change(loads: DataFrame, policy: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
                weeks: int | None, keys: Sequence[str]) -> DataFrame:
    """(keys.., changed crop, its new offset, rank, total_cost) where one change helps."""
    names = list(keys)
    now = loads.join(policy.select(*names, "crop", F.col("age_offset").alias("now")), [*names, "crop"])
    current = now.filter("age_offset = now").drop("now", "age_offset")
    other = now.filter("age_offset <> now")
    move = F.struct("crop", "age_offset").alias("move")
    moves = other.select(*names, move).distinct()
    # The loads after a move: all crops, less the crop's own, more its other offset.
    totals = _summed(current, names)
    whole = totals.join(moves, names) if names else totals.crossJoin(moves)
    less = current.join(moves.withColumn("crop", F.col("move.crop")), [*names, "crop"])
    parts = whole.select(*names, "move", "week_id", *LOADS).unionByName(
        other.select(*names, move, "week_id", *LOADS)).unionByName(
        less.select(*names, "move", "week_id", *((-F.col(c)).alias(c) for c in LOADS)))
    rated = _rated(_summed(parts, [*names, "move"]), price, scen, weeks, keys, "move")
    best = rated.groupBy(*names).agg(F.min(F.struct("rank", "move", "total_cost")).alias("best"))
    rank = policy.groupBy(*names).agg(F.min("rank").alias("rank"))
    both = best.join(rank, names) if names else best.crossJoin(rank)
    return both.filter(F.col("best.rank") < F.col("rank")).select(
        *names, F.col("best.move.crop").alias("crop"), F.col("best.move.age_offset").alias("new"),
        F.col("best.rank").alias("new_rank"), F.col("best.total_cost").alias("new_cost"))


def _changed(policy: DataFrame, better: DataFrame, names: Sequence[str]) -> DataFrame:
    """The policy with one crop's offset replaced, and its new rank on every row of the key."""
    ranks = better.select(*names, "new_rank", "new_cost")
    out = policy.join(better.select(*names, "crop", "new"), [*names, "crop"], "left")
    out = out.join(ranks, list(names), "left") if names else out.crossJoin(ranks)

    def replaced(new: str, old: str) -> Column:
        return F.coalesce(new, old).alias(old)

    return out.select(*names, "crop", replaced("new", "age_offset"), replaced("new_rank", "rank"),
                      replaced("new_cost", "total_cost"))


def policy_plan(
    demand: DataFrame, params: DataFrame, choice: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """The plan rows of chosen offsets, for the keys whose policy is feasible."""
    chosen = choice.filter("feasible").select(*keys, "crop", "age_offset")
    return offset_plans(demand, params, keys).join(chosen, [*keys, "crop", "age_offset"]).select(
        *keys, "crop", "plant_week", "harvest_week", "trays")
