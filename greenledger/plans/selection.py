"""Which plan to take: certificate, scenario sweep and policy sweep."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.functions.columns import CHECK_TOLERANCE, effective_yield, trays_needed
from greenledger.operators.rollup import join_price
from greenledger.plans.capacity import with_shift_choice
from greenledger.plans.costs import evaluate_weeks, with_week_costs
from greenledger.plans.ledger import crop_ledger, sum_weeks, valued_ledger, week_ledger
from greenledger.plans.schedule import back_schedule
from greenledger.session import spread
from greenledger.sources.parameters import RATING_COLUMNS, Scenario, attach_scenario

GAP_TOLERANCE = 1e-6


def _over(used: str, capacity: str) -> Column:
    return F.col(used) > F.col(capacity) + CHECK_TOLERANCE


def _negative_rate() -> Column:
    """Whether a week's rates, wherever they come from, break the bound."""
    reduction = F.col("shift_labor_reduction_pct")
    return (F.least("base_wage_per_hour", "overtime_premium_per_hour", "shift_fixed_cost_per_week",
                    "disposal_cost_per_lb_waste", "price_per_kwh") < 0) | (reduction < 0) | (reduction > 1)


def certify(
    evaluated: DataFrame, keys: Sequence[str] = (), initial_stock: bool = False
) -> DataFrame:
    """Cost, lower bound, gap and status of an evaluated back-scheduled plan.

    Trays, growing time, waste and hours of that plan are least possible, so only
    its labor money can be improved, and never below the labor floor. The gap is
    summed week by week, so it is exactly 0 where no week pays above its floor.
    Without initial stock:

    * ``infeasible_proven``: demand comes too early or cannot be produced, or the
      least possible rack or process use is over its cap;
    * ``optimal``: feasible and no gap;
    * ``feasible_gap``: feasible, cheaper plans are not ruled out;
    * ``undecided``: only labor does not fit; an earlier planting may still work.

    With initial stock the bound does not hold, so the status is only ``feasible`` or
    ``undecided``. Nor does it with a negative rate, or a shift that adds hours: bound and
    gap are null then, and no plan is called optimal.
    """
    summed = evaluated.groupBy(*keys).agg(
        F.sum("total_cost").alias("total_cost"),
        F.sum(F.col("labor_cost") - F.col("labor_cost_floor")).alias("gap"),
        F.sum("early_cells").alias("early_cells"),
        F.sum("short_cells").alias("short_cells"),
        F.count_if(_over("trays_in_stock", "rack_capacity_trays_per_week")).alias(
            "rack_over_weeks"
        ),
        F.count_if(_over("trays_harvested", "base_process_capacity_trays_per_week")).alias(
            "process_over_weeks"
        ),
        F.count_if(~F.col("overtime_feasible")).alias("labor_over_weeks"),
        (F.sum("negative_rate_cells") + F.count_if(_negative_rate())).alias("negative_rates"),
    )
    over_cap = F.greatest("short_cells", "rack_over_weeks", "process_over_weeks") > 0
    short_of_labor = F.col("labor_over_weeks") > 0
    bounded = F.col("negative_rates") == 0
    if initial_stock:
        status = F.when(over_cap | short_of_labor, "undecided").otherwise("feasible")
    else:
        status = (
            F.when(over_cap | (F.col("early_cells") > 0), "infeasible_proven")
            .when(short_of_labor, "undecided")
            .when((F.col("gap") <= GAP_TOLERANCE) & bounded, "optimal")
            .otherwise("feasible_gap")
        )
    return summed.select(
        *keys, "total_cost", F.when(bounded, F.col("total_cost") - F.col("gap")).alias("lower_bound"),
        F.when(bounded, F.col("gap")).alias("gap"),
        "early_cells", "rack_over_weeks", "process_over_weeks", "labor_over_weeks",
        status.alias("status"),
    )


def plan_certificate(
    demand: DataFrame, params: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    plan = back_schedule(demand, params, keys)
    return certify(evaluate_weeks(plan, demand, params, price, scen, weeks, keys), keys)


def plan_summary(certificate: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Objective, status and feasibility in the shape of a solve summary."""
    feasible = F.col("status").isin("optimal", "feasible_gap", "feasible")
    return certificate.select(
        *keys,
        F.when(feasible, F.col("total_cost")).alias("objective_value"),
        F.when(feasible, "ok").otherwise("warning").alias("solver_status"),
        F.col("status").alias("termination_condition"),
        feasible.alias("feasible"),
    )


def expand_scenarios(
    df: DataFrame, base: Scenario, knobs: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Every row under every combination of knob values, made by generators.

    A knob is a scenario field or ``price_factor``, which scales the energy price.
    """
    unknown = set(knobs) - set(RATING_COLUMNS) - {"price_factor"}
    if unknown:
        raise ValueError(f"not a knob: {sorted(unknown)}")
    fixed = {n: c for n, c in base.as_columns(RATING_COLUMNS).items() if n not in knobs}
    df = df.withColumns(fixed)
    for name, values in knobs.items():
        items = [v.cast("double") if isinstance(v, Column) else F.lit(float(v)) for v in values]
        df = df.withColumn("_values", F.array(*items)).select(
            "*", F.explode("_values").alias(name)
        ).drop("_values")
    return df


def scenario_sweep(
    demand: DataFrame, params: DataFrame, price: DataFrame, base: Scenario,
    knobs: Mapping[str, Sequence[float]], weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """Cost, certificate and feasibility for a grid of capacities, wages and prices.

    The plan does not depend on the knobs, so its week ledger is made once and only
    that short table meets the grid.
    """
    plan = back_schedule(demand, params, keys)
    ledger = week_ledger(plan, demand, params, price, weeks, keys)
    swept = expand_scenarios(spread(ledger, *keys, "week_id"), base, knobs)
    if "price_factor" in knobs:
        swept = swept.withColumn("price_per_kwh", F.col("price_per_kwh") * F.col("price_factor"))
    group = [*keys, *knobs]
    result = certify(with_week_costs(with_shift_choice(swept)), group)
    return result.withColumn("feasible", F.col("status").isin("optimal", "feasible_gap"))


def monotone_check(
    sweep: DataFrame, others: Sequence[str], knob: str = "rack_capacity_trays_per_week"
) -> DataFrame:
    """Feasible rows with the cost at the next smaller knob value; more must not cost more."""
    smaller = Window.partitionBy(*others).orderBy(knob)
    return sweep.filter("feasible").select(
        *others, knob, "total_cost", F.lag("total_cost").over(smaller).alias("previous_cost")
    ).withColumn(
        "monotone",
        F.coalesce(F.col("total_cost") <= F.col("previous_cost") + GAP_TOLERANCE, F.lit(True)),
    )


def policy_digits(params: DataFrame) -> DataFrame:
    """Mixed-radix code of the age offsets: per crop its width and stride, and how many
    policies there are. One row per crop."""
    crops = F.array_sort(
        F.collect_list(
            F.struct(
                "crop",
                (F.col("g_max_weeks") - F.col("g_min_weeks") + 1).cast("long").alias("width"),
            )
        )
    )

    def product(part: Column) -> Column:
        return F.aggregate(part, F.lit(1).cast("long"), lambda acc, c: acc * c["width"])

    coded = F.transform(
        "crops",
        lambda c, i: F.struct(
            c["crop"].alias("crop"),
            c["width"].alias("width"),
            product(F.slice("crops", F.lit(1), i)).alias("stride"),
        ),
    )
    return (
        params.agg(crops.alias("crops"))
        .select(product(F.col("crops")).alias("policies"), F.inline(coded))
    )


def offset_plans(
    demand: DataFrame, params: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Back-scheduled plan of each crop at each age offset its window allows.

    A planting that would fall before week 1 moves to week 1.
    """
    offsets = F.sequence(F.lit(0), F.col("g_max_weeks") - F.col("g_min_weeks"))
    trays = trays_needed(F.col("demand_lbs"), effective_yield())
    age = F.least(F.col("g_min_weeks") + F.col("age_offset"), F.col("week_id") - 1)
    return (
        demand.join(params, "crop")
        .withColumn("trays", trays)
        .filter((F.col("trays") > 0) & (F.col("week_id") > F.col("g_min_weeks")))
        .select(*keys, "crop", "week_id", "g_min_weeks", "trays",
                F.explode(offsets).alias("age_offset"))
        .select(*keys, "crop", "age_offset", (F.col("week_id") - age).alias("plant_week"),
                F.col("week_id").alias("harvest_week"), "trays")
    )


def evaluate_policies(
    demand: DataFrame, params: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """Cost and feasibility of every combination of per-crop age offsets.

    Loads add up over crops, so the ledger is made once per crop and offset. Each of
    its rows then writes out the codes of the policies that use its offset: no
    policy table is joined, and the sums combine on the map side.
    """
    width = F.col("g_max_weeks") - F.col("g_min_weeks")
    by_offset = demand.join(params.select("crop", "g_min_weeks", "g_max_weeks"), "crop").select(
        *keys, "crop", "week_id", "demand_lbs",
        F.explode(F.sequence(F.lit(0), width)).alias("age_offset"),
    )
    offset_keys = [*keys, "age_offset"]
    ledger = crop_ledger(offset_plans(demand, params, keys), by_offset, weeks, offset_keys)
    valued = spread(valued_ledger(ledger, params, offset_keys), *offset_keys, "crop", "week_id")
    coded = valued.join(policy_digits(params), "crop")
    index, stride = F.col("index"), F.col("stride")
    policy = (
        F.floor(index / stride) * stride * F.col("width")
        + F.col("age_offset") * stride
        + index % stride
    ).cast("long")
    codes = coded.select(
        "*",
        F.explode(F.sequence(F.lit(0).cast("long"),
                             F.floor(F.col("policies") / F.col("width")) - 1)).alias("index"),
    ).withColumn("policy", policy)
    weekly = sum_weeks(codes, [*keys, "policy"])
    priced = attach_scenario(join_price(weekly, price, keys, weeks), scen, keys)
    rated = certify(with_week_costs(with_shift_choice(priced)), [*keys, "policy"])
    return rated.select(
        *keys, "policy", "total_cost",
        F.col("status").isin("optimal", "feasible_gap").alias("feasible"),
    )


def policy_sweep(
    demand: DataFrame, params: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """The cheapest feasible policy (lowest code on a tie) and how many were feasible."""
    rated = evaluate_policies(demand, params, price, scen, weeks, keys)
    # Costs that differ only by the order of addition must tie, so they are rounded.
    ranked = F.struct(F.round("total_cost", 4).alias("rank_cost"), "policy", "total_cost")
    best = F.when(F.col("feasible"), ranked)
    return rated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("policies"),
        F.count_if("feasible").alias("feasible_policies"),
        F.min(best).alias("_best"),
    ).select(
        *keys, "policies", "feasible_policies",
        F.col("_best.policy").alias("best_policy"), F.col("_best.total_cost").alias("best_cost"),
    )
