"""Plans when labor is short: plantings moved to earlier weeks, and proofs that none fits.

Demand fixes the harvest weeks, so it fixes the harvest hours. What is free is the
planting week of each tray inside its growing window. A week offers its base hours and
all overtime, less the harvest hours at their least (with the shift on).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenledger.functions.columns import CHECK_TOLERANCE, effective_yield, trays_needed
from greenledger.plans.capacity import overtime_ceiling
from greenledger.plans.costs import evaluate_weeks
from greenledger.plans.schedule import back_schedule
from greenledger.plans.selection import GAP_TOLERANCE, certify
from greenledger.sources.parameters import Scenario, attach_scenario

JOB = "struct<earliest: int, harvest_week: int, crop: string, hours: double, trays: bigint>"
PLANTED = "struct<crop: string, plant_week: int, harvest_week: int, trays: bigint>"


def planting_jobs(demand: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Whole trays per demand cell, with the first and last week they can be planted in."""
    cells = demand.join(params, "crop").select(
        *keys, "crop", F.col("week_id").cast("int").alias("harvest_week"),
        F.greatest(F.col("week_id") - F.col("g_max_weeks"), F.lit(1)).cast("int").alias("earliest"),
        (F.col("week_id") - F.col("g_min_weeks")).cast("int").alias("latest"),
        F.col("plant_hours_per_tray").alias("hours"), "harvest_hours_per_tray",
        trays_needed(F.col("demand_lbs"), effective_yield()).alias("trays"),
    )
    return cells.filter((F.col("trays") > 0) & (F.col("latest") >= 1))


def _planting_capacity(harvest_hours: Column) -> Column:
    """Hours a week can spend on planting, from the scenario columns."""
    share = F.least(F.lit(1.0), F.lit(1.0) - F.col("shift_labor_reduction_pct"))
    return F.col("base_labor_hours_per_week") + overtime_ceiling() - harvest_hours * share


def _job_weeks(jobs: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per week that any job touches: the capacity for planting and the jobs that end there."""
    none = F.lit(None).cast(JOB)
    job = F.struct("earliest", "harvest_week", "crop", "hours", "trays").cast(JOB)
    harvest = F.array(F.struct(
        F.col("harvest_week").alias("week"),
        (F.col("trays") * F.col("harvest_hours_per_tray")).alias("harvest_hours"), none.alias("job")))
    window = F.transform(F.sequence("earliest", "latest"), lambda w: F.struct(
        w.alias("week"), F.lit(0.0).alias("harvest_hours"), F.when(w == F.col("latest"), job).alias("job")))
    weekly = jobs.select(*keys, F.inline(F.concat(harvest, window))).groupBy(*keys, "week").agg(
        F.sum("harvest_hours").alias("harvest_hours"), F.collect_list("job").alias("jobs"))
    return attach_scenario(weekly, scen, keys).select(
        *keys, "week", _planting_capacity(F.col("harvest_hours")).alias("capacity"), "jobs")


def _plant_latest_first(weeks: Column) -> Column:
    """Plant each week what fits, from the last week to the first; the rest moves a week back.

    ``weeks`` are (week, capacity, jobs) in falling order. Of the jobs that can be planted
    in a week, those with the fewest weeks left before it go first (backwards in time: the
    earliest deadline). A job that has no week left is planted whatever the capacity.
    """
    def one(flag: Column, item: Column, kind: str) -> Column:
        return F.when(flag, F.array(item)).otherwise(F.array()).cast(f"array<{kind}>")

    def week_step(acc: Column, w: Column) -> Column:
        pool = F.sort_array(F.concat(acc["waiting"], w["jobs"]), asc=False)

        def job_step(state: Column, job: Column) -> Column:
            free = F.greatest(F.floor(F.try_divide(
                state["left"] + F.lit(CHECK_TOLERANCE), job["hours"])), F.lit(0).cast("long"))
            takes = F.when((job["earliest"] >= w["week"]) | (job["hours"] <= 0), job["trays"]).otherwise(
                F.least(job["trays"], free))
            planted = F.struct(job["crop"], w["week"], job["harvest_week"], takes)
            rest = F.struct(job["earliest"], job["harvest_week"], job["crop"], job["hours"], job["trays"] - takes)
            return F.struct(
                (state["left"] - takes * job["hours"]).alias("left"),
                F.concat(state["planted"], one(takes > 0, planted, PLANTED)).alias("planted"),
                F.concat(state["waiting"], one(takes < job["trays"], rest, JOB)).alias("waiting"))

        done = F.aggregate(pool, F.struct(
            w["capacity"].alias("left"), F.array().cast(f"array<{PLANTED}>").alias("planted"),
            F.array().cast(f"array<{JOB}>").alias("waiting")), job_step)
        both = F.array(done)  # evaluated once, used twice
        return F.element_at(F.transform(both, lambda d: F.struct(
            d["waiting"].alias("waiting"),
            F.concat(acc["weeks"], F.array(d["planted"])).alias("weeks"))), 1)

    start = F.struct(F.array().cast(f"array<{JOB}>").alias("waiting"),
                     F.array().cast(f"array<array<{PLANTED}>>").alias("weeks"))
    return F.aggregate(weeks, start, week_step, lambda acc: F.flatten(acc["weeks"]))


def labor_schedule(
    demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """The back-scheduled plan with plantings moved to earlier weeks where labor is short.

    A tray is planted as late as the hours of its window allow. Where every week's hours
    suffice, this is the back-scheduled plan. With one crop, or crops of equal planting
    hours, it fits the labor of every week whenever any plan does, and no plan that fits
    has less stock in any week. With unequal hours whole trays may not pack that well.

    One key's demand cells meet in one row: crops times weeks of them, whatever the number
    of daily rows. Trays that no week can take are planted in their first week, so the
    plan always meets the demand and an audit shows where it breaks.
    """
    weekly = _job_weeks(planting_jobs(demand, params, keys), scen, keys)
    folded = weekly.groupBy(*keys).agg(F.sort_array(
        F.collect_list(F.struct("week", "capacity", "jobs")), asc=False).alias("weeks"))
    return folded.select(*keys, F.inline(_plant_latest_first(F.col("weeks"))))


def labor_intervals(
    demand: DataFrame, params: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Per last week, the run of weeks up to it that is short of planting hours the most.

    (keys.., first_week, last_week, needed_hours, available_hours, excess_hours): what must
    be planted inside the weeks against the hours they offer. An excess above 0 proves that
    no plan fits. Jobs whose window ends by the last week, less those that can start before
    the first, must be planted inside; this is a difference of two prefix sums, so the worst
    first week is a running minimum. For runs shorter than the longest window that
    difference may be too small, and they are counted one by one. Where all trays take the
    same hours, a week offers whole trays only, and no excess in any run means that a plan fits.
    """
    jobs = planting_jobs(demand, params, keys).withColumn("need", F.col("trays") * F.col("hours"))
    zero = F.lit(0.0)

    def entry(week: Column, ending: Column, started: Column, harvest: Column) -> Column:
        return F.struct(week.cast("int").alias("week"), ending.alias("ending"), started.alias("started"),
                        harvest.alias("harvest_hours"))

    deltas = F.array(
        entry(F.col("latest"), F.col("need"), zero, zero),
        entry(F.col("earliest") + 1, zero, F.col("need"), zero),
        entry(F.col("harvest_week"), zero, zero, F.col("trays") * F.col("harvest_hours_per_tray")))
    sums = ("ending", "started", "harvest_hours")
    marks = jobs.select(*keys, F.inline(deltas)).groupBy(*keys, "week").agg(*(F.sum(c).alias(c) for c in sums))
    equal = F.when((F.min("hours") == F.max("hours")) & (F.min("hours") > 0), F.min("hours"))
    spans = jobs.groupBy(*keys).agg(F.max("harvest_week").alias("last"), equal.alias("tray"))
    empty = spans.select(*keys, F.explode(F.sequence(F.lit(1), F.col("last"))).alias("week"),
                         *(zero.alias(c) for c in sums), "tray")
    none = F.lit(None).cast("double").alias("tray")
    weekly = marks.select("*", none).unionByName(empty).groupBy(*keys, "week").agg(
        *(F.sum(c).alias(c) for c in sums), F.max("tray").alias("tray"))
    weekly = attach_scenario(weekly, scen, keys).withColumn(
        "hours_left", _planting_capacity(F.col("harvest_hours")))
    whole = F.floor((F.col("hours_left") + CHECK_TOLERANCE) / F.col("tray")) * F.col("tray")
    weekly = weekly.select(*keys, "week", "ending", "started",
                           F.coalesce(whole, F.col("hours_left")).alias("capacity"))
    order = Window.partitionBy(*keys).orderBy("week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = weekly.select(
        *keys, "week", "capacity", F.sum("ending").over(order).alias("ended"),
        F.sum("started").over(order).alias("before"), F.sum("capacity").over(order).alias("offered"))
    least = F.min(F.struct((F.col("before") - (F.col("offered") - F.col("capacity"))).alias("low"),
                           (-F.col("week")).alias("first"),
                           F.col("before"), (F.col("offered") - F.col("capacity")).alias("offered"))).over(order)
    long_runs = running.withColumn("least", least).select(
        *keys, (-F.col("least.first")).alias("first_week"), F.col("week").alias("last_week"),
        (F.col("ended") - F.col("least.before")).alias("needed_hours"),
        (F.col("offered") - F.col("least.offered")).alias("available_hours"))
    # Runs of weeks around each window that are no longer than the longest window.
    longest = params.agg(F.max(F.col("g_max_weeks") - F.col("g_min_weeks"))).scalar()
    near = jobs.withColumn("slack", longest).select(
        *keys, "need", "earliest", "latest", "slack",
        F.explode(F.sequence(F.greatest(F.col("latest") - F.col("slack"), F.lit(1)), F.col("earliest")))
        .alias("first_week"))
    inside = near.select(
        *keys, "need", "first_week",
        F.explode(F.sequence(F.col("latest"), F.col("first_week") + F.col("slack"))).alias("last_week"))
    # Weeks where nothing must be planted may still lack the hours of their harvest.
    idle = spans.withColumn("slack", longest).select(
        *keys, "last", "slack", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("first_week")).select(
        *keys, zero.alias("need"), "first_week", F.explode(F.sequence("first_week", F.least(
            F.col("first_week") + F.col("slack"), F.col("last")))).alias("last_week"))
    counted = inside.drop("slack").unionByName(idle).groupBy(*keys, "first_week", "last_week").agg(
        F.sum("need").alias("needed_hours"))
    offers = running.select(*keys, F.col("week").alias("last_week"), F.col("offered"))
    before = running.select(*keys, F.col("week").alias("first_week"),
                            (F.col("offered") - F.col("capacity")).alias("earlier"))
    short_runs = counted.join(offers, [*keys, "last_week"]).join(before, [*keys, "first_week"]).select(
        *keys, "first_week", "last_week", "needed_hours",
        (F.col("offered") - F.col("earlier")).alias("available_hours"))
    excess = F.col("needed_hours") - F.col("available_hours")
    # Sums that differ only by the order of addition must tie; then the later first week wins.
    worst = F.max_by(F.struct("first_week", "needed_hours", "available_hours"),
                     F.struct(F.round(excess, 6), F.col("first_week")))
    return long_runs.unionByName(short_runs).groupBy(*keys, "last_week").agg(worst.alias("run")).select(
        *keys, "run.first_week", "last_week", "run.needed_hours", "run.available_hours",
        (F.col("run.needed_hours") - F.col("run.available_hours")).alias("excess_hours"))


def labor_certificate(
    demand: DataFrame, params: DataFrame, price: DataFrame, scen: Scenario | DataFrame,
    weeks: int | None = None, keys: Sequence[str] = (),
) -> DataFrame:
    """The certificate, with labor decided: what the back-scheduled plan leaves open is tried
    with plantings moved to earlier weeks, or refuted by a run of weeks that is too short.

    The lower bound is that of the back-scheduled plan, which no planting week improves.
    ``plan`` names the plan that the cost is of: ``back_schedule``, ``labor_schedule`` or
    null where none fits.
    """
    first = certify(evaluate_weeks(back_schedule(demand, params, keys), demand, params, price, scen, weeks,
                                   keys), keys)
    moved = certify(evaluate_weeks(labor_schedule(demand, params, scen, keys), demand, params, price, scen,
                                   weeks, keys), keys)
    short = labor_intervals(demand, params, scen, keys).filter(F.col("excess_hours") > CHECK_TOLERANCE)
    none = F.lit(None)

    def part(df: DataFrame, **columns: Column) -> DataFrame:
        kinds = {"status": "string", "cost": "double", "lower_bound": "double", "moved_cost": "double",
                 "moved_status": "string", "short_runs": "bigint"}
        return df.select(*keys, *(columns.get(c, none).cast(t).alias(c) for c, t in kinds.items()))

    parts = part(first, status=F.col("status"), cost=F.col("total_cost"), lower_bound=F.col("lower_bound"))
    parts = parts.unionByName(part(moved, moved_cost=F.col("total_cost"), moved_status=F.col("status")))
    parts = parts.unionByName(part(short.groupBy(*keys).agg(F.count("*").alias("n")), short_runs=F.col("n")))
    both = parts.groupBy(*keys).agg(*(F.max(c).alias(c) for c in parts.columns if c not in keys))
    fits = F.col("moved_status").isin("optimal", "feasible_gap")
    open_ = F.col("status") == "undecided"
    gap = F.col("moved_cost") - F.col("lower_bound")
    status = F.when(~open_, F.col("status")).when(F.coalesce("short_runs", F.lit(0)) > 0, "infeasible_proven").when(
        fits & (gap <= GAP_TOLERANCE), "optimal").when(fits, "feasible_gap").otherwise("undecided")
    decided = both.withColumn("first_status", F.col("status")).withColumn("status", status)
    usable = F.col("status").isin("optimal", "feasible_gap")
    plan = F.when(usable, F.when(F.col("first_status") == "undecided", "labor_schedule").otherwise("back_schedule"))
    cost = F.when(F.col("plan") == "labor_schedule", F.col("moved_cost")).when(
        F.col("plan") == "back_schedule", F.col("cost"))
    return decided.withColumn("plan", plan).select(
        *keys, "status", "plan", cost.alias("total_cost"), "lower_bound",
        (cost - F.col("lower_bound")).alias("gap"),
        F.coalesce("short_runs", F.lit(0)).cast("long").alias("short_runs"))
