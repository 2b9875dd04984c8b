"""Calendars, shares and daily tables of the given rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from greenledger.functions.columns import noise_int, noise_normal, noise_uniform, seasonal
from greenledger.operators import calendar as cal
from greenledger.operators import shares
from greenledger.operators.rollup import disaggregate_observed, expand_counts, with_effective_yield
from greenledger.plans import jobs
from greenledger.plans.schedule import demand_trays, planned_demand
from greenledger.registry.base import query
from greenledger.registry.inputs import (
    ANCHOR,
    SEED,
    SYNTH_WEEKS,
    WEEKS,
    Inputs,
)
from greenledger.registry.sql import CTES, normal, rnd, uniform, week_of
from greenledger.session import scratch_dir
from greenledger.sources import schemas
from greenledger.sources.parameters import Scenario
from greenledger.sources.tables import read_table

D = "::DOUBLE"
#: Means of a few short decimals end in an exact half; engines round that either way.
OFF_TIES = 2e-10


@query(
    "calendar",
    f"""SELECT strftime(d, '%Y-%m-%d') AS date, ((d::DATE - first) // 7 + 1)::INTEGER AS week_id,
               (isodow(d) - 1)::INTEGER AS day_of_week
        FROM (SELECT first, unnest(generate_series(first, last, INTERVAL 1 DAY)) AS d
              FROM (SELECT min(o_orderdate)::DATE AS first, max(o_orderdate)::DATE AS last
                    FROM orders))""",
)
def _(i: Inputs):
    span = i.given("orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return cal.entity_calendar(span, "first", "last")


@query(
    "seasonal_index",
    f"""SELECT o_orderkey,
          {rnd(f"1.0 + 0.12{D} * sin(2.0{D} * pi() * w / {WEEKS}{D})", "demand_index")},
          {rnd(f"0.55{D} + 0.10{D} * sin(2.0{D} * pi() * w / {WEEKS}{D})", "telemetry_level")}
        FROM (SELECT o_orderkey, {week_of('o_orderdate', ANCHOR)} AS w FROM orders)""",
)
def _(i: Inputs):
    orders = i.given("orders").select("o_orderkey", "o_orderdate")
    week = F.col("week_id")
    return cal.with_week_id(orders, "o_orderdate", ANCHOR).select(
        "o_orderkey", seasonal(week, WEEKS, 0.12).alias("demand_index"),
        seasonal(week, WEEKS, 0.10, 0.55).alias("telemetry_level"),
    )


@query(
    "keyed_noise",
    f"""SELECT l_orderkey, l_linenumber,
          {rnd(uniform('u', 'l_orderkey', 'l_linenumber', low=0.8, high=1.2), 'uniform')},
          {rnd(normal('n', 'l_orderkey', 'l_linenumber', mean=1.0, std=0.12), 'normal')},
          (1 + floor({uniform('i', 'l_orderkey', 'l_linenumber')} * 41))::INTEGER AS integer
        FROM lineitem""",
)
def _(i: Inputs):
    keys = (F.col("l_orderkey"), F.col("l_linenumber"))
    return i.given("lineitem").select(
        *keys,
        noise_uniform(SEED, "u", *keys, low=0.8, high=1.2).alias("uniform"),
        noise_normal(SEED, "n", *keys, mean=1.0, std=0.12).alias("normal"),
        noise_int(SEED, "i", *keys, low=1, high=42).alias("integer"),
    )


@query("tray_limit", f"SELECT facility, {rnd('tray_limit', 'tray_limit')}, "
                     f"target AS target_total_trays FROM limits")
def _(i: Inputs):
    return shares.tray_limit(i.facilities, i.params).select(
        "facility", "tray_limit", "target_total_trays"
    )


@query("eligible_crops", "SELECT facility, week_id, crop FROM elig")
def _(i: Inputs):
    grid = cal.crop_week_grid(i.params, SYNTH_WEEKS, i.facilities.select("facility"))
    return shares.eligible(grid, i.params).select("facility", "week_id", "crop")


#: Demand of each crop and week with its trays and its share of the week.
CTES["obs"] = f"""
    SELECT crop, week_id, demand_lbs, ceil(demand_lbs / eff - 1e-9{D})::BIGINT AS trays_est
    FROM demand_weekly JOIN params USING (crop)"""
CTES["obs_weights"] = """
    SELECT *, coalesce(demand_lbs / nullif(sum(demand_lbs) OVER w, 0), 0) AS weight,
           (sum(trays_est) OVER w)::BIGINT AS total_trays
    FROM obs WINDOW w AS (PARTITION BY week_id)"""
CTES["obs_split"] = """
    SELECT week_id, crop, total_trays, whole + CASE WHEN rank <= total_trays - given AND weight > 0
           THEN 1 ELSE 0 END AS trays
    FROM (SELECT *, (sum(whole) OVER (PARTITION BY week_id))::BIGINT AS given,
                 row_number() OVER (PARTITION BY week_id ORDER BY part DESC, crop) AS rank
          FROM (SELECT *, floor(total_trays * weight)::BIGINT AS whole,
                       round(total_trays * weight - floor(total_trays * weight), 9) AS part
                FROM obs_weights))"""


def _observed(i: Inputs):
    """Observed weekly demand with its trays."""
    return demand_trays(i.demand_weekly, i.params).select(
        "crop", "week_id", F.col("trays").alias("demand_trays_est")
    ).join(i.demand_weekly, ["crop", "week_id"])


def _weights(i: Inputs):
    """Each crop's share of the pounds, and the trays, of its week."""
    totals = _observed(i).withColumn("weight", F.col("demand_lbs")).withColumn(
        "total_trays", F.sum("demand_trays_est").over(Window.partitionBy("week_id")))
    return shares.normalized(totals, "weight", ["week_id"])


@query(
    "normalized_weights", f"SELECT week_id, crop, {rnd('weight', 'weight')} FROM obs_weights",
)
def _(i: Inputs):
    return _weights(i).select("week_id", "crop", "weight")


@query("apportion_integer", "SELECT week_id, crop, total_trays, trays::BIGINT AS trays FROM obs_split")
def _(i: Inputs):
    split = shares.apportion(_weights(i), "total_trays", "weight", ["week_id"])
    return split.select("week_id", "crop", "total_trays", "trays")


@query(
    "weekly_total_trays",
    "SELECT week_id, sum(trays_est)::BIGINT AS total_trays FROM obs GROUP BY week_id",
)
def _(i: Inputs):
    return _observed(i).groupBy("week_id").agg(F.sum("demand_trays_est").alias("total_trays"))


@query(
    "weekly_demand",
    f"""SELECT crop, week_id, {rnd(f'n * eff * 0.90{D}', 'demand_lbs')}, n AS demand_trays_est
        FROM (SELECT g.crop, g.week_id, eff, CASE WHEN g.week_id > g_min_weeks
                     THEN coalesce(trays_est, 0) ELSE 0 END::BIGINT AS n
              FROM grid g JOIN params USING (crop) LEFT JOIN obs USING (crop, week_id))""",
)
def _(i: Inputs):
    """Demand that the observed trays can meet, with the shipped safety factor."""
    trays = _observed(i).select("crop", "week_id", F.col("demand_trays_est").alias("trays"))
    return planned_demand(trays, i.crop_grid, i.params, Scenario().safety_factor)


@query(
    "disaggregate_daily",
    f"""SELECT date, week_id, crop, {rnd(f'planned * day_lbs / sum(day_lbs) OVER (PARTITION BY crop, week_id) + {OFF_TIES}{D}',
                                         'demand_lbs')}
        FROM (SELECT date, week_id, crop, sum(demand_lbs) AS day_lbs FROM lines GROUP BY ALL)
        JOIN (SELECT crop, week_id, trays_est * eff AS planned FROM obs JOIN params USING (crop))
        USING (crop, week_id)""",
)
def _(i: Inputs):
    """Pounds of the whole trays of a week, over its days by their observed shares."""
    days = i.demand_daily().groupBy("date", "week_id", "crop").agg(F.sum("demand_lbs").alias("demand_lbs"))
    planned = _observed(i).join(with_effective_yield(i.params), "crop").select(
        "crop", "week_id", (F.col("demand_trays_est") * F.col("effective_yield_lbs")).alias("planned"))
    return disaggregate_observed(planned, days, "planned", "demand_lbs").withColumn(
        "demand_lbs", F.col("demand_lbs") + OFF_TIES)


@query(
    "price_daily",
    f"""SELECT date, week_id, {rnd(f'avg(energy_price_per_kwh) + {OFF_TIES}{D}', 'energy_price_per_kwh')}
        FROM prices GROUP BY ALL""",
)
def _(i: Inputs):
    return i.prices_daily().groupBy("date", "week_id").agg(
        (F.avg("energy_price_per_kwh") + OFF_TIES).alias("energy_price_per_kwh")
    )


@query("telemetry_counts", f"""SELECT date, week_id, crop, batch_id, active_trays, stage_age_days,
    {rnd('kwh_used', 'kwh_used')}, is_active FROM tele_counts""")
def _(i: Inputs):
    return i.telemetry_counts()


@query("active_flag", """SELECT date, crop, active_trays, active_trays > 0 AS is_active
                         FROM tele_counts""")
def _(i: Inputs):
    return i.telemetry_counts().select(
        "date", "crop", "active_trays", shares.active_flag().alias("is_active")
    )


@query(
    "telemetry_rows",
    f"""SELECT date, week_id, crop, crop || '_' || replace(date, '-', '') || '_' || printf('%05d', tray) AS tray_id,
               stage_age_days, {rnd('kwh', 'kwh_used')}, true AS is_active
        FROM (SELECT *, greatest(kwh_used / active_trays, 0.01{D}) AS kwh,
                     unnest(range(0, active_trays)) AS tray FROM tele_counts)""",
)
def _(i: Inputs):
    """One row per active tray of each daily count."""
    return expand_counts(i.telemetry_counts())


@query(
    "generate_all",
    f"""SELECT week_id, 'demand_daily' AS table_name, count(*) AS row_count,
               {rnd('sum(demand_lbs)', 'total')} FROM lines GROUP BY ALL
        UNION ALL
        SELECT week_id, 'prices_energy_daily', count(*),
               {rnd('sum(energy_price_per_kwh)', 'total')} FROM prices GROUP BY ALL
        UNION ALL
        SELECT week_id, 'telemetry_tray_daily', count(*), {rnd('sum(kwh_used)', 'total')}
        FROM tele_counts GROUP BY ALL
        UNION ALL
        SELECT NULL, 'crop_params', count(*), {rnd('sum(yield_lbs_per_tray)', 'total')} FROM used_params""",
)
def _(i: Inputs):
    """The four daily tables made from the given ones, written, read back and summed per week."""
    out = scratch_dir(i.spark)
    jobs.write_daily({"demand_daily": i.demand_daily(), "prices_energy_daily": i.prices_daily(),
                      "crop_params": i.used_params, "telemetry_tray_daily": i.telemetry_counts()}, out)

    def summed(name: str, schema, value: str):
        df = read_table(i.spark, out, name, schema)
        week = "week_id" if "week_id" in df.columns else F.lit(None).cast("int").alias("week_id")
        return df.groupBy(week).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.sum(value).alias("total"))

    return (
        summed("demand_daily", schemas.DEMAND_DAILY, "demand_lbs")
        .unionByName(summed("prices_energy_daily", schemas.PRICES_DAILY, "energy_price_per_kwh"))
        .unionByName(summed("telemetry_tray_daily", schemas.TELEMETRY_COUNTS, "kwh_used"))
        .unionByName(summed("crop_params", schemas.CROP_PARAMS, "yield_lbs_per_tray"))
    )
