"""Sources, sinks, projections, joins, rollups and gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from greenledger.functions.columns import clamp
from greenledger.operators import calendar as cal
from greenledger.operators import densify, quality, rollup
from greenledger.operators.shares import eligible
from greenledger.plans import ledger
from greenledger.plans.schedule import demand_trays
from greenledger.registry.base import query
from greenledger.registry.inputs import (
    ANCHOR,
    FACILITY,
    WEEKS,
    Inputs,
)
from greenledger.registry.sql import PARAM_NAMES, iso, rnd, week_of
from greenledger.session import scratch_dir
from greenledger.sources import parameters as par
from greenledger.sources import schemas, tables

D = "::DOUBLE"
DEMAND_WEEKLY_SQL = f"SELECT crop, week_id, {rnd('demand_lbs', 'demand_lbs')} FROM demand_weekly"
PRICE_WEEKLY_SQL = f"SELECT week_id, {rnd('price_per_kwh', 'price_per_kwh')} FROM price_weekly"


# Sources and sinks ---------------------------------------------------------------

ORDERS_SCHEMA_SQL = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


@query("parquet_scan", ORDERS_SCHEMA_SQL)
def _(i: Inputs):
    schema = (StructType().add("o_orderkey", LongType()).add("o_orderstatus", StringType())
              .add("o_totalprice", DoubleType()))
    return tables.read_table(i.spark, i.sf_dir, "orders", schema)


@query("parquet_sink", DEMAND_WEEKLY_SQL)
def _(i: Inputs):
    out = scratch_dir(i.spark)
    tables.write_table(i.demand_weekly, out, "demand_weekly")
    return tables.read_table(i.spark, out, "demand_weekly", schemas.DEMAND_WEEKLY)


@query("csv_sink", PRICE_WEEKLY_SQL)
def _(i: Inputs):
    path = tables.table_path(scratch_dir(i.spark), "energy_price_weekly", "csv")
    tables.write_csv(rollup.rollup_price(i.prices_daily()), path)
    return tables.read_csv(i.spark, path, schemas.PRICE_WEEKLY)


@query("csv_scan", "SELECT crop, plant_week, harvest_week, trays FROM jit")
def _(i: Inputs):
    path = tables.table_path(scratch_dir(i.spark), "plan", "csv")
    tables.write_csv(i.plan, path)
    return tables.read_csv(i.spark, path, schemas.PLAN)


@query("params_table", f"SELECT {PARAM_NAMES} FROM used_params")
def _(i: Inputs):
    return i.used_params


@query(
    "initial_wip_table",
    """SELECT s_nationkey AS facility, crop, -week_id AS age, sum(demand_lbs)::BIGINT AS qty
       FROM late_lines JOIN supplier ON l_suppkey = s_suppkey
       WHERE week_id <= 0 GROUP BY ALL""",
)
def _(i: Inputs):
    suppliers = i.given("supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("facility")
    )
    lots = (
        i.lines_before()
        .join(suppliers, "l_suppkey")
        .groupBy("facility", "crop", (-F.col("week_id")).alias("age"))
        .agg(F.sum("demand_lbs").cast("long").alias("qty"))
    )
    # Nest as the configuration does: six ages per crop, six crops per facility.
    by_crop = lots.groupBy("facility", "crop").agg(
        F.map_from_entries(F.collect_list(F.struct("age", "qty"))).alias("by_age")
    )
    nested = by_crop.groupBy("facility").agg(
        F.map_from_entries(F.collect_list(F.struct("crop", "by_age"))).alias("initial_wip")
    )
    return par.initial_wip_rows(nested, "initial_wip", FACILITY)


@query(
    "overtime_blocks_table",
    f"""SELECT facility, i::INTEGER AS block, {rnd('blocks[i]', 'block_hours')},
               {rnd('list_sum(blocks[1:i])', 'ceiling_hours')}
        FROM fac CROSS JOIN range(1, 3) r(i)""",
)
def _(i: Inputs):
    return par.overtime_blocks(i.facilities, FACILITY)


# Projections, filters, checks ---------------------------------------------------------


@query(
    "effective_yield",
    f"""SELECT p_partkey, crop, {rnd('eff', 'effective_yield_lbs')}
        FROM part JOIN params ON p_type = crop""",
)
def _(i: Inputs):
    parts = i.given("part").select("p_partkey", F.col("p_type").alias("crop"))
    return rollup.join_params(parts, rollup.with_effective_yield(i.params)).select(
        "p_partkey", "crop", "effective_yield_lbs"
    )


@query("week_bucket", f"SELECT o_orderkey, {week_of('o_orderdate', ANCHOR)} AS week_id FROM orders")
def _(i: Inputs):
    orders = i.given("orders").select("o_orderkey", "o_orderdate")
    return cal.with_week_id(orders, "o_orderdate", ANCHOR).select("o_orderkey", "week_id")


@query(
    "mode_dispatch",
    f"""SELECT 'rows' AS mode, crop, week_id, count(tray_id) AS tray_days,
               {rnd('avg(stage_age_days)', 'avg_stage_age_days')}, {rnd('sum(kwh_used)', 'kwh_used')}
        FROM tele_rows GROUP BY ALL
        UNION ALL
        SELECT 'counts', crop, week_id, sum(active_trays)::BIGINT,
               {rnd('avg(stage_age_days)', 'avg_stage_age_days')}, {rnd('sum(kwh_used)', 'kwh_used')}
        FROM tele_counts GROUP BY ALL""",
)
def _(i: Inputs):
    def weekly(df):
        rolled = rollup.rollup_telemetry(df)
        mode = rollup.telemetry_mode(df)
        name = "active_tray_rows" if mode == "rows" else "active_trays"
        return rollup.rename_columns(rolled, {name: "tray_days"}).withColumn("mode", F.lit(mode))

    return weekly(i.telemetry_rows()).unionByName(weekly(i.telemetry_counts()))


@query(
    "rename_alias",
    f"""SELECT date, week_id, {rnd('energy_price_per_kwh', 'price_per_kwh')} FROM prices""",
)
def _(i: Inputs):
    return rollup.rename_columns(i.prices_daily(), {"energy_price_per_kwh": "price_per_kwh"})


@query(
    "clamp",
    f"SELECT event_id, {rnd(f'greatest(least(value, 100.0{D}), 0.02{D})', 'value')} FROM events",
)
def _(i: Inputs):
    return i.given("events").select(
        "event_id", clamp(F.col("value"), 0.02, 100.0).alias("value")
    )


@query(
    "horizon_filter",
    f"""SELECT crop, week_id, demand_lbs, date FROM lines
        WHERE crop IN ('ECONOMY', 'PROMO', 'SMALL') AND week_id BETWEEN 1 AND 52""",
)
def _(i: Inputs):
    return cal.restrict(i.demand_daily(), ["ECONOMY", "PROMO", "SMALL"], 52)


@query(
    "crop_filter",
    f"SELECT {PARAM_NAMES} FROM used_params WHERE crop IN ('ECONOMY', 'PROMO')",
)
def _(i: Inputs):
    return par.select_crops(i.used_params, ["ECONOMY", "PROMO"])


@query(
    "age_class",
    """SELECT crop, age::INTEGER AS age, CASE WHEN age < g_min_weeks THEN 'before_window'
              WHEN age <= g_max_weeks THEN 'in_window' ELSE 'past_window' END AS age_class
       FROM used_params, range(0, (SELECT max(g_max_weeks) FROM used_params) + 1) r(age)""",
)
def _(i: Inputs):
    return ledger.age_class(i.used_params)


@query(
    "check_value_ranges",
    """SELECT 'demand_not_negative' AS rule, count(*) AS checked,
              count(*) FILTER (demand_lbs IS NULL OR demand_lbs < 0) AS violations FROM lines
       UNION ALL
       SELECT 'price_positive', count(*),
              count(*) FILTER (energy_price_per_kwh IS NULL OR energy_price_per_kwh <= 0)
       FROM prices""",
)
def _(i: Inputs):
    return quality.range_violations(i.demand_daily(), i.prices_daily())


@query(
    "check_missing_params",
    "SELECT crop FROM part_crops WHERE crop NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'SMALL')",
)
def _(i: Inputs):
    some = par.select_crops(i.params, ["ECONOMY", "LARGE", "MEDIUM", "SMALL"])
    return quality.missing_params(i.given("part").select(F.col("p_type").alias("crop")), some)


# Joins ---------------------------------------------------------------------------------


@query(
    "join_params",
    f"""SELECT crop, week_id, {rnd('demand_lbs', 'demand_lbs')}, g_min_weeks, g_max_weeks,
               {rnd('demand_lbs / eff', 'demand_trays')}
        FROM demand_weekly JOIN params USING (crop)""",
)
def _(i: Inputs):
    joined = rollup.join_params(i.demand_weekly, rollup.with_effective_yield(i.params))
    return joined.select(
        "crop", "week_id", "demand_lbs", "g_min_weeks", "g_max_weeks",
        (F.col("demand_lbs") / F.col("effective_yield_lbs")).alias("demand_trays"),
    )


@query(
    "cross_calendar_crop",
    f"""SELECT DISTINCT {iso('o_orderdate')} AS date, {week_of('o_orderdate', ANCHOR)} AS week_id,
               crop FROM orders CROSS JOIN params""",
)
def _(i: Inputs):
    days = i.prices_daily().select("date", "week_id").distinct()
    return cal.cross_crops(days, i.params)


@query(
    "cross_grid",
    f"""SELECT crop, w.range::INTEGER AS week_id, a.range::INTEGER AS age
        FROM used_params CROSS JOIN range(1, {WEEKS + 1}) w
        CROSS JOIN range(0, (SELECT max(g_max_weeks) FROM used_params) + 1) a""",
)
def _(i: Inputs):
    return cal.crop_week_age_grid(i.used_params, WEEKS)


@query(
    "grid_left_outer",
    f"""SELECT g.crop, g.week_id, {rnd('d.demand_lbs', 'demand_lbs')}
        FROM grid g LEFT JOIN demand_weekly d USING (crop, week_id)""",
)
def _(i: Inputs):
    return densify.grid_left_outer(i.crop_grid, i.demand_weekly)


@query(
    "week_to_days",
    f"""SELECT strftime(DATE '{ANCHOR}' + ((week_id - 1) * 7 + i)::INTEGER, '%Y-%m-%d') AS date,
               crop, week_id, {rnd('demand_lbs', 'demand_lbs')}
        FROM dense CROSS JOIN range(0, 7) r(i)""",
)
def _(i: Inputs):
    return cal.week_to_days(i.demand, cal.calendar(i.spark, ANCHOR, WEEKS))


@query(
    "join_weekly_level",
    f"""SELECT c.date, c.crop, c.week_id, c.active_trays,
               w.active_trays AS week_tray_days,
               {rnd('c.kwh_used / w.kwh_used', 'share_of_week')}
        FROM tele_counts c JOIN (SELECT crop, week_id, sum(active_trays)::BIGINT AS active_trays,
               sum(kwh_used) AS kwh_used FROM tele_counts GROUP BY ALL) w
        ON c.crop = w.crop AND c.week_id = w.week_id""",
)
def _(i: Inputs):
    daily = i.telemetry_counts()
    weekly = rollup.rename_columns(
        rollup.rollup_telemetry(daily), {"active_trays": "week_tray_days", "kwh_used": "week_kwh"}
    )
    return rollup.join_weekly_level(daily, weekly).select(
        "date", "crop", "week_id", "active_trays", "week_tray_days",
        (F.col("kwh_used") / F.col("week_kwh")).alias("share_of_week"),
    )


@query(
    "join_price",
    f"""SELECT crop, week_id, stock AS trays_in_stock, {rnd('price_per_kwh', 'price_per_kwh')}
        FROM jv_occ JOIN dense_price USING (week_id)""",
)
def _(i: Inputs):
    stock = ledger.occupancy(i.plan, WEEKS)
    return rollup.join_price(stock, i.price, weeks=WEEKS).select(
        "crop", "week_id", "trays_in_stock", "price_per_kwh"
    )


@query(
    "join_price_gaps",
    f"""SELECT crop, o.week_id, stock AS trays_in_stock, {rnd(f"""coalesce(p.price_per_kwh, (
            SELECT avg(price_per_kwh) FROM price_weekly WHERE week_id BETWEEN 1 AND {WEEKS}))""",
            'price_per_kwh')}
        FROM jv_occ o LEFT JOIN price_weekly p USING (week_id)""",
)
def _(i: Inputs):
    """Stock under the weekly prices as they are, with weeks missing."""
    stock = ledger.occupancy(i.plan, WEEKS)
    return rollup.join_price(stock, rollup.rollup_price(i.prices_daily()), weeks=WEEKS).select(
        "crop", "week_id", "trays_in_stock", "price_per_kwh"
    )


@query(
    "join_age_lag",
    """SELECT c.crop, c.week_id, c.age, c.wip, p.wip AS previous_wip
       FROM jit_wip c JOIN jit_wip p
       ON p.crop = c.crop AND p.week_id = c.week_id - 1 AND p.age = c.age - 1""",
)
def _(i: Inputs):
    return ledger.join_age_lag(ledger.wip_by_age(i.plan_planted, i.plan, i.params, WEEKS))


@query("join_range_occupancy", "SELECT crop, week_id, stock AS trays_in_stock FROM jv_occ")
def _(i: Inputs):
    return ledger.occupancy(i.plan, WEEKS)


@query(
    "join_theta_eligibility",
    f"""SELECT d.crop, d.week_id, {rnd('demand_lbs', 'demand_lbs')} FROM demand_weekly d
        JOIN params p ON d.crop = p.crop AND d.week_id > p.g_min_weeks""",
)
def _(i: Inputs):
    return eligible(i.demand_weekly, i.params).select("crop", "week_id", "demand_lbs")


@query(
    "join_theta_window",
    """SELECT l.crop, plant_week, harvest_week, trays, harvest_week - plant_week AS age,
              harvest_week - plant_week BETWEEN g_min_weeks AND g_max_weeks AS in_window
       FROM late l JOIN params USING (crop)""",
)
def _(i: Inputs):
    return ledger.in_window(i.late_plan(), i.params).drop("g_min_weeks", "g_max_weeks")


# Aggregations --------------------------------------------------------------------------


@query("demand_weekly", DEMAND_WEEKLY_SQL)
def _(i: Inputs):
    return i.demand_weekly


@query("energy_price_weekly", PRICE_WEEKLY_SQL)
def _(i: Inputs):
    return rollup.rollup_price(i.prices_daily())


@query(
    "telemetry_weekly_rows",
    f"""SELECT crop, week_id, count(tray_id) AS active_tray_rows,
               {rnd('avg(stage_age_days)', 'avg_stage_age_days')}, {rnd('sum(kwh_used)', 'kwh_used')}
        FROM tele_rows GROUP BY ALL""",
)
def _(i: Inputs):
    return rollup.rollup_telemetry(i.telemetry_rows(), "rows")


@query(
    "telemetry_weekly_counts",
    f"""SELECT crop, week_id, sum(active_trays)::BIGINT AS active_trays,
               {rnd('avg(stage_age_days)', 'avg_stage_age_days')}, {rnd('sum(kwh_used)', 'kwh_used')}
        FROM tele_counts GROUP BY ALL""",
)
def _(i: Inputs):
    return rollup.rollup_telemetry(i.telemetry_counts(), "counts")


@query("params_dedup", f"SELECT DISTINCT {PARAM_NAMES} FROM params JOIN part ON p_type = crop")
def _(i: Inputs):
    repeated = i.given("part").select(F.col("p_type").alias("crop")).join(i.params, "crop")
    return par.dedup_params(repeated)


@query("max_age", "SELECT max(g_max_weeks) AS max_age_weeks FROM used_params")
def _(i: Inputs):
    return par.max_age(i.used_params)


@query(
    "mean_grow_and_labor",
    f"""SELECT {rnd(f'avg((g_min_weeks + g_max_weeks) / 2.0{D})', 'avg_grow_weeks')},
               {rnd('avg(plant_hours_per_tray + harvest_hours_per_tray)', 'avg_labor_hours')}
        FROM used_params""",
)
def _(i: Inputs):
    return par.mean_crop_profile(i.used_params)


@query(
    "regroup_inputs",
    f"""SELECT crop, week_id, {rnd('sum(demand_lbs)', 'demand_lbs')} FROM (
          SELECT date, crop, week_id, sum(demand_lbs) AS demand_lbs FROM lines GROUP BY ALL)
        GROUP BY crop, week_id""",
)
def _(i: Inputs):
    by_day = i.demand_daily().groupBy("date", "crop", "week_id").agg(
        F.sum("demand_lbs").alias("demand_lbs")
    )
    return rollup.rollup_demand(by_day)


@query(
    "any_initial_wip",
    "SELECT coalesce(bool_or(qty > 0), false) AS has_initial_wip FROM stock0",
)
def _(i: Inputs):
    return par.has_initial(i.initial_stock)


@query(
    "demand_weekly_by_facility",
    f"""SELECT facility, crop, week_id, {rnd('sum(demand_lbs)', 'demand_lbs')}
        FROM nat_facts GROUP BY ALL""",
)
def _(i: Inputs):
    suppliers = i.given("supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("facility")
    )
    lines = i.demand_lines().join(suppliers, "l_suppkey")
    return rollup.rollup_demand(lines, FACILITY)


# Gap filling ---------------------------------------------------------------------------


@query("densify_zero", f"SELECT crop, week_id, {rnd('demand_lbs', 'demand_lbs')} FROM dense")
def _(i: Inputs):
    return i.demand


@query(
    "densify_mean", f"SELECT week_id, {rnd('price_per_kwh', 'price_per_kwh')} FROM dense_price"
)
def _(i: Inputs):
    return i.price


@query(
    "demand_trays",
    f"""SELECT crop, week_id, ceil(demand_lbs / eff - 1e-9{D})::BIGINT AS trays
        FROM dense JOIN params USING (crop)""",
)
def _(i: Inputs):
    return demand_trays(i.demand, i.params).select("crop", "week_id", "trays")


