"""As-of joins, streams, late days and sketches over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from greenledger.operators import asof, incremental, sketches
from greenledger.registry.base import query
from greenledger.registry.inputs import EVENT_ANCHOR, GIVEN, Inputs
from greenledger.registry.sql import CTES, rnd
from greenledger.session import scratch_dir, written
from greenledger.sources.tables import table_path
from greenledger.streaming import weekly

D = "::DOUBLE"

CTES["quotes"] = f"""
    SELECT o_orderdate AS quoted_at, max(o_totalprice / 1e6{D}) AS energy_price_per_kwh FROM orders GROUP BY 1"""


@query(
    "asof_price",
    f"""SELECT l_orderkey, l_linenumber, {rnd('energy_price_per_kwh', 'energy_price_per_kwh')}
        FROM lineitem ASOF LEFT JOIN quotes ON l_shipdate >= quoted_at""",
)
def _(i: Inputs):
    """The energy price valid when a line shipped."""
    lines = i.given("lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("at"))
    quotes = i.given("orders").select(
        F.col("o_orderdate").alias("at"), (F.col("o_totalprice") / F.lit(1e6)).alias("energy_price_per_kwh"))
    return asof.asof_join(lines, quotes, "at", ["energy_price_per_kwh"], range_seconds=7 * 86_400).drop("at")


@query(
    "asof_reading",
    f"""SELECT event_id, {rnd('seen', 'seen')}
        FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS seen FROM events
                                      WHERE event_type = 'purchase' GROUP BY ALL) q
        ON e.user_id = q.user_id AND e.ts >= q.ts""",
)
def _(i: Inputs):
    """Each event with its tray's last reading of one kind."""
    events = i.given("events")
    readings = events.filter("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("seen"))
    return asof.asof_join(events.select("event_id", "user_id", "ts"), readings, "ts", ["seen"],
                          ["user_id"]).select("event_id", "seen")


@query(
    "stream_telemetry_weekly",
    f"SELECT crop, week_id, count(*) AS active_tray_rows, {rnd('sum(kwh_used)', 'kwh_used')} FROM tele_rows GROUP BY ALL",
)
def _(i: Inputs):
    """The telemetry rollup by a stream over the files of the table."""
    shared = scratch_dir(i.spark)
    # A stream reads a folder, or what a pattern finds; the table may be one file.
    weekly.run_weekly(i.spark, table_path(i.sf_dir, "events") + "*", GIVEN["events"], f"{shared}/weeks",
                      f"{shared}/checkpoint", EVENT_ANCHOR).awaitTermination()
    return weekly.stored_weeks(i.spark, f"{shared}/weeks")


@query("incremental_demand", f"SELECT crop, week_id, {rnd('demand_lbs', 'demand_lbs')} FROM demand_weekly")
def _(i: Inputs):
    """Weekly demand from two deliveries, the second with the days that were late."""
    daily = written(i.demand_daily())
    late = (F.col("week_id") % 30 == 7) & (F.pmod(F.crc32(F.col("date").cast("binary")), F.lit(3)) == 1)
    out = scratch_dir(i.spark)
    incremental.deliver_days(i.spark, out, daily.filter(~late))
    incremental.deliver_days(i.spark, out, daily.filter(late))
    return incremental.stored_weekly(i.spark, out)


@query(
    "telemetry_sketches",
    """SELECT crop, count(DISTINCT tray_id) AS trays, true AS trays_close, count(stage_age_days) AS ages_seen,
              true AS median_close FROM tele_rows GROUP BY crop""",
)
def _(i: Inputs):
    """Weekly sketches merged over all weeks, held against exact counts and ranks."""
    rows = i.telemetry_rows()
    stored = written(sketches.telemetry_sketches(rows))
    merged = sketches.merged_sketches(stored, ["crop"])
    exact = rows.groupBy("crop").agg(F.count_distinct("tray_id").alias("trays"))
    below = rows.join(merged.select("crop", "approx_median_age"), "crop").groupBy("crop").agg(
        F.avg((F.col("stage_age_days") < F.col("approx_median_age")).cast("double")).alias("low"),
        F.avg((F.col("stage_age_days") <= F.col("approx_median_age")).cast("double")).alias("high"))
    close = F.abs(F.col("approx_trays") - F.col("trays")) <= 0.05 * F.col("trays")
    return merged.join(exact, "crop").join(below, "crop").select(
        "crop", "trays", close.alias("trays_close"), "ages_seen",
        ((F.col("low") <= 0.54) & (F.col("high") >= 0.46)).alias("median_close"))
