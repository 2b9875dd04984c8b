"""Daily tables to weekly tables. One aggregate each: partial sums combine on the
map side, so a crop-week holding a large part of the rows ships one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenledger.functions.columns import effective_yield
from greenledger.operators.densify import COMPLETE_WEEKS, DEFAULT_PRICE
from greenledger.session import spread


# Fixed value: the least energy of a tray and day.
TRAY_KWH_FLOOR = 0.01


def rollup_demand(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*keys, "crop", "week_id").agg(F.sum("demand_lbs").alias("demand_lbs"))


def rollup_price(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*keys, "week_id").agg(
        F.avg("energy_price_per_kwh").alias("price_per_kwh")
    )


def telemetry_mode(df: DataFrame) -> str:
    """"rows" when there is one row per tray, else "counts"."""
    return "rows" if "tray_id" in df.columns else "counts"


def rollup_telemetry(
    df: DataFrame, mode: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Weekly tray-days, mean age and energy of either telemetry form."""
    mode = mode or telemetry_mode(df)
    if mode == "rows":
        active = F.count("tray_id").alias("active_tray_rows")
    elif mode == "counts":
        active = F.sum("active_trays").alias("active_trays")
    else:
        raise ValueError("mode must be one of: rows, counts")
    return df.groupBy(*keys, "crop", "week_id").agg(
        active,
        F.avg("stage_age_days").alias("avg_stage_age_days"),
        F.sum("kwh_used").alias("kwh_used"),
    )


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_effective_yield(params: DataFrame) -> DataFrame:
    return params.withColumn("effective_yield_lbs", effective_yield())


def join_params(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach the crop parameters; rows of unknown crops drop out."""
    return df.join(params, "crop")


def join_price(
    df: DataFrame, price: DataFrame, keys: Sequence[str] = (), weeks: int | None = None
) -> DataFrame:
    """Attach the weekly price; the price table may or may not carry the keys.

    No row is lost and none doubled, whatever the horizon: several prices of a week
    count as their mean, and a week without one takes the mean of the weeks that have
    one (of its key; those of the horizon, if it is given), or the default without any.
    A price that was filled for the whole horizon says so in its metadata and is joined
    as it is.
    """
    own = [k for k in keys if k in price.columns]
    complete = price.schema["price_per_kwh"].metadata.get(COMPLETE_WEEKS, 0)
    if weeks is not None and weeks <= complete:
        joined = df.join(price.select(*own, "week_id", "price_per_kwh"), [*own, "week_id"], "left")
        return joined.withColumn("price_per_kwh", F.coalesce("price_per_kwh", F.lit(DEFAULT_PRICE)))
    price = price.select(*own, "week_id", "price_per_kwh")
    if weeks is not None:
        price = price.filter(F.col("week_id").between(1, weeks))
    each = price.groupBy(*own, "week_id").agg(F.avg("price_per_kwh").alias("price_per_kwh"))
    joined = df.join(each, [*own, "week_id"], "left")
    if own:
        mean = each.groupBy(*own).agg(F.avg("price_per_kwh").alias("_mean_price"))
        joined = joined.join(mean, own, "left")
        fill = F.col("_mean_price")
    else:
        fill = each.agg(F.avg("price_per_kwh")).scalar()
    filled = F.coalesce("price_per_kwh", fill, F.lit(DEFAULT_PRICE))
    return joined.withColumn("price_per_kwh", filled).drop("_mean_price")


def join_weekly_level(daily: DataFrame, weekly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Attach the (week, crop) level to daily rows."""
    return daily.join(weekly, [*keys, "crop", "week_id"])


def expand_counts(counts: DataFrame, keys: Sequence[str] = (), chunk: int = 10_000) -> DataFrame:
    """One row per active tray of a daily count, with an id of its own and its share of the energy.

    A count is first cut into chunks, the chunks are spread over the cluster, and only then
    expanded, so one huge count is neither one array nor one task. Counts of 0 give no row.
    """
    day = ["date", *keys, "week_id", "crop"]
    n = F.col("active_trays")
    share = F.greatest(F.col("kwh_used") / n, F.lit(TRAY_KWH_FLOOR))
    starts = F.sequence(F.lit(0).cast("long"), n - 1, F.lit(chunk).cast("long"))
    chunks = spread(counts.filter(n > 0).select(
        *day, "stage_age_days", share.alias("kwh_used"), "active_trays", F.explode(starts).alias("first_tray")),
        *day, "first_tray")
    last = F.least(F.col("first_tray") + chunk, n) - 1
    trays = chunks.select(*day, "stage_age_days", "kwh_used", F.explode(F.sequence("first_tray", last)).alias("tray"))
    return trays.select(
        *day, F.concat_ws("_", *keys, "crop", F.replace("date", F.lit("-"), F.lit("")),
                          F.format_string("%05d", "tray")).alias("tray_id"),
        "stage_age_days", "kwh_used", F.lit(True).alias("is_active"))


def disaggregate_observed(
    weekly: DataFrame, daily: DataFrame, value: str, observed: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Spread a weekly value over the days of its crop and week by their observed shares.

    ``daily`` has one row per day and crop; a window holds the days of one crop and week.
    """
    week = [*keys, "crop", "week_id"]
    total = F.sum(observed).over(Window.partitionBy(*week))
    share = F.coalesce(F.try_divide(F.col(observed), total), F.lit(0.0))
    return daily.withColumn("_share", share).join(weekly, week).select(
        "date", *week, (F.col(value) * F.col("_share")).alias(observed)
    )
