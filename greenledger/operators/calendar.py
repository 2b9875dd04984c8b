"""Calendars, week buckets and full grids, built by generators instead of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.functions.columns import week_index


def with_week_id(
    df: DataFrame, date_col: str, anchor: str, weeks: int | None = None,
    first_week: int | None = 1,
) -> DataFrame:
    """Add the week index of a date. With a horizon ``first_week..weeks`` (no first week:
    everything up to ``weeks``), rows outside it are cut by a range on the source column
    itself, which reaches the parquet scan."""
    if weeks is not None:
        start = F.to_date(F.lit(anchor))
        df = df.filter(F.col(date_col) < F.date_add(start, 7 * weeks))
        if first_week is not None:
            df = df.filter(F.col(date_col) >= F.date_add(start, 7 * (first_week - 1)))
    return df.withColumn("week_id", week_index(date_col, anchor))


def calendar(spark: SparkSession, start: str, weeks: int) -> DataFrame:
    """One row per day of the horizon: date text, week, weekday (Monday = 0)."""
    day = F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int"))
    return spark.range(7 * weeks).select(
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        (F.floor(F.col("id") / F.lit(7)) + 1).cast("int").alias("week_id"),
        F.weekday(day).cast("int").alias("day_of_week"),
    )


def entity_calendar(entities: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """One row per entity and day between two date columns (both included)."""
    others = [c for c in entities.columns if c not in (start_col, end_col)]
    days = entities.filter(F.col(start_col) <= F.col(end_col)).select(
        *others, F.col(start_col).alias("first_day"),
        F.explode(F.sequence(start_col, end_col)).alias("day"),
    )
    return days.select(
        *others,
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        (F.floor(F.datediff("day", "first_day") / F.lit(7)) + 1).cast("int").alias("week_id"),
        F.weekday("day").cast("int").alias("day_of_week"),
    )


def cross_days(entities: DataFrame, start: str, weeks: int) -> DataFrame:
    """Every entity row on every day of the horizon."""
    first = F.to_date(F.lit(start))
    last = F.date_add(first, 7 * weeks - 1)
    return entity_calendar(
        entities.withColumns({"_first": first, "_last": last}), "_first", "_last"
    )


def crop_array(params: DataFrame):
    """The configured crops as one array value (a scalar subquery, one row per crop)."""
    return params.agg(F.array_sort(F.collect_set("crop"))).scalar()


def cross_crops(df: DataFrame, params: DataFrame) -> DataFrame:
    """Every row once per configured crop."""
    return (
        df.withColumn("_crops", crop_array(params))
        .select(*df.columns, F.explode("_crops").alias("crop"))
    )


def cross_weeks(df: DataFrame, weeks: int) -> DataFrame:
    """Every row once per week 1..weeks."""
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(weeks))).alias("week_id"))


def crop_week_grid(
    params: DataFrame, weeks: int, entities: DataFrame | None = None
) -> DataFrame:
    """Full (keys.., crop, week_id) grid of the configured crops and weeks."""
    base = params.select("crop") if entities is None else cross_crops(entities, params)
    return cross_weeks(base, weeks)


def week_grid(spark: SparkSession, weeks: int) -> DataFrame:
    return spark.range(1, weeks + 1).select(F.col("id").cast("int").alias("week_id"))


def crop_week_age_grid(params: DataFrame, weeks: int) -> DataFrame:
    """Full (crop, week_id, age) grid up to the longest growing time of any crop."""
    top = params.agg(F.max("g_max_weeks")).scalar()
    return (
        crop_week_grid(params, weeks)
        .withColumn("_ages", F.sequence(F.lit(0), top))
        .select("crop", "week_id", F.explode("_ages").alias("age"))
    )


def restrict(df: DataFrame, crops: Sequence[str], weeks: int) -> DataFrame:
    """Keep configured crops and weeks 1..weeks: plain predicates, so a stored table
    is filtered in its scan."""
    return df.filter(
        F.col("crop").isin(list(crops)) & F.col("week_id").between(1, weeks)
    )


def week_to_days(weekly: DataFrame, calendar_days: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Each weekly row once per date of its week; the calendar may carry the keys."""
    on = [k for k in keys if k in calendar_days.columns] + ["week_id"]
    return weekly.join(calendar_days.select(*on, "date"), on)
