"""Weekly demand kept up to date by days: a late day rewrites its week and no other.

The stored table has one row per crop and day with partial sums and counts, in one
partition per week. A delivery replaces the days it holds, so delivering a day twice
changes nothing, and only the weeks it touches are read and written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenledger.session import written
from greenledger.sources.tables import table_path

NAME = "demand_days"


def day_partials(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum and count per crop and day."""
    return daily.groupBy(*keys, "crop", "date", "week_id").agg(
        F.sum("demand_lbs").alias("demand_lbs"), F.count(F.lit(1)).alias("rows"))


def deliver_days(
    spark: SparkSession, directory: str, daily: DataFrame, keys: Sequence[str] = ()
) -> None:
    """Put a delivery of whole days into the stored table.

    A day is replaced as a whole, for all crops (of its key). The new partitions are written
    to the shared folder first and then take the place of the old ones, so a failed try can
    be repeated.
    """
    path = table_path(directory, NAME)
    new = written(day_partials(daily, keys))
    try:
        old = spark.read.parquet(path)
    except Exception as missing:  # the first delivery finds no table
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        old = None
    if old is not None:
        day = [*keys, "date"]
        weeks = new.select("week_id").distinct()
        kept = old.join(weeks, "week_id", "left_semi").join(new.select(*day).distinct(), day, "left_anti")
        new = written(kept.select(*new.columns).unionByName(new))
    # One task per week and hash of crops writes the week's file.
    new.repartition("week_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "week_id").parquet(path)


def stored_weekly(spark: SparkSession, directory: str, keys: Sequence[str] = ()) -> DataFrame:
    """The weekly demand of all delivered days."""
    days = spark.read.parquet(table_path(directory, NAME))
    return days.groupBy(*keys, "crop", F.col("week_id").cast("int").alias("week_id")).agg(
        F.sum("demand_lbs").alias("demand_lbs"))
