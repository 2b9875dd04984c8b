"""Checks of the input tables, as tables of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_violations(
    demand_daily: DataFrame, prices_daily: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Rows per rule (and key) and how many break it: demand >= 0, price > 0 (null breaks both)."""
    def counted(df: DataFrame, rule: str, good) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("checked"),
            F.count_if(~F.coalesce(good, F.lit(False))).alias("violations"),
        ).select(*keys, F.lit(rule).alias("rule"), "checked", "violations")

    return counted(demand_daily, "demand_not_negative", F.col("demand_lbs") >= 0).unionByName(
        counted(prices_daily, "price_positive", F.col("energy_price_per_kwh") > 0)
    )


def missing_params(crops: DataFrame, params: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Crops in use (per key) that have no parameter row."""
    return crops.select(*keys, "crop").distinct().join(params, "crop", "left_anti").select(*keys, "crop")
