"""The value valid at an instant: the last one at or before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a range inside which instants are sorted.
RANGE_SECONDS = 86_400


def _range_of(time: Column, seconds: int) -> Column:
    return F.floor(F.unix_seconds(time.cast("timestamp")) / seconds)


def asof_join(
    left: DataFrame, right: DataFrame, time: str, values: Sequence[str], keys: Sequence[str] = (),
    range_seconds: int = RANGE_SECONDS,
) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the last row of ``right`` at or before it.

    Both have the columns ``time`` and ``keys``. Several right rows of one instant count as
    the greatest of them; left rows before the first right row, or without a time or key,
    get nulls; every left row gives one row.

    Only distinct instants are sorted, inside ranges of a fixed length: one instant that
    holds a large part of the rows is one row there. What the last range before another
    leaves behind is a carry table of one row per key and range, not a window over all rows.
    Instants meet their left rows again by an equi-join, whose hot keys can be split.
    """
    at = [*keys, time]
    cell = [*keys, "_range"]
    known = F.col(time).isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    quotes = right.filter(known).groupBy(*at).agg(F.max(F.struct(*values)).alias("_quote"))
    asked = left.filter(known).select(*at).distinct().withColumn("_quote", F.lit(None).cast(
        quotes.schema["_quote"].dataType))
    instants = quotes.withColumn("_asked", F.lit(False)).unionByName(
        asked.withColumn("_asked", F.lit(True))).groupBy(*at).agg(
        F.max("_quote").alias("_quote"), F.bool_or("_asked").alias("_asked")).withColumn(
        "_range", _range_of(F.col(time), range_seconds))
    inside = Window.partitionBy(*cell).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = instants.withColumn("_last", F.last("_quote", ignorenulls=True).over(inside))
    ends = instants.groupBy(*cell).agg(F.max_by("_quote", F.when(F.col("_quote").isNotNull(), F.col(time)))
                                       .alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*cell, F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    answers = filled.filter("_asked").join(carry, cell).select(
        *at, F.coalesce("_last", "_carried").alias("_answer"))
    return left.join(answers, at, "left").select(
        *left.columns, *(F.col(f"_answer.{v}").alias(v) for v in values))
