"""Gap filling on a full grid.

The grid joins the facts as extra empty rows of the same aggregate, so filling
costs one exchange; a marker drops cells that are not on the grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: the price used when no week of the horizon has one.
DEFAULT_PRICE = 0.13
#: Metadata of a filled column: it has one row, with a value, for each week up to this one.
COMPLETE_WEEKS = "complete_weeks"


def _on_grid(
    df: DataFrame, grid: DataFrame, value: str, how, weeks: int | None
) -> DataFrame:
    """Aggregate facts and empty grid rows per cell, keep the cells of the grid.

    No grid has null cells or weeks outside its horizon. Saying so here lets the scan
    drop them, and keeps the plan the same wherever the result is joined later, so that
    its exchange is reused instead of computed again.
    """
    cells = grid.columns
    placed = reduce(and_, (F.col(c).isNotNull() for c in cells))
    if weeks is not None:
        placed = placed & F.col("week_id").between(1, weeks)
    facts = df.select(*cells, F.col(value).cast("double").alias(value),
                      F.lit(0).alias("_on_grid"))
    empty = grid.select(*cells, F.lit(None).cast("double").alias(value),
                        F.lit(1).alias("_on_grid"))
    return (
        facts.unionByName(empty)
        .groupBy(*cells)
        .agg(how(value).alias(value), F.max("_on_grid").alias("_on_grid"))
        .filter((F.col("_on_grid") == 1) & placed)
        .drop("_on_grid")
    )


def _keep(dense: DataFrame, value: str) -> DataFrame:
    """Keep the value in every use of the table, by a filter that always holds.

    A use that needs only the cells would otherwise aggregate the facts a second time,
    without the value, where it could reuse the exchange of another use.
    """
    return dense.filter(F.abs(value) >= 0)


def grid_left_outer(
    grid: DataFrame, df: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Every grid cell with its facts attached, null where there are none."""
    return grid.join(df, list(keys or grid.columns), "left")


def densify_zero(
    df: DataFrame, grid: DataFrame, value: str, weeks: int | None = None
) -> DataFrame:
    """Sum the facts per grid cell; missing cells become 0, other cells drop out.

    ``weeks`` tells how long the horizon of the grid is, if it is a grid of weeks.
    """
    return _keep(_on_grid(df, grid, value, F.sum, weeks).fillna(0.0, [value]), value)


def densify_mean(
    df: DataFrame,
    grid: DataFrame,
    value: str,
    default: float = DEFAULT_PRICE,
    keys: Sequence[str] = (),
    weeks: int | None = None,
) -> DataFrame:
    """Mean of the facts per grid cell; a missing cell takes the mean of the present
    cells (of its key), or the default when there is none.

    The mean of all cells is a scalar subquery; with keys it is a window over the
    key, whose group is no longer than the horizon.
    """
    cells = _on_grid(df, grid, value, F.avg, weeks)
    if keys:
        fill = F.avg(value).over(Window.partitionBy(*keys))
    else:
        fill = cells.agg(F.avg(value)).scalar()
    filled = F.coalesce(F.col(value), fill, F.lit(float(default)))
    if weeks is not None:
        filled = filled.alias(value, metadata={COMPLETE_WEEKS: weeks})
    return _keep(cells.withColumn(value, filled), value)
