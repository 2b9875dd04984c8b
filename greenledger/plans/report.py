"""Report tables over the outputs of a plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenledger.sources.schemas import COST_PARTS


def production_by_week(harvest: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Produced and demanded pounds per week over all crops."""
    return harvest.groupBy(*keys, "week_id").agg(
        F.sum("produced_lbs").alias("produced_lbs"), F.sum("demand_lbs").alias("demand_lbs")
    )


def mean_utilization(utilization: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the weekly ratios."""
    return utilization.groupBy(*keys).agg(
        *(F.avg(f"{kind}_utilization").alias(f"avg_{kind}_utilization")
          for kind in ("rack", "labor", "process"))
    )


def plan_totals(demand: DataFrame, harvest: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Demand of the unrestricted weekly table, produced and wasted pounds of the plan."""
    parts = demand.select(*keys, "demand_lbs").unionByName(
        harvest.select(*keys, "produced_lbs", "waste_lbs"), allowMissingColumns=True
    )
    return parts.groupBy(*keys).agg(
        *(F.coalesce(F.sum(f"{kind}_lbs"), F.lit(0.0)).alias(f"total_{kind}_lbs")
          for kind in ("demand", "produced", "waste"))
    )


def report_summary(
    demand: DataFrame, harvest: DataFrame, utilization: DataFrame, costs: DataFrame,
    params: DataFrame, weeks: int, keys: Sequence[str] = (),
) -> DataFrame:
    """Nine figures per key, from one aggregate over the four tables laid end to end.

    Without keys the crop count comes along as rows; with keys it is a scalar.
    """
    ratios = [f"{kind}_utilization" for kind in ("rack", "labor", "process")]
    parts = (
        demand.select(*keys, "demand_lbs")
        .unionByName(harvest.select(*keys, "produced_lbs", "waste_lbs"), allowMissingColumns=True)
        .unionByName(utilization.select(*keys, *ratios), allowMissingColumns=True)
        .unionByName(costs.select(*keys, "total_cost"), allowMissingColumns=True)
    )
    return (
        parts.groupBy(*keys)
        .agg(
            *(F.coalesce(F.sum(f"{kind}_lbs"), F.lit(0.0)).alias(f"total_{kind}_lbs")
              for kind in ("demand", "produced", "waste")),
            *(F.avg(ratio).alias(f"avg_{ratio}") for ratio in ratios),
            F.sum("total_cost").alias("total_cost"),
        )
        .withColumns(
            {
                "weeks": F.lit(weeks),
                "num_crops": params.agg(F.count_distinct("crop").cast("int")).scalar(),
            }
        )
        .select(
            *keys, "weeks", "num_crops", "total_demand_lbs", "total_produced_lbs",
            "total_waste_lbs", *(f"avg_{ratio}" for ratio in ratios), "total_cost",
        )
    )


# Labels and formats of the report lines, in order.
REPORT_LINES = (
    ("weeks", "- Weeks: %d"),
    ("num_crops", "- Crops: %d"),
    ("total_demand_lbs", "- Total demand (lbs): %.2f"),
    ("total_produced_lbs", "- Total produced (lbs): %.2f"),
    ("total_waste_lbs", "- Total waste (lbs): %.2f"),
    ("avg_rack_utilization", "- Average rack utilization: %.2f%%"),
    ("avg_labor_utilization", "- Average labor utilization: %.2f%%"),
    ("avg_process_utilization", "- Average process utilization: %.2f%%"),
    ("total_cost", "- Total cost: $%.2f"),
)
COST_LINE = "- %s: $%.2f"


def report_lines(summary: DataFrame, costs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The report as ordered lines, per key: the summary figures, then the cost parts."""

    def lines(df: DataFrame, texts: Sequence[Column], first: int) -> DataFrame:
        return df.select(*keys, F.posexplode(F.array(*texts)).alias("pos", "line")).select(
            *keys, (F.col("pos") + first).cast("int").alias("line_no"), "line"
        )

    def figure(name: str, text: str) -> Column:
        value = F.col(name) * 100 if text.endswith("%%") else F.col(name)
        return F.format_string(text, value)

    top = [figure(name, text) for name, text in REPORT_LINES]
    money = [F.format_string(COST_LINE, F.lit(p), F.col(p)) for p in (*COST_PARTS, "total_cost")]
    return lines(summary, top, 1).unionByName(lines(costs, money, 1 + len(top)))
