"""The given tables seen as planning tables.

Anchor week 1 starts on Monday 1995-01-02 and the horizon is 357 weeks. A line item
is a demand row of its part type, an order a price row, an event a tray-day, a
supplier a facility.
"""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from greenledger.operators.calendar import crop_week_grid, week_grid, with_week_id
from greenledger.operators.densify import densify_mean, densify_zero
from greenledger.operators.rollup import rollup_demand, rollup_price
from greenledger.plans.schedule import back_schedule, planted
from greenledger.sources.parameters import (
    SHIPPED_CROPS,
    Scenario,
    params_table,
    scenario_table,
)
from greenledger.sources.tables import read_table

ANCHOR = "1995-01-02"
WEEKS = 357
#: A later anchor leaves weeks before the horizon, whose lines serve as initial stock.
LATE_ANCHOR = "1996-01-01"
LATE_WEEKS = 305
EVENT_ANCHOR = "2024-01-01"
#: Synthetic tables start here and run for the shipped horizon.
SYNTH_START = "2026-01-05"
SYNTH_WEEKS = 12
SEED = 20260225
FACILITY = ("facility",)

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _given(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


#: The part types take the parameters of the shipped crops.
PART_TYPES = {
    "ECONOMY": "arugula",
    "LARGE": "basil",
    "MEDIUM": "kale",
    "PROMO": "romaine",
    "SMALL": "spinach",
    "STANDARD": "mixed_greens",
}
CROPS = tuple(PART_TYPES)
_SHIPPED = {c.crop: c for c in SHIPPED_CROPS}
PARAMS = tuple(replace(_SHIPPED[name], crop=part_type) for part_type, name in PART_TYPES.items())

#: Capacities for 60,000 line items; other sizes scale with the line count. The tight
#: ones lie inside the weekly load, so some weeks pass and some fail.
LINES_PER_UNIT = 60000.0
TIGHT = {"rack": 12000.0, "process": 3400.0, "labor": 620.0, "block": 40.0, "shift": 1400.0}
LOOSE = {**TIGHT, "rack": 20000.0, "process": 6000.0, "labor": 1100.0}
SWEEP = {
    "rack_capacity_trays_per_week": (11000.0, 12000.0, 20000.0),
    "base_process_capacity_trays_per_week": (3400.0, 6000.0),
    "base_labor_hours_per_week": (620.0, 1100.0),
}
#: Racks that every week fits, so that costs can be compared along them.
MONOTONE = {
    "rack_capacity_trays_per_week": (14000.0, 20000.0, 26000.0),
    "base_process_capacity_trays_per_week": (4000.0, 6000.0),
    "base_labor_hours_per_week": (700.0, 1100.0),
}
SWEEP_RATES = {"base_wage_per_hour": (20.0, 24.0), "price_factor": (1.0, 1.5)}


#: The columns read from the given tables; stated, so no scan starts with inference.
GIVEN = {
    "nation": _given(n_nationkey="int"),
    "supplier": _given(s_suppkey="bigint", s_nationkey="int", s_acctbal="double"),
    "part": _given(p_partkey="bigint", p_type="string"),
    "orders": _given(
        o_orderkey="bigint", o_totalprice="double", o_orderdate="timestamp_ntz"
    ),
    "lineitem": _given(
        l_orderkey="bigint", l_partkey="bigint", l_suppkey="bigint", l_linenumber="int",
        l_quantity="double", l_shipdate="timestamp_ntz",
    ),
    "events": _given(
        event_id="bigint", ts="timestamp_ntz", user_id="bigint", event_type="string",
        value="double", props="string",
    ),
}


class Inputs:
    """Lazy planning tables over one directory of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        if name not in self._given:
            self._given[name] = read_table(self.spark, self.sf_dir, name, GIVEN[name])
        return self._given[name]

    @cached_property
    def params(self) -> DataFrame:
        return params_table(self.spark, PARAMS)

    @cached_property
    def part_crops(self) -> DataFrame:
        """Crops in use, from the part table."""
        return self.given("part").select(F.col("p_type").alias("crop")).distinct()

    @cached_property
    def used_params(self) -> DataFrame:
        """Parameter rows of the crops in use."""
        return self.part_crops.join(self.params, "crop")

    # Raw daily tables -----------------------------------------------------------

    def demand_lines(
        self, anchor: str = ANCHOR, weeks: int | None = None, first_week: int | None = 1
    ) -> DataFrame:
        lines = self.given("lineitem").select(
            "l_partkey", "l_suppkey", "l_shipdate", F.col("l_quantity").alias("demand_lbs")
        )
        parts = self.given("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("crop")
        )
        dated = with_week_id(lines, "l_shipdate", anchor, weeks, first_week)
        return dated.join(parts, "l_partkey")

    def lines_before(self) -> DataFrame:
        """All lines before the late anchor (weeks up to 0)."""
        return self.demand_lines(LATE_ANCHOR, weeks=0, first_week=None)

    def demand_daily(self, weeks: int | None = None) -> DataFrame:
        return self.demand_lines(weeks=weeks).select(
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), "week_id", "crop",
            "demand_lbs",
        )

    def prices_daily(self, weeks: int | None = None) -> DataFrame:
        orders = self.given("orders").select("o_orderdate", "o_totalprice")
        return with_week_id(orders, "o_orderdate", ANCHOR, weeks).select(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), "week_id",
            (F.col("o_totalprice") / F.lit(1e6)).alias("energy_price_per_kwh"),
        )

    def telemetry_rows(self) -> DataFrame:
        return with_week_id(self.given("events"), "ts", EVENT_ANCHOR).select(
            F.date_format("ts", "yyyy-MM-dd").alias("date"), "week_id",
            F.col("event_type").alias("crop"),
            F.col("user_id").cast("string").alias("tray_id"),
            F.get_json_object("props", "$.k").cast("int").alias("stage_age_days"),
            F.col("value").alias("kwh_used"),
            F.lit(True).alias("is_active"),
        )

    def telemetry_counts(self) -> DataFrame:
        days = self.telemetry_rows().groupBy("date", "week_id", "crop").agg(
            F.count(F.lit(1)).alias("active_trays"),
            F.max("stage_age_days").alias("stage_age_days"),
            F.sum("kwh_used").alias("kwh_used"),
        )
        return days.select(
            "date", "week_id", "crop", F.concat_ws("_", "crop", "date").alias("batch_id"),
            "active_trays", "stage_age_days", "kwh_used",
            (F.col("active_trays") > 0).alias("is_active"),
        )

    # Weekly tables --------------------------------------------------------------

    @cached_property
    def demand_weekly(self) -> DataFrame:
        return rollup_demand(self.demand_daily())

    @cached_property
    def crop_grid(self) -> DataFrame:
        return crop_week_grid(self.params, WEEKS)

    @cached_property
    def demand(self) -> DataFrame:
        """Dense weekly demand of the horizon."""
        daily = self.demand_daily(weeks=WEEKS)
        return densify_zero(daily, self.crop_grid, "demand_lbs", WEEKS)

    @cached_property
    def late_demand(self) -> DataFrame:
        """The same with the weeks no planting can reach set to 0."""
        return self.reachable(self.demand)

    def reachable(self, demand: DataFrame) -> DataFrame:
        """Demand with the weeks no planting can reach set to 0."""
        names = demand.columns
        reached = F.when(F.col("week_id") > F.col("g_min_weeks"), F.col("demand_lbs")).otherwise(0.0)
        return demand.join(self.params.select("crop", "g_min_weeks"), "crop").withColumn(
            "demand_lbs", reached).select(*names)

    @cached_property
    def price(self) -> DataFrame:
        """Dense weekly price of the horizon."""
        weekly = rollup_price(self.prices_daily(weeks=WEEKS))
        return densify_mean(
            weekly, week_grid(self.spark, WEEKS), "price_per_kwh", weeks=WEEKS
        )

    # Scenarios ------------------------------------------------------------------

    @cached_property
    def scale(self):
        """Line items per 60,000, as a scalar subquery."""
        lines = self.given("lineitem").agg(F.count(F.lit(1)).cast("double"))
        return lines.scalar() / F.lit(LINES_PER_UNIT)

    def scenario(self, caps: dict[str, float] = TIGHT, share: float = 1.0) -> Scenario:
        def sized(name: str):
            return F.lit(caps[name] * share) * self.scale

        return Scenario(
            rack_capacity_trays_per_week=sized("rack"),
            base_process_capacity_trays_per_week=sized("process"),
            base_labor_hours_per_week=sized("labor"),
            overtime_block_hours=(sized("block"), sized("block")),
            shift_fixed_cost_per_week=sized("shift"),
        )

    # Plans ----------------------------------------------------------------------

    @cached_property
    def plan(self) -> DataFrame:
        return back_schedule(self.demand, self.params)

    @cached_property
    def plan_planted(self) -> DataFrame:
        return planted(self.plan)

    def changed_harvest(self, every: int, by: int) -> DataFrame:
        """The plan with its harvests changed in every n-th week."""
        hit = F.col("harvest_week") % every == 0
        return self.plan.withColumn(
            "trays", F.when(hit, F.col("trays") + by).otherwise(F.col("trays"))
        ).filter(F.col("trays") > 0)

    def late_plan(self) -> DataFrame:
        """The plan with plantings up to two weeks earlier, past some windows."""
        earlier = F.col("plant_week") - F.col("harvest_week") % 3
        return self.plan.withColumn("plant_week", earlier).filter(F.col("plant_week") >= 1)

    # Initial stock --------------------------------------------------------------

    @cached_property
    def initial_stock(self) -> DataFrame:
        """All lines before the late anchor, as stock by age; too old lots drop out later."""
        return self.lines_before().groupBy("crop", (-F.col("week_id")).cast("int").alias("age")).agg(
            F.sum("demand_lbs").cast("long").alias("qty")
        )

    @cached_property
    def demand_after_stock(self) -> DataFrame:
        """Dense weekly demand counted from the late anchor."""
        lines = self.demand_lines(LATE_ANCHOR, LATE_WEEKS)
        return densify_zero(
            lines, crop_week_grid(self.params, LATE_WEEKS), "demand_lbs", LATE_WEEKS
        )

    # Facilities -----------------------------------------------------------------

    @cached_property
    def facilities(self) -> DataFrame:
        """One synthetic site per supplier, sized by its balance."""
        size = F.abs("s_acctbal")
        rows = self.given("supplier").select(F.col("s_suppkey").alias("facility"), size.alias("x"))
        return scenario_table(
            rows, Scenario(),
            rack_capacity_trays_per_week=60 + F.floor(F.col("x") / 250),
            base_process_capacity_trays_per_week=15 + F.floor(F.col("x") / 1000),
            base_labor_hours_per_week=10 + F.floor(F.col("x") / 1000),
            overtime_block_hours=F.array(F.lit(4.0), 1.0 + F.floor(F.col("x") / 2000)),
        ).drop("x")

    @cached_property
    def nations(self) -> DataFrame:
        return self.given("nation").select(F.col("n_nationkey").alias("facility"))

    def nation_lines(self, weeks: int | None = None) -> DataFrame:
        """Demand rows with the nation of their supplier."""
        suppliers = self.given("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("facility")
        )
        return self.demand_lines(weeks=weeks, first_week=1 if weeks else None).join(suppliers, "l_suppkey")

    @cached_property
    def nation_demand(self) -> DataFrame:
        """Dense weekly demand per supplier nation."""
        grid = crop_week_grid(self.params, WEEKS, self.nations)
        return densify_zero(self.nation_lines(WEEKS), grid, "demand_lbs", WEEKS)
