"""Crop parameters, capacity scenarios, initial stock: configuration as tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from greenledger.sources.schemas import CROP_PARAMS


@dataclass(frozen=True)
class CropParam:
    crop: str
    g_min_weeks: int
    g_max_weeks: int
    yield_lbs_per_tray: float
    shrink: float
    plant_hours_per_tray: float
    harvest_hours_per_tray: float
    seed_cost_per_tray: float
    nutrient_cost_per_tray_week: float
    energy_kwh_per_tray_week: float

    def __post_init__(self) -> None:
        """The lower bound of a plan's cost holds for rates of 0 and more only."""
        for field in ("plant_hours_per_tray", "harvest_hours_per_tray", "seed_cost_per_tray",
                      "nutrient_cost_per_tray_week", "energy_kwh_per_tray_week"):
            if getattr(self, field) < 0:
                raise ValueError(f"{field} of {self.crop} is negative")


# The shipped crop parameters, in the field order of CropParam.
SHIPPED_CROPS = (
    CropParam("arugula", 3, 4, 1.10, 0.03, 0.07, 0.09, 0.18, 0.05, 3.10),
    CropParam("basil", 4, 5, 1.50, 0.04, 0.09, 0.13, 0.24, 0.07, 4.00),
    CropParam("kale", 5, 6, 2.10, 0.05, 0.10, 0.16, 0.28, 0.08, 5.00),
    CropParam("romaine", 5, 6, 2.30, 0.04, 0.11, 0.17, 0.30, 0.09, 5.20),
    CropParam("spinach", 4, 5, 1.40, 0.06, 0.09, 0.14, 0.23, 0.07, 4.40),
    CropParam("mixed_greens", 3, 4, 1.00, 0.03, 0.07, 0.10, 0.19, 0.05, 3.30),
)


@dataclass(frozen=True)
class Scenario:
    """One capacity, wage and cost setting, plus the knobs of synthetic tables.

    The defaults are the shipped values. A numeric field may also be a Column
    (for example a scalar subquery), so a setting can follow the data.
    """

    # Shipped capacities and rates.
    rack_capacity_trays_per_week: float | Column = 1200.0
    base_labor_hours_per_week: float | Column = 220.0
    base_process_capacity_trays_per_week: float | Column = 240.0
    overtime_block_hours: tuple[float | Column, ...] = (40.0, 40.0)
    overtime_premium_per_hour: float | Column = 12.0
    base_wage_per_hour: float | Column = 24.0
    shift_fixed_cost_per_week: float | Column = 180.0
    shift_labor_reduction_pct: float | Column = 0.15
    disposal_cost_per_lb_waste: float | Column = 0.35
    # Shipped shape of synthetic demand and prices.
    demand_seasonality: float = 0.12
    demand_noise_std: float = 0.08
    utilization_target: float = 0.70
    safety_factor: float = 0.90
    price_base_per_kwh: float = 0.13
    price_seasonality: float = 0.08
    price_noise_std: float = 0.01

    def __post_init__(self) -> None:
        for field in fields(self):
            value = getattr(self, field.name)
            values = value if isinstance(value, tuple) else (value,)
            if any(not isinstance(v, Column) and v < 0 for v in values):
                raise ValueError(f"{field.name} must not be negative")
        reduction = self.shift_labor_reduction_pct
        if not isinstance(reduction, Column) and reduction > 1:
            raise ValueError("shift_labor_reduction_pct must lie in [0, 1]")

    def with_(self, **changes) -> Scenario:
        return replace(self, **changes)

    def as_columns(self, names: Sequence[str] | None = None) -> dict[str, Column]:
        """The setting as named columns; overtime blocks become one array."""
        out = {}
        for name in names or SCENARIO_COLUMNS:
            value = getattr(self, name)
            if isinstance(value, tuple):
                items = [_double(v) for v in value]
                out[name] = (F.array(*items) if items else F.array()).cast("array<double>")
            else:
                out[name] = _double(value)
        return out


SCENARIO_COLUMNS = tuple(field.name for field in fields(Scenario))

#: The fields a plan is rated by; the others only shape synthetic tables.
RATING_COLUMNS = SCENARIO_COLUMNS[: SCENARIO_COLUMNS.index("disposal_cost_per_lb_waste") + 1]


def _double(value: float | Column) -> Column:
    return value.cast("double") if isinstance(value, Column) else F.lit(float(value))


def attach_scenario(
    df: DataFrame, scen: Scenario | DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Put the scenario columns a plan is rated by on every row.

    A :class:`Scenario` is attached as literals. A scenario table, one row per
    key, is equi-joined on the keys it shares with ``keys``; Catalyst broadcasts
    it when its size allows and shuffles otherwise.
    """
    if isinstance(scen, Scenario):
        return df.withColumns(scen.as_columns(RATING_COLUMNS))
    on = [key for key in keys if key in scen.columns]
    if not on:
        raise ValueError("a scenario table needs at least one of the partition keys")
    return df.join(scen.select(*on, *RATING_COLUMNS), on)


def scenario_table(entities: DataFrame, base: Scenario, **overrides: Column) -> DataFrame:
    """One scenario row per entity row: shipped values, some replaced by columns."""
    unknown = set(overrides) - set(SCENARIO_COLUMNS)
    if unknown:
        raise ValueError(f"not scenario fields: {sorted(unknown)}")
    columns = base.as_columns()
    columns.update({name: col.cast("double") for name, col in overrides.items()
                    if name != "overtime_block_hours"})
    if "overtime_block_hours" in overrides:
        columns["overtime_block_hours"] = overrides["overtime_block_hours"].cast("array<double>")
    return entities.select("*", *(col.alias(name) for name, col in columns.items()))


def params_table(spark: SparkSession, crops: Iterable[CropParam] = SHIPPED_CROPS) -> DataFrame:
    """One row per crop. Arrow keeps it a local relation of known size, so joins
    with it are broadcast by Catalyst's own size check."""
    rows = [{f.name: getattr(c, f.name) for f in fields(CropParam)} for c in crops]
    types = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
    arrow_schema = pa.schema(
        [(f.name, types[f.dataType.simpleString()]) for f in CROP_PARAMS.fields]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=arrow_schema))


def select_crops(params: DataFrame, crops: Sequence[str]) -> DataFrame:
    """Parameter rows of the chosen crops only."""
    return params.filter(F.col("crop").isin(list(crops)))


def dedup_params(params: DataFrame) -> DataFrame:
    """One row per crop: the smallest row in column order, so the choice is stable.

    Equal rows are merged first by a hash aggregate, on the map side as well, so a crop
    repeated in a large part of the rows costs one row per task in the shuffle and only
    differing rows are sorted for the minimum.
    """
    others = [c for c in params.columns if c != "crop"]
    return (
        params.distinct()
        .groupBy("crop")
        .agg(F.min(F.struct(*others)).alias("first_row"))
        .select("crop", *(F.col(f"first_row.{c}").alias(c) for c in others))
        .select(*params.columns)
    )


def initial_wip_rows(df: DataFrame, map_column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Unnest a ``crop -> age -> quantity`` map column to (keys.., crop, age, qty)."""
    return (
        df.select(*keys, F.explode(map_column).alias("crop", "by_age"))
        .select(*keys, "crop", F.explode("by_age").alias("age", "qty"))
        .select(*keys, "crop", F.col("age").cast("int").alias("age"),
                F.col("qty").cast("long").alias("qty"))
    )


def initial_wip_table(
    spark: SparkSession, initial_wip: Mapping[str, Mapping[int, int]]
) -> DataFrame:
    """Configured initial stock as rows (crop, age, qty)."""
    rows = [(crop, {int(a): int(q) for a, q in by_age.items()})
            for crop, by_age in initial_wip.items()]
    nested = spark.createDataFrame(rows, "crop string, by_age map<int, bigint>")
    return nested.select("crop", F.explode("by_age").alias("age", "qty"))


def has_initial(init: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row (per key that has stock rows): is any positive initial stock configured."""
    return init.groupBy(*keys).agg(
        F.coalesce(F.bool_or(F.col("qty") > 0), F.lit(False)).alias("has_initial_wip")
    )


def overtime_blocks(scen: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ordered overtime blocks with the running ceiling: (keys.., block, hours, ceiling)."""
    blocks = scen.select(*keys, F.posexplode("overtime_block_hours").alias("pos", "block_hours"))
    running = Window.partitionBy(*keys).orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return blocks.select(
        *keys, (F.col("pos") + 1).cast("int").alias("block"), "block_hours"
    ).withColumn("ceiling_hours", F.sum("block_hours").over(running))


def max_age(params: DataFrame) -> DataFrame:
    """One row: the longest growing time of any crop."""
    return params.agg(F.max("g_max_weeks").alias("max_age_weeks"))


def mean_crop_profile(params: DataFrame) -> DataFrame:
    """One row: mean growing weeks (midpoint) and mean hours per tray over crops."""
    return params.agg(
        F.avg((F.col("g_min_weeks") + F.col("g_max_weeks")) / F.lit(2.0)).alias("avg_grow_weeks"),
        F.avg(F.col("plant_hours_per_tray") + F.col("harvest_hours_per_tray")).alias(
            "avg_labor_hours"
        ),
    )
