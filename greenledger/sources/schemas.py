"""Explicit schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _schema(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in fields])


TELEMETRY_ROWS = _schema(
    ("date", "string"),
    ("week_id", "int"),
    ("crop", "string"),
    ("tray_id", "string"),
    ("stage_age_days", "int"),
    ("kwh_used", "double"),
    ("is_active", "boolean"),
)

TELEMETRY_COUNTS = _schema(
    ("date", "string"),
    ("week_id", "int"),
    ("crop", "string"),
    ("batch_id", "string"),
    ("active_trays", "long"),
    ("stage_age_days", "int"),
    ("kwh_used", "double"),
    ("is_active", "boolean"),
)

DEMAND_DAILY = _schema(
    ("date", "string"), ("week_id", "int"), ("crop", "string"), ("demand_lbs", "double")
)

PRICES_DAILY = _schema(
    ("date", "string"), ("week_id", "int"), ("energy_price_per_kwh", "double")
)

CROP_PARAMS = _schema(
    ("crop", "string"),
    ("g_min_weeks", "int"),
    ("g_max_weeks", "int"),
    ("yield_lbs_per_tray", "double"),
    ("shrink", "double"),
    ("plant_hours_per_tray", "double"),
    ("harvest_hours_per_tray", "double"),
    ("seed_cost_per_tray", "double"),
    ("nutrient_cost_per_tray_week", "double"),
    ("energy_kwh_per_tray_week", "double"),
)

DEMAND_WEEKLY = _schema(("crop", "string"), ("week_id", "int"), ("demand_lbs", "double"))

PRICE_WEEKLY = _schema(("week_id", "int"), ("price_per_kwh", "double"))

TELEMETRY_WEEKLY_ROWS = _schema(
    ("crop", "string"),
    ("week_id", "int"),
    ("active_tray_rows", "long"),
    ("avg_stage_age_days", "double"),
    ("kwh_used", "double"),
)

TELEMETRY_WEEKLY_COUNTS = _schema(
    ("crop", "string"),
    ("week_id", "int"),
    ("active_trays", "long"),
    ("avg_stage_age_days", "double"),
    ("kwh_used", "double"),
)

PLAN = _schema(
    ("crop", "string"), ("plant_week", "int"), ("harvest_week", "int"), ("trays", "long")
)

SOLUTION_PLANTING = _schema(("crop", "string"), ("week_id", "int"), ("trays_planted", "long"))

SOLUTION_HARVEST = _schema(
    ("crop", "string"),
    ("week_id", "int"),
    ("trays_harvested", "long"),
    ("produced_lbs", "double"),
    ("demand_lbs", "double"),
    ("waste_lbs", "double"),
)

UTILIZATION_WEEKLY = _schema(
    ("week_id", "int"),
    ("rack_used_trays", "double"),
    ("rack_capacity_trays", "double"),
    ("rack_utilization", "double"),
    ("labor_used_hours", "double"),
    ("labor_capacity_hours", "double"),
    ("labor_utilization", "double"),
    ("process_used_trays", "double"),
    ("process_capacity_trays", "double"),
    ("process_utilization", "double"),
    ("overtime_hours", "double"),
    ("overtime_blocks_enabled", "int"),
    ("shift_on", "int"),
    ("energy_cost", "double"),
)

COST_PARTS = (
    "seed_cost",
    "nutrient_cost",
    "energy_cost",
    "labor_base_cost",
    "overtime_premium_cost",
    "shift_fixed_cost",
    "disposal_cost",
)

COST_BREAKDOWN = _schema(*((part, "double") for part in (*COST_PARTS, "total_cost")))

REPORT_SUMMARY = _schema(
    ("weeks", "int"),
    ("num_crops", "int"),
    ("total_demand_lbs", "double"),
    ("total_produced_lbs", "double"),
    ("total_waste_lbs", "double"),
    ("avg_rack_utilization", "double"),
    ("avg_labor_utilization", "double"),
    ("avg_process_utilization", "double"),
    ("total_cost", "double"),
)
