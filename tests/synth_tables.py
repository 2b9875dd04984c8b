"""Raw tables for the tests, drawn per row by a keyed hash.

Every operator works for many facilities at once: ``entities`` is a table with the
key columns and one scenario per row (see ``scenario_table``), and ``keys`` names
the key columns. A row depends only on the seed and its own keys, so any executor
can redraw it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from greenledger.functions.columns import (
    clamp,
    effective_yield,
    noise_exponential,
    noise_int,
    noise_normal,
    noise_uniform,
    seasonal,
)
from greenledger.operators.calendar import cross_crops, cross_days, cross_weeks
from greenledger.operators.shares import active_flag, apportion, normalized, tray_limit
from greenledger.plans.jobs import aggregate_tables, plan_and_write, report_and_write
from greenledger.session import spread
from greenledger.sources.parameters import Scenario
from greenledger.sources.tables import write_table

# Bounds of the demand shape.
DEMAND_NOISE_FLOOR = 0.55
DEMAND_LIMIT_SHARE = 0.92
DEMAND_JITTER = (0.8, 1.2)
# Bounds of the price shape.
PRICE_FLOOR = 0.02
# Bounds of the telemetry shape.
TELEMETRY_BASE = 0.55
TELEMETRY_AMPLITUDE = 0.10
TELEMETRY_NOISE_STD = 0.08
TELEMETRY_NOISE_FLOOR = 0.35
TELEMETRY_MIN_ACTIVE = 40
TELEMETRY_JITTER = (0.85, 1.15)
DAY_JITTER = (0.93, 1.07)
KWH_JITTER = (0.9, 1.1)
TRAY_KWH_STD = 0.12
TRAY_KWH_FLOOR = 0.01

#: Trays per piece when a counted row is expanded; bounds one generated array.
EXPAND_CHUNK = 4096


def _cols(keys: Sequence[str]) -> list[Column]:
    return [F.col(k) for k in keys]


def base_weights(seed: int, tag: str, keys: Sequence[str]) -> Column:
    """A crop's share before normalization (fixed over the weeks)."""
    return noise_uniform(seed, tag, *_cols(keys), F.col("crop"))


def week_weights(
    cells: DataFrame, seed: int, tag: str, jitter: tuple[float, float], keys: Sequence[str],
    taking_part: Column | None = None,
) -> DataFrame:
    """Base weight times weekly jitter, normalized over the crops of each week that
    take part (all by default).

    The rows are spread by week here: the windows need that grouping, and the days and
    trays made from these rows later keep it.
    """
    noise = noise_uniform(
        seed, f"{tag}_jitter", *_cols(keys), F.col("crop"), F.col("week_id"),
        low=jitter[0], high=jitter[1],
    )
    weight = base_weights(seed, f"{tag}_base", keys) * noise
    if taking_part is not None:
        weight = F.when(taking_part, weight).otherwise(0.0)
    week = [*keys, "week_id"]
    return normalized(spread(cells, *week).withColumn("weight", weight), "weight", week)


def weekly_total_trays(limits: DataFrame, weeks: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """Demanded trays per week: target, season and noise, bounded by the limit."""
    noise = clamp(
        F.lit(1.0)
        + noise_normal(seed, "demand_noise", *_cols(keys), F.col("week_id"),
                       std=F.col("demand_noise_std")),
        DEMAND_NOISE_FLOOR,
    )
    shape = seasonal(F.col("week_id"), weeks, F.col("demand_seasonality"))
    trays = F.bround(F.col("target_total_trays") * shape * noise)
    top = F.bround(F.col("tray_limit") * F.lit(DEMAND_LIMIT_SHARE))
    return cross_weeks(limits, weeks).withColumn("total_trays", clamp(trays, 0.0, top).cast("long"))


def demand_shares(
    entities: DataFrame, params: DataFrame, weeks: int, seed: int, keys: Sequence[str]
) -> DataFrame:
    """Every (keys.., crop, week) cell with its week total and normalized weight, 0 for
    crops that cannot be harvested yet."""
    totals = weekly_total_trays(tray_limit(entities, params), weeks, seed, keys).select(
        *keys, "week_id", "total_trays", "safety_factor"
    )
    cells = cross_crops(totals, params).join(params, "crop")
    ripe = F.col("week_id") > F.col("g_min_weeks")
    return week_weights(cells, seed, "demand", DEMAND_JITTER, keys, ripe)


def synth_demand_weekly(
    entities: DataFrame, params: DataFrame, weeks: int, seed: int, keys: Sequence[str]
) -> DataFrame:
    """Weekly demand and its tray estimate; 0 while a crop cannot be harvested yet."""
    shares = demand_shares(entities, params, weeks, seed, keys)
    split = apportion(shares, "total_trays", "weight", [*keys, "week_id"])
    return split.select(
        *keys, "crop", "week_id",
        (F.col("trays") * effective_yield() * F.col("safety_factor")).alias("demand_lbs"),
        F.col("trays").alias("demand_trays_est"),
    )


def disaggregate(
    weekly: DataFrame, start: str, seed: int, keys: Sequence[str], value: str = "demand_lbs"
) -> DataFrame:
    """Spread each weekly total over its seven days.

    Shares are exponentials over their sum, a uniform point of the simplex, made by
    one generator on the weekly row itself. A total of zero gives zero days.
    """
    first = F.date_add(F.to_date(F.lit(start)), (F.col("week_id") - 1) * 7)
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(6)),
        lambda d: noise_exponential(
            seed, "day_share", *_cols(keys), F.col("crop"), F.col("week_id"), d
        ),
    )
    drawn = weekly.select(*keys, "crop", "week_id", value, draws.alias("draws"))
    total = F.aggregate("draws", F.lit(0.0), lambda acc, x: acc + x)
    days = drawn.withColumn("draw_total", total).select(
        *keys, "crop", "week_id", value, "draw_total", F.posexplode("draws").alias("day", "draw")
    )
    share = F.when(F.col(value) > 0, F.col("draw") / F.col("draw_total")).otherwise(0.0)
    return days.select(
        F.date_format(F.date_add(first, F.col("day")), "yyyy-MM-dd").alias("date"),
        *keys, "week_id", "crop", (F.col(value) * share).alias(value),
    )


def synth_price_daily(
    entities: DataFrame, start: str, weeks: int, seed: int, keys: Sequence[str]
) -> DataFrame:
    """Daily energy price: base, season and noise, with a floor."""
    days = cross_days(spread(entities, *keys) if keys else entities, start, weeks)
    shape = seasonal(F.col("week_id"), weeks, F.col("price_seasonality"))
    noise = F.lit(1.0) + noise_normal(
        seed, "price_noise", *_cols(keys), F.col("date"), std=F.col("price_noise_std")
    )
    price = clamp(F.col("price_base_per_kwh") * shape * noise, PRICE_FLOOR)
    return days.select("date", *keys, "week_id", price.alias("energy_price_per_kwh"))


def telemetry_levels(
    entities: DataFrame, params: DataFrame, weeks: int, seed: int, keys: Sequence[str]
) -> DataFrame:
    """Active trays per (keys.., crop, week), before the daily jitter."""
    noise = clamp(
        F.lit(1.0) + noise_normal(seed, "telemetry_noise", *_cols(keys), F.col("week_id"),
                                  std=TELEMETRY_NOISE_STD),
        TELEMETRY_NOISE_FLOOR,
    )
    rack = F.col("rack_capacity_trays_per_week")
    shape = seasonal(F.col("week_id"), weeks, TELEMETRY_AMPLITUDE, TELEMETRY_BASE)
    level = clamp(F.bround(rack * shape * noise), float(TELEMETRY_MIN_ACTIVE), rack)
    weekly = cross_weeks(entities, weeks).select(
        *keys, "week_id", F.floor(level).cast("long").alias("total_active")
    )
    cells = week_weights(cross_crops(weekly, params), seed, "telemetry", TELEMETRY_JITTER, keys)
    return apportion(cells, "total_active", "weight", [*keys, "week_id"], out="level").select(
        *keys, "crop", "week_id", "level"
    )


def synth_telemetry_counts(
    entities: DataFrame, params: DataFrame, start: str, weeks: int, seed: int, keys: Sequence[str]
) -> DataFrame:
    """One row per crop and day with its active trays, an age and the energy used."""
    levels = telemetry_levels(entities, params, weeks, seed, keys)
    first = F.date_add(F.to_date(F.lit(start)), (F.col("week_id") - 1) * 7)
    days = levels.select(
        "*", F.explode(F.sequence(first, F.date_add(first, 6))).alias("day")
    ).withColumn("date", F.date_format("day", "yyyy-MM-dd"))
    draw = [*_cols(keys), F.col("crop"), F.col("date")]
    jitter = noise_uniform(seed, "day_jitter", *draw, low=DAY_JITTER[0], high=DAY_JITTER[1])
    kwh_jitter = noise_uniform(seed, "kwh_jitter", *draw, low=KWH_JITTER[0], high=KWH_JITTER[1])
    active = clamp(F.bround(F.col("level") * jitter).cast("long"), F.lit(0).cast("long"))
    age = noise_int(seed, "age", *draw, low=1, high=_age_ceiling())
    return (
        days.join(params, "crop")
        .withColumns({"active_trays": active, "stage_age_days": age})
        .select(
            "date", *keys, "week_id", "crop",
            F.concat_ws("_", *_cols(keys), "crop", "date").alias("batch_id"),
            "active_trays", "stage_age_days",
            (F.col("active_trays") * _tray_kwh_day() * kwh_jitter).alias("kwh_used"),
            active_flag().alias("is_active"),
        )
    )


def _age_ceiling() -> Column:
    return F.greatest(F.col("g_max_weeks") * 7, F.lit(2))


def _tray_kwh_day() -> Column:
    return F.col("energy_kwh_per_tray_week") / F.lit(7.0)


def expand_rows(
    counts: DataFrame, params: DataFrame, seed: int, keys: Sequence[str]
) -> DataFrame:
    """One row per active tray, each with its own id, age and energy.

    A count is first cut into chunks, the chunks are spread over the cluster, and
    only then expanded, so one huge count is neither one array nor one task.
    """
    n = F.col("active_trays")
    starts = F.sequence(F.lit(0).cast("long"), n - 1, F.lit(EXPAND_CHUNK).cast("long"))
    chunks = spread(
        counts.filter(n > 0).select(
            "date", *keys, "week_id", "crop", "active_trays",
            F.explode(starts).alias("first_tray"),
        ),
        "date", *keys, "crop", "first_tray",
    )
    last = F.least(F.col("first_tray") + EXPAND_CHUNK, n) - 1
    trays = chunks.select(
        "date", *keys, "week_id", "crop",
        F.explode(F.sequence("first_tray", last)).alias("tray"),
    )
    draw = [*_cols(keys), F.col("crop"), F.col("date"), F.col("tray")]
    kwh = _tray_kwh_day() * noise_normal(seed, "tray_kwh", *draw, mean=1.0, std=TRAY_KWH_STD)
    return trays.join(params, "crop").select(
        "date", *keys, "week_id", "crop",
        F.concat_ws(
            "_", *_cols(keys), "crop", F.replace("date", F.lit("-"), F.lit("")),
            F.format_string("%05d", "tray"),
        ).alias("tray_id"),
        noise_int(seed, "tray_age", *draw, low=1, high=_age_ceiling()).alias("stage_age_days"),
        clamp(kwh, TRAY_KWH_FLOOR).alias("kwh_used"),
        F.lit(True).alias("is_active"),
    )


def generate(
    spark: SparkSession, entities: DataFrame, params: DataFrame, directory: str,
    start: str, weeks: int, seed: int, keys: Sequence[str] = (), mode: str = "rows",
) -> dict[str, str]:
    """Write the four raw tables and return their paths."""
    if mode not in ("rows", "counts"):
        raise ValueError("mode must be one of: rows, counts")
    weekly = synth_demand_weekly(entities, params, weeks, seed, keys)
    telemetry = synth_telemetry_counts(entities, params, start, weeks, seed, keys)
    if mode == "rows":
        telemetry = expand_rows(telemetry, params, seed, keys)
    tables = {
        "demand_daily": disaggregate(weekly, start, seed, keys),
        "prices_energy_daily": synth_price_daily(entities, start, weeks, seed, keys),
        "crop_params": params,
        "telemetry_tray_daily": telemetry,
    }
    return {name: write_table(df, directory, name) for name, df in tables.items()}


def generate_and_aggregate(
    spark: SparkSession, entities: DataFrame, params: DataFrame, directory: str, start: str,
    weeks: int, seed: int, keys: Sequence[str] = (), mode: str = "rows",
) -> dict[str, str]:
    """Generate the raw tables and roll them up, in one session."""
    generate(spark, entities, params, f"{directory}/raw", start, weeks, seed, keys, mode)
    return aggregate_tables(spark, f"{directory}/raw", f"{directory}/weekly", mode, keys)


def run_all(
    spark: SparkSession, directory: str, params: DataFrame, scen: Scenario | DataFrame,
    start: str, weeks: int, seed: int, keys: Sequence[str] = (), mode: str = "rows",
    init: DataFrame | None = None,
) -> dict[str, str]:
    """Generate, aggregate, plan and report: one site from a Scenario, or many from a
    scenario table with key columns."""
    if isinstance(scen, Scenario):
        entities = spark.range(1).select(*(c.alias(n) for n, c in scen.as_columns().items()))
    else:
        entities = scen
    keyed_by = StructType([entities.schema[key] for key in keys])
    paths = generate_and_aggregate(
        spark, entities, params, directory, start, weeks, seed, keys, mode
    )
    weekly, out = f"{directory}/weekly", f"{directory}/outputs"
    paths.update(plan_and_write(spark, weekly, out, params, scen, weeks, keys, init))
    paths.update(report_and_write(spark, weekly, out, params, weeks, keyed_by))
    return paths
