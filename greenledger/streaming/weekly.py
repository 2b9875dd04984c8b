"""The weekly telemetry rollup over a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from greenledger.functions.columns import week_index

#: How late a row may be, and within which time the same row is known to be a repeat.
DELAY = "14 days"


def tray_days(source: DataFrame, anchor: str) -> DataFrame:
    """Telemetry rows of raw events (event_id, ts, event_type, value)."""
    return source.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("crop"),
        F.col("value").alias("kwh_used")).withColumn("week_id", week_index("ts", anchor))


def weekly_stream(events: DataFrame, anchor: str, delay: str = DELAY) -> DataFrame:
    """Rows and energy per crop and week; a row that comes again counts once.

    State is one row per crop and week, and the ids seen within the delay. Rows later than
    the delay are dropped, as the watermark states.
    """
    rows = tray_days(events, anchor).withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    week = F.window("ts", "7 days", startTime=_offset(anchor))
    return rows.groupBy(week, "crop", "week_id").agg(
        F.count(F.lit(1)).alias("active_tray_rows"), F.sum("kwh_used").alias("kwh_used")).drop("window")


def _offset(anchor: str) -> str:
    """Where weeks of the anchor begin, from the weekday on which time began (a Thursday)."""
    import datetime

    days = (datetime.date.fromisoformat(anchor) - datetime.date(1970, 1, 1)).days % 7
    return f"{days} days"


def run_weekly(
    spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, anchor: str,
    delay: str = DELAY, files_per_batch: int | None = None,
) -> StreamingQuery:
    """Take in all files of ``source`` not yet seen and write the weeks they change.

    Each batch writes its changed weeks to a folder named by its number and overwrites it,
    so a batch that is repeated after a failure leaves the same rows. The checkpoint and the
    output must lie in a shared folder.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    weekly = weekly_stream(reader.parquet(source), anchor, delay)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    return weekly.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).foreachBatch(write).start()


def stored_weeks(spark: SparkSession, out: str) -> DataFrame:
    """The weekly table: of each crop and week what the last batch that changed it wrote."""
    rows = spark.read.option("basePath", out).parquet(f"{out.rstrip('/')}/batch=*")
    last = rows.groupBy("crop", "week_id").agg(F.max_by(
        F.struct("active_tray_rows", "kwh_used"), "batch").alias("last"))
    return last.select("crop", "week_id", "last.active_tray_rows", "last.kwh_used")
