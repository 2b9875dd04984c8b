"""Table sources and sinks. Paths are URIs, so any Hadoop file system works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(directory: str, name: str, suffix: str = "parquet") -> str:
    return f"{directory.rstrip('/')}/{name}.{suffix}"


def read_table(
    spark: SparkSession, directory: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """Scan one parquet table; an explicit schema saves the footer inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(directory, name))


def write_table(
    df: DataFrame, directory: str, name: str, mode: str = "overwrite",
    partition_by: tuple[str, ...] = (),
) -> str:
    """Write one parquet table from the executors, unsorted, and return its path."""
    path = table_path(directory, name)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
