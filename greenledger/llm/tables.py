"""Reading the text tables, the fixed folds and written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The local folder used when a local session names no shared one (tests only).
LOCAL_FOLDER = "/tmp/checkpoints"


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def held_out(doc_id: Column) -> Column:
    """The fixed fifth of the documents that nothing is learned from (null: not in it)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared folder that the cluster names.

    Only a local session, whose executors all see this machine, may leave it unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = LOCAL_FOLDER
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, so that lost executors cost no recompute."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
