"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on. AQE coalesces small shuffles, turns a join into
#: a broadcast once the real size of a side is known, and splits skewed join
#: partitions; the rest pins parity with other engines.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every expression costs most of the planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Where a local session that names no shared folder writes.
LOCAL_FOLDER = "/tmp/checkpoints"


def build_session(app_name: str = "greenledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; the cluster supplies master and sizes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder of the cluster, removed when the session ends.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local
    session, whose executors all see this machine, may go without it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = LOCAL_FOLDER
    folder = f"{base.rstrip('/')}/greenledger-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(path)
    files.deleteOnExit(path)  # results may be read as long as the session lives
    return folder


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, read back with their schema.

    It cuts the lineage of a loop, and lost executors cost no recompute of it.
    """
    path = f"{scratch_dir(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash rows over all shuffle partitions ahead of a step that multiplies them.

    The count is explicit because AQE would otherwise merge the small input into
    one task, and that task would then produce the whole output.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *cols)
