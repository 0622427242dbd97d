"""Session set-up and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", app: str = "reportarium", **conf: str) -> SparkSession:
    """Local session used by tests and the bench; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "16g",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor sees: the one the session names, else a local one in local mode."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """A step's result, written to the shared folder and read back: it outlives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)
