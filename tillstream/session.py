"""Session set-up and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "tillstream", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps on the wire carry no zone and mean UTC, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A local session without the setting gets a temporary folder; on a cluster that would be
    a different disk on every machine, so there a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tillstream-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Compute a table once and keep it in the shared folder.

    Used for tables that are both counted and joined: the count decides the join strategy and
    must not recompute the table. The files outlive any executor.
    """
    path = new_folder(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
