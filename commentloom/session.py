"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "commentloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators assume (AQE on, UTC)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session, where driver and
    executors share one disk, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if path is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        path = tempfile.mkdtemp(prefix="commentloom-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder so later passes see the same partitions."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder; later reads pick their columns."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """How many ways a hot group is spread: the session's shuffle partition count."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
