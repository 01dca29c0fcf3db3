"""Session helpers.

Every operator expects the session time zone to be UTC: event times are
instants and all formatted times carry a ``Z`` suffix.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a row must be tested against the watermark of the batch it arrives in
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on (idempotent, runtime-settable only)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent and the master is local (tests) a folder
    is chosen and registered on the SparkContext; later calls reuse it. On a
    cluster a missing setting is an error: a folder on the driver's disk would
    be lost with it and unseen by executors. Core Spark settings cannot be
    changed at runtime, so the session conf is not touched.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not is_local(sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    root = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a new Parquet table in the shared folder, read back.

    Each call writes its own table from the files as they are now, so the
    result can never be that of an earlier input; the lineage ends there.
    """
    path = f"{checkpoint_root(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "eventide") -> SparkSession:
    """Session for tests and the local bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("EVENTIDE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


TARGET_SHUFFLE_BYTES = 256 * 1024 * 1024


def size_shuffle_partitions(df, target_bytes: int = TARGET_SHUFFLE_BYTES, expansion: float = 3.0) -> int:
    """Set AQE's initial shuffle partition count from the input size.

    The optimizer's size estimate of ``df`` (the scanned bytes for file
    sources), times ``expansion`` for rows that fan out before a shuffle (the
    sliding windows emit three rows per event), divided by ``target_bytes``.
    AQE coalesces small partitions at run time, so starting high is cheap; too
    few partitions is what spills. Never goes below the cluster's parallelism.
    Returns the number set.
    """
    spark = df.sparkSession
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate: keep the current setting
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    floor = spark.sparkContext.defaultParallelism
    n = max(floor, int(size * expansion // target_bytes) + 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes // 2))
    return n
