"""Session helpers: builder for tests/bench and shared-folder lookup."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "skumix", event_log_dir: str | None = None) -> SparkSession:
    """A session tuned the way the library expects to run.

    AQE re-plans joins and coalesces/splits partitions at runtime; the
    skew-join switch splits a hot product or order key across tasks.
    On a cluster pass the same settings through spark-submit instead.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:  # stage/task timings without a UI: read the JSON log afterwards
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local-mode session without
    one (tests) gets a private temporary folder; on a cluster a
    machine-local folder would not survive a lost executor, so the
    setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...): "
                               "skumix checkpoints its per-product tables there")
        configured = tempfile.mkdtemp(prefix="skumix-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "skumix", *parts, uuid.uuid4().hex)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files) and, unlike an RDD
    checkpoint, keeps column pruning, filter push-down and true sizes."""
    path = scratch_path(df.sparkSession, "tables", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let executors remove the shuffle files of queries that have ended.

    Spark removes them when the driver's garbage is collected, which may be
    long after; a query of several passes over the log holds all of them
    until then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SCRATCH: list[tuple[str, str]] = []


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh shared path that :func:`remove_scratch` deletes."""
    path = shared_path(spark, *parts)
    _SCRATCH.append((spark.sparkContext.applicationId, path))
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the tables this application has written to the shared folder
    for its own use; returns how many.  Call when their readers are done."""
    app, jvm = spark.sparkContext.applicationId, spark.sparkContext._jvm
    mine = [p for a, p in _SCRATCH if a == app]
    for p in mine:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _SCRATCH[:] = [x for x in _SCRATCH if x[0] != app]
    return len(mine)
