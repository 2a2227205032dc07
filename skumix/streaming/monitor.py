"""Segment-transition monitor on a stream of transaction files.

The reference recommends re-segmenting every period and alerting when a
product changes segment.  Each micro-batch's transactions (with a
``period`` column) are stored under the batch's id; every period the batch
touches is then rolled up again from all stored files, labelled with fixed
centers under the earliest period's scaling, and compared with the period
before it and the one after it.  A period that arrives in several batches,
a late earlier period and a replayed batch all end in the same tables.

State lives in written tables under ``state_dir`` (a shared folder):
``transactions/batch=<id>/period=<p>``, ``reference`` (the earliest
period's features), ``features`` (of the batch's periods, while it is
worked on), ``labels/period=<p>``, ``alerts/period=<p>``.  Nothing
is held per key in executor memory; the driver sees period ids only.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import MODEL_FEATURES, PRODUCT_ID
from ..operators.assign import FIXED_CENTERS, label_fixed
from ..operators.features import clean_transactions, join_master, product_features
from ..operators.history import transition_alerts
from ..operators.scale import complete_rows, standardise

TX_STREAM_SCHEMA = ("id long, line int, date date, week int, product_id long, customer_id long, "
                    "period int")
ALERT_SCHEMA = ("period_before int, product_id long, cluster_before int, cluster_after int, change string, "
                "period int")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended (its success mark exists)."""
    fs, p = _path(spark, os.path.join(path, "_SUCCESS"))
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _replace(df: DataFrame, path: str) -> None:
    """Overwrite the period folders that ``df`` has rows of, and no others."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("period").parquet(path))


def _features(tx: DataFrame, master: DataFrame) -> DataFrame:
    """Feature rows per (period, product), all periods in one roll-up."""
    feats = product_features(clean_transactions(tx), by=("period", PRODUCT_ID))
    return complete_rows(join_master(feats, master, extra=("period",)))


def process_batch(batch: DataFrame, batch_id: int, master: DataFrame, state_dir: str,
                  centers: Sequence[Sequence[float]] = FIXED_CENTERS) -> None:
    """Store a micro-batch and renew the labels and alerts it changes."""
    spark = batch.sparkSession
    root = os.path.join(state_dir, "transactions")
    own = os.path.join(root, f"batch={batch_id}")
    batch.write.mode("overwrite").partitionBy("period").parquet(own)  # a replay rewrites its own folder
    columns = [f for f in batch.schema.fields if f.name != "period"]
    stored = spark.read.schema(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
                               + ", batch long, period int").parquet(root).drop("batch")
    touched = {r["period"] for r in
               spark.read.schema(batch.schema).parquet(own).select("period").distinct().collect()}
    if not touched:
        return
    periods = sorted(r["period"] for r in stored.select("period").distinct().collect())  # a few ids
    reference, labels = os.path.join(state_dir, "reference"), os.path.join(state_dir, "labels")
    renewed = periods[0] in touched or not _complete(spark, reference)
    if renewed:  # the scaling changes, and every label with it
        touched = set(periods)
    # one roll-up, written: the statistics, the labels and the reference all read it
    own_features = os.path.join(state_dir, "features")
    rolled = _features(stored.where(F.col("period").isin(*touched)), master)
    rolled.write.mode("overwrite").parquet(own_features)
    feats = spark.read.schema(rolled.schema).parquet(own_features)
    if renewed:
        (feats.where(F.col("period") == periods[0]).select(PRODUCT_ID, *MODEL_FEATURES)
         .write.mode("overwrite").parquet(reference))
    labelled = label_fixed(standardise(feats, MODEL_FEATURES, stats_from=spark.read.parquet(reference)), centers)
    for p in touched:  # a period may have no complete product any more
        _remove(spark, os.path.join(labels, f"period={p}"))
    _replace(labelled.select(PRODUCT_ID, "cluster", "period"), labels)
    _remove(spark, own_features)
    # each touched period against the one before it, and the one after it anew
    pairs = [(a, b) for a, b in zip(periods, periods[1:]) if a in touched or b in touched]
    alerts = os.path.join(state_dir, "alerts")
    for _, after in pairs:
        _remove(spark, os.path.join(alerts, f"period={after}"))
    if not pairs:
        return
    history = spark.read.schema("product_id long, cluster int, period int").parquet(labels)
    step = spark.createDataFrame(pairs, "period_before int, period_after int")  # one row per period
    before = history.join(F.broadcast(step), F.col("period") == F.col("period_before"))
    after = history.join(F.broadcast(step), F.col("period") == F.col("period_after"))
    both = (before.select("period_before", "period_after", PRODUCT_ID, F.col("cluster").alias("cluster_before"))
            .join(after.select("period_before", "period_after", PRODUCT_ID,
                               F.col("cluster").alias("cluster_after")),
                  ["period_before", "period_after", PRODUCT_ID], "full_outer"))
    _replace(transition_alerts(both, extra=("period_before", "period_after"))
             .withColumnRenamed("period_after", "period"), alerts)


def start_transition_monitor(spark: SparkSession, source_dir: str, master: DataFrame, state_dir: str,
                             checkpoint_dir: str, centers: Sequence[Sequence[float]] = FIXED_CENTERS,
                             available_now: bool = True, processing_time: str | None = None,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the monitor over parquet transaction files in ``source_dir``.

    ``available_now`` processes what is there and stops (batch-like
    runs, tests); otherwise ``processing_time`` (e.g. "1 hour") polls.
    ``max_files_per_trigger`` bounds the files of a micro-batch."""
    reader = spark.readStream.schema(TX_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.parquet(source_dir).writeStream
              .foreachBatch(lambda df, epoch: process_batch(df, epoch, master, state_dir, centers))
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_alerts(spark: SparkSession, state_dir: str) -> DataFrame:
    """All alerts (period_before, period_after, product, labels, change)."""
    path = os.path.join(state_dir, "alerts")
    fs, p = _path(spark, path)
    rows = (spark.read.schema(ALERT_SCHEMA).parquet(path) if fs.exists(p)
            else spark.createDataFrame([], ALERT_SCHEMA))
    return rows.withColumnRenamed("period", "period_after")
