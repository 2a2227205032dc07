"""The streaming monitor equals the batch transitions and replays safely."""

import os
import tempfile

from pyspark.sql import functions as F

from skumix.operators import history
from skumix.sources import tables
from skumix.streaming import monitor

SF = "/root/testdata/sf0.001"
CUT = "1998-07-01"


def _input(spark, base):
    src = os.path.join(base, "input")
    tx = tables.transactions(spark, SF).withColumn(
        "period", F.when(F.col("date") < F.lit(CUT).cast("date"), F.lit(1)).otherwise(F.lit(2)))
    tx.write.mode("overwrite").partitionBy("period").parquet(src)
    return src


def _alerts(spark, state):
    return monitor.read_alerts(spark, state).select("product_id", "cluster_before", "cluster_after", "change")


def _want(spark, master):
    return history.transition_alerts(history.period_transitions(tables.transactions(spark, SF), master, CUT))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_alerts_equal_batch_and_replay_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="skumix-stream-")
    src = _input(spark, base)
    master = tables.product_master(spark, SF)
    state = os.path.join(base, "state")
    q = monitor.start_transition_monitor(spark, src, master, state, os.path.join(base, "ckpt"))
    q.awaitTermination()
    got, want = _alerts(spark, state), _want(spark, master)
    assert got.count() > 0 and _same(got, want)
    # a replayed micro-batch rewrites the same folders
    monitor.process_batch(spark.read.schema(monitor.TX_STREAM_SCHEMA).parquet(src), 0, master, state)
    assert _same(_alerts(spark, state), want)


def test_split_late_and_half_written_periods_equal_the_batch_result(spark):
    """Period 1 comes late and in two batches; the first reference write
    ends without its success mark."""
    base = tempfile.mkdtemp(prefix="skumix-stream-")
    master = tables.product_master(spark, SF)
    state = os.path.join(base, "state")
    rows = spark.read.schema(monitor.TX_STREAM_SCHEMA).parquet(_input(spark, base))
    monitor.process_batch(rows.where("period = 2 and id % 2 = 0"), 0, master, state)
    os.remove(os.path.join(state, "reference", "_SUCCESS"))
    monitor.process_batch(rows.where("period = 1 and id % 3 = 0"), 1, master, state)
    monitor.process_batch(rows.where("period = 2 and id % 2 = 1"), 2, master, state)
    monitor.process_batch(rows.where("period = 1 and id % 3 <> 0"), 3, master, state)
    want = _want(spark, master)
    assert _same(_alerts(spark, state), want)
    monitor.process_batch(rows.where("period = 1 and id % 3 = 0"), 1, master, state)  # replay
    assert _same(_alerts(spark, state), want)


def test_a_batch_rolls_its_periods_up_once(spark, monkeypatch):
    """The reference is read from the batch's features, not rolled up anew."""
    base = tempfile.mkdtemp(prefix="skumix-stream-")
    rows = spark.read.schema(monitor.TX_STREAM_SCHEMA).parquet(_input(spark, base))
    calls, plain = [], monitor.product_features
    monkeypatch.setattr(monitor, "product_features", lambda *a, **k: calls.append(1) or plain(*a, **k))
    state = os.path.join(base, "state")
    monitor.process_batch(rows.where("id % 2 = 0"), 0, tables.product_master(spark, SF), state)
    assert len(calls) == 1
    assert not os.path.exists(os.path.join(state, "features"))
