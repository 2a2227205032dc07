"""Skew probe: a third of all transactions re-keyed to one product (by
arithmetic on the given tables), rolled up two ways, and the per-task
shuffle records read from Spark's event log.

    python tools/skew_probe.py [sf_dir] [scratch_dir]

Prints, per plan, the stage whose busiest task read the largest share of
that stage's shuffle records: a balanced plan keeps it near 1/partitions.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def read_events(log_dir: str):
    import zstandard
    for path in glob.glob(os.path.join(log_dir, "*", "events_*")) + glob.glob(os.path.join(log_dir, "*")):
        if os.path.isdir(path):
            continue
        raw = open(path, "rb")
        stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
        for line in io.TextIOWrapper(stream, encoding="utf-8"):
            yield json.loads(line)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="skew-")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from skumix.operators import features as feat
    from skumix.sources import tables
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tx = tables.transactions(spark, sf)
    hot = tx.withColumn("product_id", F.when((F.col("id") * 7 + F.col("line")) % 3 == 0, F.lit(1))
                        .otherwise(F.col("product_id")))
    master = tables.product_master(spark, sf)
    spark.sparkContext.setJobGroup("skumix_plan", "library roll-up")
    feat.feature_table(hot, master).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("hand_partitioned", "repartition(product_id) then aggregate")
    (hot.repartition("product_id").filter(F.col("product_id").isNotNull()).dropDuplicates()
     .groupBy("product_id").agg(F.count(F.lit(1)), F.count_distinct("id"), F.count_distinct("customer_id"))
     .write.format("noop").mode("overwrite").save())
    spark.stop()

    job_group, stage_group, recs = {}, {}, {}
    for e in read_events(scratch):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif ev == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            n = m.get("Total Records Read", 0)
            if n:
                recs.setdefault(e["Stage ID"], []).append(n)
    for group in ("skumix_plan", "hand_partitioned"):
        worst = None
        for sid, r in recs.items():
            if stage_group.get(sid) != group or sum(r) < 1000:
                continue
            share = max(r) / sum(r)
            if worst is None or share > worst[1]:
                worst = (sid, share, len(r), max(r), sum(r))
        if worst:
            sid, share, ntasks, mx, tot = worst
            print(json.dumps({"plan": group, "stage": sid, "tasks": ntasks, "busiest_task_records": mx,
                              "stage_records": tot, "busiest_share": round(share, 3)}))


if __name__ == "__main__":
    main()
