"""Segment alerts as one stateful query, without reading a period again.

Transactions of fixed-length periods flow through three stateful operators:

1. ``transformWithState`` keeps the distinct (product, kind, value) of the
   open periods: every distinct row, order and customer, in buckets by the
   hash of all three, so a hot product is spread over all tasks.  Values are
   packed by bucket where they are read and stay so in the state, a few bytes
   a value (a state key and a row for each took many times the log's own size
   on disk).  A timer at the period's end counts each product's values;
2. a windowed sum per product turns the buckets' counts into the product's
   features when the watermark closes the period;
3. ``transformWithState`` compares each product's label of the period with
   the one before.  It holds one label per product, in buckets of products
   (a call for each product took longer than all else); a timer at the end
   of the next period tells products that have vanished.

State holds what open periods need and no more: closed windows are dropped,
a vanished product's label is cleared.  Its files of older batches than the
last two are removed, and executors hold a copy only while a task uses it
(``STORE``).  Rows that are later than the
watermark are left out, as in any such stream; :mod:`.monitor` is the form
that takes them in at the price of reading their periods again.  Labels use
the scaling of a reference period, which the caller gives as numbers, so a
changed label means changed behaviour."""

from __future__ import annotations

import os
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from .. import CONCENTRATION, CUSTOMERS, FREQUENCY, MODEL_FEATURES, PRODUCT_ID, VOLUME
from ..functions.columns import concentration_ratio, week_key
from ..operators.assign import FIXED_CENTERS, label_fixed
from ..operators.scale import zname

STREAM_SCHEMA = "id long, line int, date date, week int, product_id long, customer_id long"
ALERT_SCHEMA = "product_id long, period long, cluster_before int, cluster_after int, change string"
DAY_MS = 86_400_000
BUCKETS = 4096  # of products whose labels are one state value; fixed once a checkpoint exists
KINDS = (VOLUME, FREQUENCY, CUSTOMERS)
VALUE = ("id", "customer_id", "line", "day", "week", "missing")  # a value's columns; those its kind has not are 0
OWN = (VALUE, ("id",), ("customer_id",))  # what a value of each kind consists of
BUCKET = ("row_bucket", "order_bucket", "customer_bucket")
SPREAD = 1024  # buckets of a kind's values, if the caller gives no number; fixed once a checkpoint exists
PACK_LINES = 250_000  # of a task, before they are packed
MOST_PARTS = 16  # of a bucket and period, before they become one
PART_VALUES = 1_000_000  # of what arrives for a bucket and period, unpacked at once
STORE = {  # transformWithState needs RocksDB
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.minBatchesToRetain": "2"}


def period_of(date, days: int):
    """Number of the period of a date: whole periods since 1970-01-01."""
    return F.floor(F.datediff(date, F.lit("1970-01-01").cast("date")) / days).cast("long")


def reference_scale(features: DataFrame, cols: Sequence[str] = MODEL_FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and sample standard deviation of the reference period's features
    (a few numbers)."""
    r = features.agg(*[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in cols
                       for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
    return {c: (r[f"m_{c}"] or 0.0, r[f"s_{c}"] or 0.0) for c in cols}


class LabelChanges(StatefulProcessor):
    """Per product: the label of its latest period, and alerts on changes.

    The key is a bucket of products, whose labels are one state value, so
    state is read and written once per bucket and batch, not once per
    product; what is told of a product depends on its own rows only."""

    def __init__(self, days: int, first_period: int):
        self.days, self.first = days, first_period

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getValueState("latest", "labels binary")

    def _load(self) -> dict[int, tuple[int, int]]:
        """product -> (its latest period, its label there)."""
        import numpy as np
        if not self.latest.exists():
            return {}
        table = np.frombuffer(bytes(self.latest.get()[0]), dtype="<i8").reshape(-1, 3)
        return {product: (period, cluster) for product, period, cluster in table.tolist()}

    def _keep(self, labels: dict[int, tuple[int, int]]) -> None:
        import numpy as np
        if labels:
            self.latest.update((np.array([(p, *v) for p, v in labels.items()], dtype="<i8").tobytes(),))
        else:
            self.latest.clear()

    def _row(self, product, period, before, after):
        kind = "appeared" if before is None else "vanished" if after is None else "changed"
        return (product, period, before, after, kind)

    def _end(self, period: int) -> int:
        """When a product whose latest period is ``period`` has vanished: the
        end of the next period."""
        return (period + 2) * self.days * DAY_MS

    @staticmethod
    def _table(rows):
        import pandas as pd
        t = pd.DataFrame(rows, columns=["product_id", "period", "cluster_before", "cluster_after", "change"])
        return t.astype({"product_id": "Int64", "period": "Int64", "cluster_before": "Int32", "cluster_after": "Int32"})

    def handleInputRows(self, key, rows, timerValues):
        new = sorted((int(r), int(p), int(c)) for df in rows
                     for r, p, c in zip(df[PRODUCT_ID], df["period"], df["cluster"]))
        labels, out = self._load(), []
        for product, p, c in new:  # one row per product and closed period in which it sold
            period, cluster = labels.get(product, (None, None))
            if period is not None and p > period + 1:  # absent in between
                out.append(self._row(product, period + 1, cluster, None))
                period = cluster = None
            if period is None:
                if p > self.first:
                    out.append(self._row(product, p, None, c))
            elif c != cluster:
                out.append(self._row(product, p, cluster, c))
            labels[product] = (p, c)
        ends = {self._end(labels[product][0]) for product, _, _ in new}
        self._keep(labels)
        for end in ends:
            self.handle.registerTimer(end)
        if out:
            yield self._table(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        labels, now = self._load(), expiredTimerInfo.getExpiryTimeInMs()
        gone = sorted(product for product, (period, _) in labels.items() if now >= self._end(period))
        if gone:
            out = [self._row(product, labels[product][0] + 1, labels[product][1], None) for product in gone]
            for product in gone:
                del labels[product]
            self._keep(labels)
            yield self._table(out)

    def close(self) -> None:
        pass


def _distinct(table):
    """The distinct rows of an integer table, sorted."""
    import numpy as np
    if len(table) < 2:
        return table
    table = table[np.lexsort(table.T[::-1])]
    return table[np.append(True, (table[1:] != table[:-1]).any(axis=1))]


def pack(table) -> bytes:
    """A sorted integer table in few bytes: the first column's steps, and all
    values' bytes by their place in the number (most are 0)."""
    import numpy as np
    t = np.ascontiguousarray(table.T, dtype="<i8")
    t[0, 1:] = np.diff(table[:, 0])
    return zlib.compress(np.ascontiguousarray(t.view("u1").reshape(t.size, 8).T).tobytes(), 1)


def unpack(packed: bytes, columns: int):
    import numpy as np
    t = np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), dtype="u1").reshape(8, -1).T)
    t = t.view("<i8").reshape(columns, -1)
    t[0] = np.cumsum(t[0])
    return t.T


def packed_values(batches):
    """Arrow batches of lines -> (bucket, the latest time seen in the period,
    its end, number of distinct values, these packed), at most one row a bucket and period for ``PACK_LINES``."""
    import numpy as np
    import pyarrow as pa
    columns = ("ends", PRODUCT_ID, *VALUE)

    def packs(held):
        whole = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in held[0].schema.names}
        last = {end: int(whole["at"][whole["ends"] == end].max()) for end in np.unique(whole["ends"]).tolist()}
        rows = []
        for own, bucket in zip(OWN, BUCKET):
            here = whole[bucket] >= 0  # the others have no value of this kind
            table = np.zeros((int(here.sum()), 1 + len(columns)), dtype="<i8")
            for i, c in enumerate((bucket, *columns)):
                if c not in VALUE or c in own:
                    table[:, i] = whole[c][here]
            table = _distinct(table)
            starts = np.flatnonzero(np.append(True, (table[1:, :2] != table[:-1, :2]).any(axis=1))) if len(table) else ()
            rows += [(int(t[0, 0]), last[int(t[0, 1])], int(t[0, 1]), len(t), pack(t[:, 2:])) for t in np.split(table, starts[1:]) if len(t)]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            names=["bucket", "at", "ends", "n", "packed"])

    held, lines = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            lines += batch.num_rows
        if lines >= PACK_LINES:
            yield packs(held)
            held, lines = [], 0
    if held:
        yield packs(held)


class DistinctValues(StatefulProcessor):
    """The distinct (product, value) of a bucket and period, and how many each
    product has when the period ends.

    The key is a bucket, which holds values of one kind.  What arrives is
    added as a part of its own, so a batch costs its own size; parts become
    one when there are ``MOST_PARTS``, so that copies in later batches do not
    pile up."""

    OUT = "ts timestamp, product_id long, kind int, values long"

    def __init__(self, spread: int = SPREAD):
        self.spread = spread

    def init(self, handle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "ends long, part int", "packed binary")

    @staticmethod
    def _whole(packs):
        import numpy as np
        return _distinct(np.concatenate([unpack(bytes(x), 1 + len(VALUE)) for x in packs]))

    def _read(self, keys):
        return self._whole([self.parts.getValue(k)[0] for k in keys])

    def _add(self, end: int, packs: list, keys: list) -> None:
        new = (end, 1 + max((k[1] for k in keys), default=-1))
        self.parts.updateValue(new, (packs[0] if len(packs) == 1 else pack(self._whole(packs)),))
        keys.append(new)
        if len(keys) >= MOST_PARTS:
            whole = self._read(keys)
            for k in keys[1:]:
                self.parts.removeKey(k)
            self.parts.updateValue(keys[0], (pack(whole),))
            del keys[1:]

    def handleInputRows(self, key, rows, timerValues):
        held: dict[int, list] = {}
        for k in self.parts.keys() if self.parts.exists() else ():
            held.setdefault(int(k[0]), []).append((int(k[0]), int(k[1])))
        known, new, values = set(held), {}, {}
        for df in rows:
            for end, packed, n in zip(df["ends"].tolist(), df["packed"], df["n"].tolist()):
                new.setdefault(end, []).append(bytes(packed))
                values[end] = values.get(end, 0) + n
                if values[end] >= PART_VALUES:
                    self._add(end, new.pop(end), held.setdefault(end, []))
                    values[end] = 0
        for end, packs in new.items():
            self._add(end, packs, held.setdefault(end, []))
        for end in set(held) - known:
            self.handle.registerTimer(end - 1)  # has expired once the watermark is at the end
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import numpy as np
        import pandas as pd
        end = expiredTimerInfo.getExpiryTimeInMs() + 1
        keys = [(int(k[0]), int(k[1])) for k in self.parts.keys() if int(k[0]) == end]
        if keys:
            products, counts = np.unique(self._read(keys)[:, 0], return_counts=True)
            for k in keys:
                self.parts.removeKey(k)
            ts = pd.Timestamp(end, unit="ms", tz="UTC") - pd.Timedelta(1, unit="us")
            yield pd.DataFrame({"ts": ts, PRODUCT_ID: products, "kind": np.int32(int(key[0]) // self.spread), "values": counts})

    def close(self) -> None:
        pass


def closed_features(tx: DataFrame, days: int, late_days: int, spread: int = SPREAD) -> DataFrame:
    """(period_time, product, features) of every product and period, when the
    watermark closes the period.  Copies of a row count once."""
    length = f"{days} days"
    known = tx.where(F.col(PRODUCT_ID).isNotNull()).withColumn("ts", F.col("date").cast("timestamp"))
    # what is missing is told by a bit, so that a value has numbers only
    numbers = {c: F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("id", "customer_id", "line")}
    numbers["day"] = F.unix_date("date").cast("long")
    numbers["week"] = F.coalesce(F.col("week").cast("long") - week_key(F.col("date")), F.lit(0))  # as good as the week, mostly 0
    numbers["missing"] = sum((F.when(F.col(c).isNull(), 2 ** i).otherwise(0)
                              for i, c in enumerate(("id", "customer_id", "line", "week"))), F.lit(0)).cast("long")
    here = (F.lit(True), F.col("id").isNotNull(), F.col("customer_id").isNotNull())
    buckets = [F.when(h, i * spread + F.pmod(F.xxhash64(PRODUCT_ID, *[numbers[c] for c in own]), F.lit(spread)))
               .otherwise(-1).cast("int").alias(b) for i, (h, own, b) in enumerate(zip(here, OWN, BUCKET))]
    lines = known.withColumn("window", F.window("ts", length)).select(
        F.unix_micros("ts").alias("at"), F.unix_millis("window.end").alias("ends"), PRODUCT_ID,
        *[numbers[c].alias(c) for c in VALUE], *buckets)
    packs = lines.mapInArrow(packed_values, "bucket int, at long, ends long, n int, packed binary")
    packs = packs.withColumn("at", F.timestamp_micros("at")).withWatermark("at", f"{late_days} days")
    # all of a pack's lines are of one period, whose end decides whether they are late
    distinct = (packs.withColumn("window", F.window("at", length))
                .select(F.window_time("window").alias("ts"), "ends", "bucket", "packed", "n")
                .groupBy("bucket")
                .transformWithStateInPandas(DistinctValues(spread), DistinctValues.OUT, "Append", "EventTime",
                                            eventTimeColumnName="ts"))
    return (distinct.groupBy(F.window("ts", length), PRODUCT_ID)
            .agg(*[F.coalesce(F.sum(F.when(F.col("kind") == i, F.col("values"))), F.lit(0)).alias(c)
                   for i, c in enumerate(KINDS)])
            .select(F.window_time("window").alias("ts"), PRODUCT_ID, VOLUME, FREQUENCY, CUSTOMERS)
            .withColumn(CONCENTRATION, concentration_ratio(F.col(VOLUME), F.col(CUSTOMERS))))


def start_label_monitor(spark: SparkSession, source_dir: str, master: DataFrame, state_dir: str,
                        scale: dict[str, tuple[float, float]], first_period: int, days: int, late_days: int = 7,
                        centers: Sequence[Sequence[float]] = FIXED_CENTERS, available_now: bool = True,
                        processing_time: str | None = None, spread: int = SPREAD) -> StreamingQuery:
    """Start (or go on with) the monitor over parquet transaction files.

    ``spread`` is the number of buckets of each kind's values, the same at
    every start: a task holds one bucket's values of a period at a time.
    Alerts are appended to ``state_dir``/alerts, exactly once; the query's
    checkpoint lies beside them, so a new start goes on where the last one
    ended."""
    tx = spark.readStream.schema(STREAM_SCHEMA).parquet(source_dir)
    sold = closed_features(tx, days, late_days, spread).where(F.col(CONCENTRATION).isNotNull())
    known = sold.join(master.where(F.col(PRODUCT_ID).isNotNull()).select(PRODUCT_ID), PRODUCT_ID, "left_semi")
    for c in MODEL_FEATURES:
        mean, std = scale[c]
        z = (F.col(c).cast("double") - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)
        known = known.withColumn(zname(c), z)
    labelled = label_fixed(known, centers).select(
        "ts", PRODUCT_ID, period_of(F.col("ts").cast("date"), days).alias("period"), "cluster",
        F.pmod(F.xxhash64(PRODUCT_ID), F.lit(BUCKETS)).alias("bucket"))
    alerts = labelled.groupBy("bucket").transformWithStateInPandas(
        LabelChanges(days, first_period), ALERT_SCHEMA, "Append", "EventTime")
    writer = (alerts.writeStream.format("parquet").option("path", os.path.join(state_dir, "alerts"))
              .option("checkpointLocation", os.path.join(state_dir, "checkpoint")))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():  # the query keeps its own copy
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def read_alerts(spark: SparkSession, state_dir: str) -> DataFrame:
    return spark.read.schema(ALERT_SCHEMA).parquet(os.path.join(state_dir, "alerts"))
