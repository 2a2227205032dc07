"""The stateful monitor against the batch definition, over restarts."""

import datetime as dt
import os
import tempfile

import pytest

from skumix.streaming import stateful

DAYS = 28
CENTERS = ((0.0, 0.0, 0.0), (3.0, 3.0, 0.0))
SCALE = {"volume": (1.0, 1.0), "order_frequency": (1.0, 1.0), "concentration": (1.0, 1.0)}


def _date(period, day):
    return dt.date(1970, 1, 1) + dt.timedelta(days=period * DAYS + day)


def _rows(period, product, orders, day=3):
    """``orders`` single-line orders of one customer each, and a copy of the first."""
    rows = [(1000 * period + 10 * product + i, 1, _date(period, day), 0, product, 77 + i) for i in range(orders)]
    return rows + rows[:1]


@pytest.fixture()
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_alerts_equal_the_definition_over_restarts(spark, few_partitions):
    base = tempfile.mkdtemp(prefix="skumix-stateful-")
    src = os.path.join(base, "in")
    master = spark.createDataFrame([(i, f"p{i}") for i in (1, 2, 3, 4)], "product_id long, product_name string")
    # 1 changes; 2 vanishes after 100 and comes back in 103; 3 appears in 101; 4 stays; 9 is not in the master
    arrivals = [
        _rows(100, 1, 1) + _rows(100, 2, 1) + _rows(100, 4, 4) + _rows(100, 9, 1) + [(5, 1, _date(100, 4), 0, None, 1)],
        _rows(101, 1, 4) + _rows(101, 3, 1, 2) + _rows(101, 4, 4),
        _rows(102, 1, 4) + _rows(102, 4, 4) + _rows(102, 3, 1) + _rows(103, 1, 4) + _rows(103, 2, 4) + _rows(103, 4, 4) + _rows(103, 3, 1),
        _rows(104, 4, 4, day=20)]
    provider = "spark.sql.streaming.stateStore.providerClass"
    setting = spark.conf.get(provider, None)
    for rows in arrivals:
        spark.createDataFrame(rows, stateful.STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stateful.start_label_monitor(spark, src, master, base, SCALE, 100, DAYS, 7, CENTERS).awaitTermination()
    got = sorted((r.product_id, r.period, r.cluster_before, r.cluster_after, r.change)
                 for r in stateful.read_alerts(spark, base).collect())
    assert got == [
        (1, 101, 0, 1, "changed"), (2, 101, 0, None, "vanished"), (2, 103, None, 1, "appeared"), (3, 101, None, 0, "appeared")]
    assert spark.conf.get(provider, None) == setting
    # nothing new: a further start adds no alert
    stateful.start_label_monitor(spark, src, master, base, SCALE, 100, DAYS, 7, CENTERS).awaitTermination()
    assert stateful.read_alerts(spark, base).count() == 4


def test_state_is_read_once_per_bucket_of_products():
    """Products of a bucket share one state value, whatever their number, and
    each is told of by its own rows: a change, an absence, a vanishing."""
    import pandas as pd

    class State:
        value, calls = None, 0

        def exists(self):
            return self.value is not None

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.state, self.timers = State(), set()

        def getValueState(self, name, schema):
            return self.state

        def registerTimer(self, at):
            self.timers.add(at)

    class Expired:
        def __init__(self, at):
            self.at = at

        def getExpiryTimeInMs(self):
            return self.at

    def table(rows):
        return pd.DataFrame(rows, columns=["product_id", "period", "cluster"])

    handle, n = Handle(), 500
    changes = stateful.LabelChanges(DAYS, 100)
    changes.init(handle)
    assert list(changes.handleInputRows((0,), iter([table([(p, 100, 0) for p in range(n)])]), None)) == []
    got = pd.concat(changes.handleInputRows((0,), iter([table([(0, 101, 1), (2, 103, 0)]), table([(n, 101, 2)])]), None))
    assert [tuple(None if pd.isna(v) else v for v in r) for r in got.itertuples(index=False)] == [
        (0, 101, 0, 1, "changed"), (2, 101, 0, None, "vanished"), (2, 103, None, 0, "appeared"), (n, 101, None, 2, "appeared")]
    assert handle.state.calls == 3  # not once per product
    end = 102 * DAYS * stateful.DAY_MS
    assert handle.timers == {end, end + DAYS * stateful.DAY_MS, end + 3 * DAYS * stateful.DAY_MS}
    gone = pd.concat(changes.handleExpiredTimer((0,), None, Expired(end)))
    assert list(gone.product_id) == [1, *range(3, n)] and set(gone.period) == {101}
    assert list(changes.handleExpiredTimer((0,), None, Expired(end))) == []
    assert list(pd.concat(changes.handleExpiredTimer((0,), None, Expired(end + 3 * DAYS * stateful.DAY_MS))).product_id) == [0, 2, n]
    assert not handle.state.exists()


def test_reference_scale_and_period_numbers(spark):
    from pyspark.sql import functions as F
    f = spark.createDataFrame([(1, 2, 3.0), (3, 2, 5.0)], "volume long, order_frequency long, concentration double")
    got = stateful.reference_scale(f)
    assert got["volume"] == pytest.approx((2.0, 2 ** 0.5)) and got["order_frequency"] == (2.0, 0.0)
    days = spark.createDataFrame([(dt.date(1970, 1, 1),), (dt.date(1970, 1, 28),), (dt.date(1970, 1, 29),),
                                  (dt.date(1969, 12, 31),)], "d date")
    assert [r[0] for r in days.select(stateful.period_of(F.col("d"), DAYS)).collect()] == [0, 0, 1, -1]


class MapState:
    def __init__(self):
        self.values = {}

    def exists(self):
        return bool(self.values)

    def keys(self):
        return iter(list(self.values))

    def getValue(self, key):
        return self.values[key]

    def updateValue(self, key, value):
        self.values[key] = value

    def removeKey(self, key):
        del self.values[key]


class MapHandle:
    def __init__(self):
        self.state, self.timers = MapState(), set()

    def getMapState(self, name, key, value):
        return self.state

    def registerTimer(self, at):
        self.timers.add(at)


def test_values_are_counted_once_and_kept_in_few_bytes():
    """A bucket's state is packed columns, not a key for each value; copies in
    one pack, in others and in later batches count once."""
    import numpy as np
    import pandas as pd
    rng, n, end = np.random.default_rng(7), 20_000, 1000 * DAYS * stateful.DAY_MS

    class Expired:
        def getExpiryTimeInMs(self):
            return end - 1

    table = np.column_stack([rng.integers(0, 2_000, n), rng.integers(-2 ** 62, 2 ** 62, n) // 2 ** 30, rng.integers(0, 900, n),
                             rng.integers(1, 8, n), rng.integers(9_000, 9_028, n), np.zeros(n), rng.integers(0, 2, n)]).astype("i8")
    whole = stateful._distinct(table)
    assert np.array_equal(stateful.unpack(stateful.pack(whole), 7), whole)
    extremes = np.array([[-2 ** 63, 1], [0, -1], [2 ** 63 - 1, 2 ** 63 - 1]], dtype="i8")
    assert np.array_equal(stateful.unpack(stateful.pack(extremes), 2), extremes)

    handle, values = MapHandle(), stateful.DistinctValues(5)
    values.init(handle)
    for batch in np.array_split(table, 2 * stateful.MOST_PARTS):  # each with rows of others
        some = [stateful._distinct(x) for x in (batch, table[:100])]
        arrived = pd.DataFrame({"ends": end, "packed": [stateful.pack(x) for x in some], "n": [len(x) for x in some]})
        assert list(values.handleInputRows((0,), iter([arrived]), None)) == []
    assert handle.timers == {end - 1} and len(handle.state.values) < stateful.MOST_PARTS
    assert sum(len(v[0]) for v in handle.state.values.values()) < 20 * n
    got = pd.concat(values.handleExpiredTimer((5,), None, Expired()))
    assert dict(zip(got["product_id"], got["values"])) == dict(zip(*np.unique(whole[:, 0], return_counts=True)))
    assert set(got["kind"]) == {1} and not handle.state.values


def test_older_state_is_removed_and_open_periods_take_rows_in(spark, few_partitions):
    """A row older than the watermark counts while its period is open, not
    after; missing ids and customers are no values, and rows that differ by
    what is missing are two; state of older batches than the last two goes."""
    base = tempfile.mkdtemp(prefix="skumix-stateful-")
    src = os.path.join(base, "in")
    master = spark.createDataFrame([(i, f"p{i}") for i in (1, 2, 3)], "product_id long, product_name string")
    missing = [(None, 1, _date(101, 5), 0, 2, 7), (0, 1, _date(101, 5), 0, 2, 7), (0, 1, _date(101, 5), 0, 2, None),
               (0, None, _date(101, 5), 0, 2, 7), (None, 1, _date(101, 5), 0, 2, 7), (None, 1, None, 0, 2, 7)]
    arrivals = [
        _rows(100, 1, 1) + _rows(100, 2, 1) + _rows(101, 3, 1, 27),
        _rows(101, 1, 4, 2) + missing + _rows(100, 1, 4) + _rows(103, 3, 4),  # 100 is closed
        _rows(105, 3, 4)]
    # centers tell volume 4 from 1 for 2, whose orders are one
    centers = ((0.0, 0.0, 0.0), (3.0, 0.0, 3.0), (3.0, 3.0, 0.0))
    for rows in arrivals:
        spark.createDataFrame(rows, stateful.STREAM_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stateful.start_label_monitor(spark, src, master, base, SCALE, 100, DAYS, 7, centers).awaitTermination()
    got = sorted((r.product_id, r.period, r.cluster_before, r.cluster_after, r.change)
                 for r in stateful.read_alerts(spark, base).collect())
    assert got == [
        (1, 101, 0, 2, "changed"), (1, 102, 2, None, "vanished"), (2, 101, 0, 1, "changed"), (2, 102, 1, None, "vanished"),
        (3, 101, None, 0, "appeared"), (3, 102, 0, None, "vanished"), (3, 103, None, 2, "appeared")]
    kept = {}
    for folder, _, files in os.walk(os.path.join(base, "checkpoint", "state")):
        versions = [f for f in files if f.endswith(".zip")]
        if versions:
            kept[folder] = len(versions)
    assert kept and max(kept.values()) <= 3


def test_parts_of_the_log_do_not_stay(spark, monkeypatch):
    """Each start sees its own part only; at the end the alerts alone are left."""
    from skumix.plans import catalog
    tables = tempfile.mkdtemp(prefix="skumix-tables-")
    years = [dt.date(1992 + i, 6, 1) for i in range(8)]
    spark.createDataFrame([(i, 1, 1 + i % 2, d) for i, d in enumerate(years)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate date").write.parquet(f"{tables}/lineitem.parquet")
    spark.createDataFrame([(i, 5) for i in range(8)], "o_orderkey long, o_custkey long").write.parquet(f"{tables}/orders.parquet")
    spark.createDataFrame([(1, "a"), (2, "b")], "p_partkey long, p_name string").write.parquet(f"{tables}/part.parquet")
    seen = []

    class Query:
        def awaitTermination(self):
            pass

    def start(spark, src, master, base, *rest, **named):
        seen.append((src, base, sorted(r.date.year for r in spark.read.parquet(src).collect())))
        os.makedirs(os.path.join(base.removeprefix("file:"), "checkpoint"), exist_ok=True)
        return Query()

    monkeypatch.setattr(stateful, "start_label_monitor", start)
    monkeypatch.setattr(stateful, "read_alerts", lambda spark, base: base)
    base = catalog.x3_stateful_stream_alerts(spark, tables)
    assert [y for _, _, y in seen] == [[1992, 1993], [1994, 1995], [1996, 1997], [1998, 1999]]
    assert {b for _, b, _ in seen} == {base} and [x for x in os.listdir(base.removeprefix("file:")) if x in ("input", "checkpoint")] == []
