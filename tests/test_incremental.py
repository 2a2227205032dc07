"""State that arrivals merge into equals the answer from all rows at once."""

import itertools
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from skumix.operators import features as feat
from skumix.operators import incremental, quality, stats

F4 = ("volume", "order_frequency", "unique_customers", "concentration")



@pytest.mark.parametrize("shift", [0.0, 1e9])
def test_moments_of_parts_and_ranges_equal_the_direct_queries(spark, shift):
    rng = random.Random(4)
    rows = [(i, i % 5, *[shift + rng.gauss(3, 2) for _ in range(3)], None if i % 11 == 0 else shift + rng.random())
            for i in range(500)] + [(900, 7, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, part int, volume double, order_frequency double, unique_customers double, "
                                     "concentration double").repartition(6)
    state = incremental.moment_state(df).cache()
    for parts in ([0, 1, 2, 3, 4, 7], [1, 3], [7]):
        own, merged = df.where(F.col("part").isin(parts)), incremental.merged_moments(state.where(F.col("part").isin(parts)))
        x = np.array([[np.nan if v is None else v for v in r[2:]] for r in rows if r[1] in parts], float)
        got = {r.feature: r for r in incremental.describe_merged(merged, None).collect()}
        want = {r.feature: r for r in stats.describe(own, F4).collect()}
        for c, f in enumerate(F4):
            v = x[:, c][~np.isnan(x[:, c])]
            assert got[f].n == len(v) == want[f].n
            if len(v) > 1:
                assert got[f].stddev == pytest.approx(v.std(ddof=1), rel=1e-6)
                assert (got[f].mean, got[f].min, got[f].max) == pytest.approx((v.mean(), v.min(), v.max()), rel=1e-12)
                assert incremental.scale_merged(merged)[f][1] == pytest.approx(v.std(ddof=1), rel=1e-6)
                assert incremental.scale_merged(merged, 0)[f][1] == pytest.approx(v.std(), rel=1e-6)
        y = x[~np.isnan(x[:, :3]).any(1)]
        corr = {(r.feature_a, r.feature_b): r.corr for r in incremental.correlation_merged(merged, None).collect()}
        for a, b in itertools.product(range(3), repeat=2):  # columns without gaps
            if len(y) > 1:
                assert corr[F4[a], F4[b]] == pytest.approx(np.corrcoef(y[:, a], y[:, b])[0, 1], rel=1e-5)
    state.unpersist()


@pytest.mark.parametrize("kind", ["skewed", "tied", "constant"])
def test_sketch_quantiles_keep_their_rank_error(spark, kind):
    rng = np.random.default_rng(6)
    x = {"skewed": rng.lognormal(0, 3, 30_000), "tied": rng.integers(0, 5, 30_000).astype(float),
         "constant": np.full(30_000, 2.5)}[kind]
    df = spark.createDataFrame([(i % 7, i % 2, float(v)) for i, v in enumerate(x)], "part int, cluster int, volume double")
    sketches = incremental.merged_sketches(incremental.quantile_sketches(
        df.repartition(6), ["volume"], ["cluster", "part"]), ["cluster"])
    probs, eps = (0.01, 0.25, 0.5, 0.75, 0.99), incremental.rank_error()
    assert eps < 0.015
    for r in incremental.sketch_quantiles(sketches, probs, ["cluster"]).collect():
        own = np.sort(x[r.cluster::2])
        assert r.n == len(own)
        for i, p in enumerate(probs):
            lo, hi = np.searchsorted(own, r[f"q{i}"], "left"), np.searchsorted(own, r[f"q{i}"], "right")
            assert hi > lo  # a value of the column
            assert lo / len(own) <= p + eps and hi / len(own) >= p - eps, (kind, p)


TX = "id long, line int, week int, product_id long, customer_id long"


def _tx(spark, seed=1, n=300):
    rng = random.Random(seed)
    rows = [(rng.randint(1, 40), rng.randint(1, 2), rng.randint(1, 4), rng.choice([None, 1, 2, 3]),
             rng.choice([None, 5, 6])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, TX)


def test_any_split_into_arrivals_gives_the_rows_and_the_audit(spark):
    rows, tx = _tx(spark)
    tx = quality.null_key_filter(tx).cache()
    want = sorted(map(tuple, feat.clean_transactions(tx).collect()), key=repr)
    audit = quality.duplicate_audit(tx).first()
    for split in ([lambda c: c["line"] == 1, lambda c: c["line"] == 2],
                  [lambda c: c["id"] % 3 == 2, lambda c: c["id"] % 3 == 0, lambda c: c["id"] % 3 == 1]):
        store = incremental.RowStore(spark, tempfile.mkdtemp(prefix="skumix-rows-"), tx.schema, buckets=4)
        assert store.rows().count() == 0 and tuple(store.audit().first()) == (0, 0, 0)
        for i, part in enumerate(split):
            store.add(tx.where(part({c: F.col(c) for c in tx.columns})), f"a{i}")
        store.add(tx.where(split[0]({c: F.col(c) for c in tx.columns})), "a0")  # arrives again
        store.add(tx.limit(0), "empty")
        assert sorted(map(tuple, store.rows().collect()), key=repr) == want
        assert tuple(store.audit().first()) == tuple(audit)
    store = incremental.RowStore(spark, tempfile.mkdtemp(prefix="skumix-rows-"), tx.schema)
    store.add(tx, "all")
    store.add(tx, "the same under another name")
    assert store.rows().count() == len(want) and store.audit().first().rows == 2 * tx.count()
    tx.unpersist()


def test_only_touched_buckets_are_read(spark):
    _, tx = _tx(spark)
    path = tempfile.mkdtemp(prefix="skumix-rows-")
    store = incremental.RowStore(spark, path, tx.schema, buckets=64)
    store.add(tx, "first")
    one = tx.limit(1)
    store.add(one, "second")
    assert store.rows().count() == tx.distinct().count()
    assert len(os.listdir(os.path.join(path, "rows", "_arrival=first"))) > 32


@pytest.mark.parametrize("order", [(1, 2, 3, 4), (3, 1, 4, 2, 3, 1)])
def test_weekly_state_equals_the_roll_up_in_any_order_and_twice(spark, order):
    _, tx = _tx(spark)
    want = {r.product_id: tuple(r)[1:] for r in feat.product_features(feat.clean_transactions(tx)).collect()}
    base = tempfile.mkdtemp(prefix="skumix-weeks-")
    exact, rough = incremental.FeatureStore(spark, base), incremental.FeatureStore(spark, base, exact=False)
    for week in order:
        exact.add(tx.where(F.col("week") == week))
        rough.add(tx.where(F.col("week") == week))
    assert {r.product_id: tuple(r)[1:] for r in exact.features().collect()} == want
    for r in rough.features().collect():  # few values: sketches are exact here
        assert tuple(r)[1:] == want[r.product_id]
    two = feat.product_features(feat.clean_transactions(tx.where("week IN (1, 3)")))
    assert {tuple(r) for r in exact.features([1, 3]).collect()} == {tuple(r) for r in two.collect()}


def test_an_arrival_is_compared_without_sorting_the_kept_rows(spark, monkeypatch):
    """One grouping: no join of the arrival with what is kept."""
    from pyspark.sql import DataFrame
    joins = []
    monkeypatch.setattr(DataFrame, "join", lambda *a, **k: joins.append(a) or pytest.fail("a join"))
    _, tx = _tx(spark)
    store = incremental.RowStore(spark, tempfile.mkdtemp(prefix="skumix-rows-"), tx.schema, buckets=4)
    store.add(tx.where("line = 1"), "one")
    store.add(tx, "all")
    assert store.rows().count() == tx.distinct().count() and not joins
