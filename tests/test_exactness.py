"""Quantiles without a one-task map, CSV round trips, row identity, bins."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skumix.operators import features as feat
from skumix.operators import profile, quality, stats
from skumix.operators.quantiles import exact_quantiles
from skumix.sources import csv_io, tables

LAB = ("product_id long, product_name string, volume long, order_frequency long, unique_customers long, "
       "concentration double, cluster int")


def _rows(n=900):
    rng = random.Random(3)
    # a third of all rows in cluster 0
    return [(i, f"p{i}", rng.randint(1, 400), rng.randint(1, 9), 1 + i % 7, rng.random() / 100, 0 if i % 3 == 0 else 1 + i % 5)
            for i in range(n)]


def test_quantiles_equal_numpy_with_a_hot_group(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, LAB).repartition(5)
    cols, probs = ("volume", "concentration"), (0.0, 0.25, 0.5, 0.77, 1.0)
    got = {(r.cluster, r.feature): r for r in exact_quantiles(df, cols, probs, by=["cluster"]).collect()}
    for c in {r[6] for r in rows}:
        for f, at in (("volume", 2), ("concentration", 5)):
            x = [r[at] for r in rows if r[6] == c]
            r = got[(c, f)]
            assert r.n == len(x)
            assert [r[f"q{i}"] for i in range(len(probs))] == pytest.approx(np.quantile(x, probs).tolist())
    empty = exact_quantiles(df.limit(0), cols, probs)
    assert empty.count() == 0


def test_no_percentile_aggregate_in_the_plans(spark):
    df = spark.createDataFrame(_rows(60), LAB)
    for q in (stats.describe(df, median=True), profile.boxplot_table(df), profile.segment_names(df),
              profile.cluster_vs_medians(df), profile.segment_summary(df)):
        plan = q._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "percentile" not in plan and "median(" not in plan


def test_profile_of_an_unrounded_ratio(spark):
    rows = [(1, "a", 1, 1, 1, 0.004, 0), (2, "b", 1, 1, 1, 0.004, 0)]
    p = profile.cluster_profile(spark.createDataFrame(rows, LAB)).first()
    assert p.mean_concentration == pytest.approx(0.004) and p.min_concentration == 0.004


def test_csv_survives_awkward_names(spark, tmp_path):
    names = ["line\nbreak", 'a "quoted" name', "commas, and, more", "  outer blanks  ", "\r\nboth", "back\\slash", '"']
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    manifest = csv_io.write_counted(df, str(tmp_path / "x")).collect()
    assert {r.n_rows for r in manifest} == {len(names)} and [r.column_name for r in manifest] == ["id", "name"]
    back = csv_io.read_csv(spark, str(tmp_path / "x"), schema="id int, name string", multi_line=True)
    assert {r.id: r.name.replace("\r\n", "\n") for r in back.collect()} == {
        i: n.replace("\r\n", "\n") for i, n in enumerate(names)}
    again = csv_io.write_manifest(spark, str(tmp_path / "x"), schema="id int, name string")
    assert {r.n_rows for r in again.collect()} == {len(names)}


def test_two_times_on_one_day_stay_two_rows(spark):
    t = dt.datetime(2024, 3, 4, 9)
    rows = [(1, 7, 3, t), (1, 7, 3, t), (1, 7, 3, t + dt.timedelta(hours=2))]
    df = spark.createDataFrame(rows, "id long, product long, buyer long, at timestamp")
    bound = tables.bind_roles(df, {"id": "id", "product_id": "product", "customer_id": "buyer", "date": "at"},
                              keep_others=True)
    clean = feat.clean_transactions(bound)
    assert clean.count() == 2 and clean.select("date").distinct().count() == 1
    assert quality.duplicate_audit(bound).first().asDict() == {"rows": 3, "distinct_rows": 2, "removed": 1}
    assert quality.with_copies(bound).agg(F.sum("_copies")).first()[0] == 3


def test_binned_counts_sum_to_all_products(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, LAB)
    names = spark.createDataFrame([(i, "x") for i in range(6)], "cluster int, segment string")
    for t, n in ((stats.scatter_pairs(df, bins=4), "n"),
                 (profile.labelled_scatter_2d(df, names, bins=4), "products")):
        per_pair = {r[0]: r[1] for r in t.groupBy("pair").agg(F.sum(n)).collect()}
        assert set(per_pair.values()) == {len(rows)}
    t = profile.labelled_scatter_3d(df, names, bins=3)
    assert t.agg(F.sum("products")).first()[0] == len(rows)
    assert t.groupBy("volume", "order_frequency", "concentration").count().count() <= 27
