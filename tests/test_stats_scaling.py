"""Statistics, histogram edge cases, scaling and the closed-form metrics."""

import math

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from skumix.operators import assign, scale, stats

FEAT = "product_id long, volume long, order_frequency long, unique_customers long, concentration double"


def test_histogram_matches_numpy(spark):
    vals = [1, 2, 2, 3, 7, 7, 7, 10, 11, 40]
    df = spark.createDataFrame([(i, v, v, v, float(v)) for i, v in enumerate(vals)], FEAT)
    h = stats.histogram(df, ("volume",), bins=50).orderBy("bin").collect()
    counts, edges = np.histogram(vals, 50)
    assert [r.n for r in h] == list(counts)
    assert abs(h[-1].bin_upper - edges[-1]) < 1e-9


def test_histogram_constant_feature(spark):
    df = spark.createDataFrame([(i, 5, 5, 5, 5.0) for i in range(4)], FEAT)
    h = stats.histogram(df, ("volume",), bins=50).orderBy("bin").collect()
    counts, edges = np.histogram([5] * 4, 50)
    assert [r.n for r in h] == list(counts)
    assert h[0].bin_lower == 4.5 and h[-1].bin_upper == 5.5


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(i, 5, i, 1, 1.0) for i in range(5)], FEAT)
    z = scale.standardise(df).collect()
    assert all(r.z_volume == 0.0 and r.z_concentration == 0.0 for r in z)
    assert abs(sum(r.z_order_frequency for r in z)) < 1e-12


def test_describe_and_median(spark):
    df = spark.createDataFrame([(i, v, v, v, float(v)) for i, v in enumerate([1, 2, 3, 10])], FEAT)
    r = {x.feature: x for x in stats.describe(df, ("volume",), median=True).collect()}["volume"]
    assert (r.n, r.mean, r.min, r.max, r.median) == (4, 4.0, 1.0, 10.0, 2.5)
    assert abs(r.stddev - np.std([1, 2, 3, 10], ddof=1)) < 1e-6


def _points(spark, pts, labels):
    rows = [(i, float(x), float(y), float(z), int(c)) for i, ((x, y, z), c) in enumerate(zip(pts, labels))]
    return spark.createDataFrame(rows, "product_id long, z_volume double, z_order_frequency double, "
                                       "z_concentration double, cluster int")


def test_silhouette_closed_form_equals_evaluator(spark):
    rng = np.random.default_rng(7)
    pts = np.vstack([rng.normal(0, 1, (40, 3)), rng.normal(4, 1, (30, 3)), rng.normal([0, 5, 0], 1, (20, 3))])
    labels = [0] * 40 + [1] * 30 + [2] * 20
    labels[0] = 2  # a misplaced point
    df = _points(spark, pts, labels)
    ours = assign.silhouette_squared(df, decimals=None).first().silhouette
    vec = VectorAssembler(inputCols=list(assign.ZCOLS), outputCol="v").transform(df)
    ref = ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(
        vec.withColumn("cluster", F.col("cluster").cast("double")))
    assert abs(ours - ref) < 1e-9


def test_silhouette_one_label_is_null(spark):
    df = _points(spark, [(0, 0, 0), (1, 1, 1), (2, 2, 2)], [0, 0, 0])
    assert assign.silhouette_squared(df).first().silhouette is None


def test_silhouette_singleton_scores_zero(spark):
    pts = [(0, 0, 0), (0.1, 0, 0), (5, 5, 5)]
    df = _points(spark, pts, [0, 0, 1])
    s = assign.silhouette_squared(df, decimals=None).first().silhouette
    a = 0.01  # mean squared distance to the other member of its cluster
    b0 = 75.0
    b1 = (4.9 ** 2 + 25 + 25)
    expected = ((1 - a / b0) + (1 - a / b1) + 0.0) / 3
    assert abs(s - expected) < 1e-9


def test_fixed_labels_ties_go_to_lowest_center(spark):
    df = _points(spark, [(-0.5, -0.5, 0), (0.5, 0.5, 0), (0, 0, 1)], [0, 0, 0]).drop("cluster")
    got = [r.cluster for r in assign.label_fixed(df).orderBy("product_id").collect()]
    # (-.5,-.5,0) is equally far from centers 0 and 1; (0,0,1) from 1 and 3
    assert got == [0, 1, 1]


def test_inertia_recomputed(spark):
    pts = [(-1, -1, 0), (0, 0, 0.5), (1, 1, 0)]
    df = assign.label_fixed(_points(spark, pts, [0, 0, 0]).drop("cluster"))
    r = assign.inertia(df).first()
    assert math.isclose(r.inertia, 0.25) and r.k == 4
