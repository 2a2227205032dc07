"""Model invariants: labels in range, sizes add up, inertia recomputed,
BIC formula, selection ties, comparison rule, tiny k, determinism."""

import math

import pytest
from pyspark.sql import functions as F

from skumix.operators import assign
from skumix.plans import models as M
from skumix.plans import segmentation as S
from skumix.plans.catalog import clean_features

SF = "/root/testdata/sf0.001"


def test_bic_formula():
    # d=3, k=2, n=100, logL=-50 -> p = 1 + 6 + 12 = 19
    assert M.bic(-50.0, 2, 3, 100) == pytest.approx(100 + 19 * math.log(100))


def test_selection_ties_smallest_k(spark):
    rows = [{"k": 2, "silhouette": 0.5}, {"k": 3, "silhouette": 0.7}, {"k": 4, "silhouette": 0.7}]
    t = spark.createDataFrame([(r["k"], r["silhouette"]) for r in rows], "k int, silhouette double")
    assert M.best_of_sweep(t, "silhouette", True).first().k == 3
    t = spark.createDataFrame([(2, 5.0), (3, 1.0), (4, 1.0)], "k int, bic double")
    assert M.best_of_sweep(t, "bic", False).first().k == 3


def test_model_tie_rule():
    assert M.recommend(0.5, 0.5) == "GMM"
    assert M.recommend(0.6, 0.5) == "K-means"
    assert M.recommend(None, 0.1) == "GMM"
    assert M.recommend(0.1, None) == "K-means"


@pytest.fixture(scope="module")
def seg(spark):
    s = S.segment(clean_features(spark, SF), ks=(2, 3, 4), gmm_ks=(2, 3), max_iter=30)
    yield s
    s.release()


def test_labels_in_range_and_sizes_add_up(seg):
    n = seg.input.n
    sizes = {r[0]: r[1] for r in seg.scored.groupBy(M.KMEANS_COL).count().collect()}
    assert sum(sizes.values()) == n
    assert all(0 <= c < seg.k for c in sizes)
    g = {r[0] for r in seg.scored.select(M.GMM_COL).distinct().collect()}
    assert all(0 <= c < seg.gmm_k for c in g)


def test_reported_inertia_equals_recomputed(seg):
    centers = [list(c) for c in seg.kmeans_model.clusterCenters()]
    from pyspark.ml.functions import vector_to_array
    a = vector_to_array(M.FEATURES_COL)
    df = seg.scored.select(a[0].alias("z_volume"), a[1].alias("z_order_frequency"),
                           a[2].alias("z_concentration"), F.col(M.KMEANS_COL).alias("cluster"))
    got = assign.inertia(df, centers, decimals=None).first().inertia
    assert got == pytest.approx(seg.kmeans_best["inertia"], rel=1e-9)


def test_sweep_choice_matches_table(seg):
    best = max(seg.kmeans.rows, key=lambda r: (r["silhouette"], -r["k"]))
    assert seg.k == best["k"]
    assert all(-1 <= r["silhouette"] <= 1 for r in seg.kmeans.rows)
    bics = {r["k"]: r["bic"] for r in seg.gmm.rows}
    assert seg.gmm_k == min(bics, key=lambda k: (bics[k], k))
    for r in seg.gmm.rows:
        assert r["bic"] == pytest.approx(M.bic(r["log_likelihood"], r["k"], 3, seg.input.n))


def test_final_table_and_summary(seg):
    ft = S.final_table(seg)
    assert ft.count() == seg.input.n
    assert ft.filter(F.col("segment").isNull()).count() == 0
    es = S.executive_summary(seg).collect()
    assert sum(r.products for r in es) == seg.input.n
    assert {r.recommended_model for r in es} == {seg.recommended}


def test_repeatable_under_upstream_partitioning(spark):
    f = clean_features(spark, SF)
    a = M.prepare_model_input(f.repartition(1))
    b = M.prepare_model_input(f.repartition(5))
    ca = M.fit_kmeans(a, 4, max_iter=20).clusterCenters()
    cb = M.fit_kmeans(b, 4, max_iter=20).clusterCenters()
    assert all((x == y).all() for x, y in zip(ca, cb))
    a.release()
    b.release()


def test_tiny_k_fewer_centers(spark):
    rows = [(1, "a", 1, 1, 1, 1.0), (2, "b", 9, 9, 1, 3.0)] * 1
    df = spark.createDataFrame(rows, "product_id long, product_name string, volume long, order_frequency long, "
                                     "unique_customers long, concentration double")
    mi = M.prepare_model_input(df, checkpoint=False)
    sw = M.kmeans_sweep(mi, ks=(2, 5), max_iter=10, parallelism=1)
    assert {r["k"] for r in sw.rows} == {2, 5}
    assert len(sw.models[5].clusterCenters()) <= 2
    mi.release()


def test_model_partitions_depend_on_rows_only():
    assert M.model_partitions(2_000) == 1
    assert M.model_partitions(20_000_000_000) == 20_000
    assert M.model_partitions(10 ** 12) == 1_000_000
    assert M.model_partitions(20_000, rows_per_partition=5_000) == 4


def test_default_sweep_is_the_per_product_sweep(spark):
    from skumix.plans.catalog import clean_features
    f = clean_features(spark, "/root/testdata/sf0.01")
    mi = M.prepare_model_input(f, checkpoint=False)
    assert not mi.weighted
    got = {r["k"]: r["inertia"] for r in M.kmeans_sweep(mi, ks=(2, 3, 5)).rows}
    for k, cost in got.items():
        one = M.KMeans(k=k, seed=42, maxIter=100, featuresCol=M.FEATURES_COL).fit(mi.df.select(M.FEATURES_COL))
        assert one.summary.trainingCost == pytest.approx(cost, rel=1e-12)
    mi.release()


def test_sweep_keeps_the_best_run_per_k(spark):
    mi = M.prepare_model_input(clean_features(spark, SF), checkpoint=False)
    many = M.kmeans_sweep(mi, ks=(3, 4), max_iter=15, n_init=3)
    for r in many.rows:
        costs = {s: M.fit_kmeans(mi, r["k"], s, 15).summary.trainingCost for s in (42, 43, 44)}
        assert r["inertia"] == min(costs.values()) and costs[r["seed"]] == r["inertia"]
        assert many.models[r["k"]].summary.trainingCost == r["inertia"]
    g = M.gmm_sweep(mi, ks=(2,), max_iter=10, n_init=2).rows[0]
    assert g["log_likelihood"] == max(M.fit_gmm(mi, 2, s, 10).summary.logLikelihood for s in (42, 43))
    mi.release()


def test_population_scaling_reaches_the_models(spark):
    f = clean_features(spark, SF)
    a, b = M.prepare_model_input(f, checkpoint=False), M.prepare_model_input(f, checkpoint=False, ddof=0)
    for x, y in zip(a.std, b.std):
        assert y == pytest.approx(x * math.sqrt((a.n - 1) / a.n), rel=1e-12)
    from pyspark.ml.functions import vector_to_array
    z = b.df.select(vector_to_array(M.FEATURES_COL)[0].alias("z")).agg(F.stddev_pop("z")).first()[0]
    assert z == pytest.approx(1.0, rel=1e-9)
    a.release()
    b.release()


def test_second_pipeline_options(spark):
    seg = S.segment(clean_features(spark, SF), ks=(2, 3), gmm_ks=(2,), max_iter=10, ddof=0,
                    concentration="smoothed", drop_any_null=True, checkpoint=False)
    r = S.final_table(seg).first()
    assert r.concentration == pytest.approx(r.volume / (r.unique_customers + 1))
    seg.release()


def test_transitions_use_the_run_s_own_labels(seg, spark):
    """Any period's products are labelled as the final table labels them."""
    again = S.label_products(seg, clean_features(spark, SF)).select("product_id", F.col(M.KMEANS_COL).alias("c"))
    final = S.final_table(seg)
    assert final.join(again, "product_id").where(F.col(M.KMEANS_COL) != F.col("c")).count() == 0
    periods = clean_features(spark, SF).withColumn("period", F.lit(1))
    both = periods.unionByName(periods.withColumn("period", F.lit(2)))
    moves = S.fitted_transitions(seg, both)
    assert moves.where("cluster_before <> cluster_after or cluster_before is null").count() == 0
    assert moves.count() == seg.input.n


def test_nan_and_null_metrics_never_win(spark):
    rows = [(2, float("nan")), (3, 0.4), (4, None), (5, 0.4)]
    t = spark.createDataFrame(rows, "k int, silhouette double")
    assert M.best_of_sweep(t, "silhouette", True).first().k == 3
    assert M.best_of_sweep(t, "silhouette", False).first().k == 3


def test_concurrent_sweeps_repeat_exactly(spark):
    mi = M.prepare_model_input(clean_features(spark, SF), checkpoint=False)
    a = M.kmeans_sweep(mi, ks=(2, 3, 4, 5), max_iter=20)
    b = M.kmeans_sweep(mi, ks=(2, 3, 4, 5), max_iter=20, parallelism=1)
    assert [(r["k"], r["inertia"], r["silhouette"]) for r in a.rows] == \
        [(r["k"], r["inertia"], r["silhouette"]) for r in b.rows]
    g1 = M.gmm_sweep(mi, ks=(2, 3), max_iter=15)
    g2 = M.gmm_sweep(mi, ks=(2, 3), max_iter=15)
    assert [(r["k"], r["log_likelihood"]) for r in g1.rows] == [(r["k"], r["log_likelihood"]) for r in g2.rows]
    mi.release()


def test_restarts_choose_best_run_per_model(seg):
    t = M.restarts(seg.input, 3, n_init=3, max_iter=10).collect()
    assert len(t) == 6
    for model, better in (("K-means", min), ("GMM", max)):
        runs = [r for r in t if r.model == model]
        chosen = [r for r in runs if r.chosen]
        assert len(chosen) == 1
        assert chosen[0].score == better(r.score for r in runs)


def test_distinct_point_training_scores_every_product(spark):
    """Fits on weighted distinct points: the silhouette equals MLlib's
    evaluator over every product, and every product gets a label."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    seg = S.segment(clean_features(spark, SF), ks=(2, 3), gmm_ks=(2,), max_iter=20, distinct_points=True)
    mi = seg.input
    assert mi.weighted and mi.n_points < mi.n
    assert mi.points.agg(F.sum(M.WEIGHT_COL)).first()[0] == mi.n
    # silhouette of the chosen K-means model, over all products
    full = seg.kmeans_model.transform(mi.df)
    ref = ClusteringEvaluator(featuresCol=M.FEATURES_COL, predictionCol=M.KMEANS_COL).evaluate(full)
    assert seg.kmeans_best["silhouette"] == pytest.approx(ref, abs=1e-9)
    assert seg.scored.count() == mi.n
    seg.release()


def test_per_product_training_is_the_default(spark):
    mi = M.prepare_model_input(clean_features(spark, SF), checkpoint=False)
    assert not mi.weighted and mi.n_points < mi.n
    sw = M.kmeans_sweep(mi, ks=(2, 3), max_iter=10)
    assert all(-1 <= r["silhouette"] <= 1 for r in sw.rows)
    mi.release()


def test_weighted_gmm_likelihood_counts_copies(spark):
    """On a converging fixture with many duplicate points, the weighted
    fit's log-likelihood equals the one over every (repeated) row."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array
    base = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.1), (2, 2, 1.1), (20, 20, 3.0), (21, 20, 3.1), (20, 21, 3.0),
            (21, 21, 3.2)]
    rows = [(i, "p", v, f, 1, c) for i, (v, f, c) in enumerate(base * 25)]
    df = spark.createDataFrame(rows, "product_id long, product_name string, volume long, order_frequency long, "
                                     "unique_customers long, concentration double")
    mi = M.prepare_model_input(df, checkpoint=False, distinct_points=True)
    assert mi.weighted and mi.n_points == len(base) and mi.n == len(rows)
    g = M.GaussianMixture(k=2, seed=42, maxIter=500, tol=1e-10, featuresCol=M.FEATURES_COL,
                          weightCol=M.WEIGHT_COL).fit(mi.fit_frame)
    x = np.array([r[0] for r in mi.df.select(vector_to_array(M.FEATURES_COL)).collect()])
    dens = np.zeros(len(x))
    for w, gauss in zip(g.weights, g.gaussians):
        mu, cov = gauss.mean.toArray(), gauss.cov.toArray()
        diff = x - mu
        sign, logdet = np.linalg.slogdet(cov)
        q = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
        dens += w * np.exp(-0.5 * (q + logdet + x.shape[1] * np.log(2 * np.pi)))
    assert g.summary.logLikelihood == pytest.approx(float(np.sum(np.log(dens))), rel=1e-3)
    mi.release()


def test_weighted_scaling_statistics_equal_standard_scaler(spark):
    f = clean_features(spark, SF)
    weighted = M.prepare_model_input(f, checkpoint=False, distinct_points=True)
    per_row = M.prepare_model_input(f, checkpoint=False)
    assert weighted.n == per_row.n
    for a, b in zip(weighted.mean + weighted.std, per_row.mean + per_row.std):
        assert a == pytest.approx(b, rel=1e-12)
    weighted.release()
    per_row.release()


def test_one_task_of_a_jvm_takes_the_first_turn(spark):
    """LAPACK's constants are computed by one thread before others read them."""
    import uuid
    from pyspark.sql import functions as F
    from skumix.plans import models as M
    what = uuid.uuid4().hex
    rows = M.first_in_jvm(spark, what, F.lit(1.0), 16).collect()
    assert [r["v"] for r in rows if r["v"] is not None] == [1.0] and len(rows) == 16
    assert all(r["v"] is None for r in M.first_in_jvm(spark, what, F.lit(1.0), 16).collect())


def test_lapack_reaches_every_executor_of_every_application(spark, monkeypatch):
    from types import SimpleNamespace
    jvms, passes, answers = {"driver:1", "a:1", "b:1"}, [], []
    monkeypatch.setattr(M, "application_jvms", lambda s: set(jvms))
    monkeypatch.setattr(M, "_LAPACK_READY", {})

    def one_pass(s, what, value, tasks):
        passes.append(tasks)
        return SimpleNamespace(collect=lambda: [{"v": v} for v in answers.pop(0)])

    monkeypatch.setattr(M, "first_in_jvm", one_pass)
    good = 2.2250738585072014e-308

    def session(app):
        return SimpleNamespace(sparkContext=SimpleNamespace(
            applicationId=app, master="spark://host:1", defaultParallelism=2, _jvm=spark.sparkContext._jvm))

    answers[:] = [[good, None], [None, good]]  # the first pass reaches one executor of two
    M.init_lapack(session("app-1"))
    M.init_lapack(session("app-1"))
    assert len(passes) == 2
    jvms.add("c:1")  # an executor in place of a lost one
    answers[:] = [[None, good, None]]
    M.init_lapack(session("app-1"))
    assert len(passes) == 3
    answers[:] = [[good, good, good]]  # the same Python process, new executors
    M.init_lapack(session("app-2"))
    assert len(passes) == 4
    answers[:] = [[0.0, good, good]]
    with pytest.raises(RuntimeError, match="corrupt in an executor"):
        M.init_lapack(session("app-3"))


def test_lapack_counts_an_executor_that_comes_during_a_pass(spark, monkeypatch):
    """Its answer does not stand for that of an executor that was there before."""
    from types import SimpleNamespace
    good = 2.2250738585072014e-308
    jvms, answers = {"driver:1", "a:1", "b:1"}, [[good, good, None], [None, good, None]]
    monkeypatch.setattr(M, "application_jvms", lambda s: set(jvms))
    monkeypatch.setattr(M, "_LAPACK_READY", {})

    def one_pass(s, what, value, tasks):
        jvms.add("late:1")  # the first pass reaches it and one of the others
        return SimpleNamespace(collect=lambda: [{"v": v} for v in answers.pop(0)])

    monkeypatch.setattr(M, "first_in_jvm", one_pass)
    session = SimpleNamespace(sparkContext=SimpleNamespace(
        applicationId="app-1", master="spark://host:1", defaultParallelism=2, _jvm=spark.sparkContext._jvm))
    M.init_lapack(session)
    assert not answers
    M.init_lapack(session)  # all are known now: no further pass
