"""Certificates of fits, the sampled silhouette, and matching of two fits."""

import itertools
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from skumix.operators import assign, history, matching, silhouette
from skumix.plans import certificates as C
from skumix.plans import models as M


def _features(spark, n, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = i % 3
        rows.append((i, f"p{i}", *[int(abs(rng.gauss(10 + 20 * ((k + j) % 3), 4))) + 1 for j in range(3)],
                     round(abs(rng.gauss(3 + 2 * k, 0.7)), 2)))
    return spark.createDataFrame(rows, "product_id long, product_name string, volume long, order_frequency long, "
                                       "unique_customers long, concentration double")


@pytest.fixture(scope="module")
def fitted(spark):
    mi = M.prepare_model_input(_features(spark, 300))
    yield mi, M.fit_kmeans(mi, 3), M.fit_gmm(mi, 3)
    mi.release()


def _claims(row, names):
    return {c: row[c] for c in names if isinstance(row[c], bool)}


def test_kmeans_certificate_holds_and_sees_every_injected_fault(fitted):
    mi, km, _ = fitted
    fit = C.KMeansFit.of(km)
    assert all(_claims(C.certify_kmeans(mi, fit), C.KMEANS_CLAIMS).values())
    assert C.certify_kmeans(mi, fit)["residual"] <= 1e-3
    moved = replace(fit, centers=[[x + (0.4 if i == 0 else 0) for x in c] for i, c in enumerate(fit.centers)])
    got = C.certify_kmeans(mi, moved)
    assert not got["centers_are_means"] and not got["inertia_matches"]
    swapped = replace(fit, centers=fit.centers[::-1])
    assert not C.certify_kmeans(mi, swapped)["nearest"]
    assert not C.certify_kmeans(mi, replace(fit, cost=fit.cost * 0.9))["inertia_matches"]
    assert not C.certify_kmeans(mi, replace(fit, sizes=fit.sizes[::-1][:2] + [0]))["sizes_match"]
    lazy = lambda df: fit.transform(df).withColumn(M.KMEANS_COL, F.lit(0))
    assert not C.certify_kmeans(mi, replace(fit, transform=lazy))["nearest"]


def test_mixture_certificate_holds_and_sees_every_injected_fault(fitted):
    mi, _, gm = fitted
    fit = C.MixtureFit.of(gm)
    bic = M.bic(fit.log_likelihood, 3, 3, mi.n)
    got = C.certify_mixture(mi, fit, bic)
    assert got["regular"] and all(_claims(got, C.MIXTURE_CLAIMS).values())
    assert got["log_likelihood"] == pytest.approx(fit.log_likelihood, abs=0.05)
    wide = replace(fit, covariances=[(np.array(c) * (4 if i == 1 else 1)).tolist() for i, c in enumerate(fit.covariances)])
    wrong = C.certify_mixture(mi, wide, bic)
    assert not wrong["memberships_match"] and not wrong["likelihood_rises"]
    assert not C.certify_mixture(mi, replace(fit, means=fit.means[::-1]))["memberships_match"]
    assert not C.certify_mixture(mi, replace(fit, weights=[0.2, 0.2, 0.2]))["weights_sum_to_one"]
    assert not C.certify_mixture(mi, replace(fit, sizes=[1, 1, 1]))["sizes_match"]
    assert not C.certify_mixture(mi, fit, bic + 1)["bic_matches"]
    early = C.MixtureFit.of(M.fit_gmm(mi, 3, max_iter=2), max_iter=100)  # claims to have settled
    assert not C.certify_mixture(mi, early)["settled"]


def test_choice_certificate_sees_a_wrong_choice(fitted):
    mi, _, _ = fitted
    sweep = M.kmeans_sweep(mi, (2, 3, 4))
    best = M.chosen_row(sweep, "silhouette", True)["k"]
    good = C.choice_certificate(mi, sweep, best, "silhouette", True, M.KMEANS_COL).collect()
    assert all(r.silhouette_matches and r.choice_is_best for r in good)
    other = next(k for k in (2, 3, 4) if k != best)
    assert not any(r.choice_is_best for r in C.choice_certificate(
        mi, sweep, other, "silhouette", True, M.KMEANS_COL).collect())


# ---- sampled silhouette ----------------------------------------------------------

def _brute(points, labels):
    x, out = np.array(points), []
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[labels == c].mean() for c in set(labels.tolist()) if c != labels[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 4, 600)
    labels[5] = 9  # alone
    x = rng.normal(size=(600, 3)) + labels[:, None] * 0.8
    rows = [(i, int(c), *map(float, p)) for i, (c, p) in enumerate(zip(labels, x))]
    return spark.createDataFrame(rows, "product_id long, cluster int, a double, b double, c double").repartition(5), x, labels


def test_silhouette_of_a_sample_as_large_as_the_table_is_exact(labelled):
    df, x, labels = labelled
    got = silhouette.silhouette_sampled(df, ("a", "b", "c"), sample=600, decimals=None).first()
    assert got.silhouette == pytest.approx(_brute(x, labels).mean(), abs=1e-12)
    assert got.standard_error == 0 and got.sampled == got.points == 600


def test_error_bound_of_sampled_silhouettes_holds(labelled):
    df, x, labels = labelled
    df = df.coalesce(1).cache()
    exact, far = _brute(x, labels).mean(), 0
    for seed in range(20):
        got = silhouette.silhouette_sampled(df, ("a", "b", "c"), sample=100, seed=seed, decimals=None).first()
        far += abs(got.silhouette - exact) > 2 * got.standard_error
    assert far <= 3  # one in twenty is expected


def test_silhouette_of_one_cluster_nulls_and_nothing(spark, labelled):
    df, _, _ = labelled
    one = silhouette.silhouette_sampled(df.withColumn("cluster", F.lit(1)), ("a", "b", "c"), sample=50).first()
    assert one.silhouette is None and one.standard_error is None and one.points == 600
    gaps = df.withColumn("a", F.when(F.col("product_id") % 2 == 0, F.col("a")))
    assert silhouette.silhouette_sampled(gaps, ("a", "b", "c"), sample=50).first().points == 300
    assert silhouette.silhouette_sampled(df.limit(0), ("a", "b", "c")).first().sampled == 0
    with pytest.raises(ValueError):
        silhouette.silhouette_sampled(df, ("a", "b", "c"), sample=silhouette.MAX_SAMPLE + 1)


# ---- matching of two fits -----------------------------------------------------------

def test_assignment_equals_trying_every_permutation():
    rng = random.Random(5)
    for _ in range(200):
        k = rng.randint(1, 5)
        gain = [[rng.randint(0, 4) for _ in range(k)] for _ in range(k)]
        best = min(itertools.permutations(range(k)), key=lambda p: (-sum(gain[i][j] for i, j in enumerate(p)), p))
        assert matching.assignment(gain) == list(best), gain
    assert matching.assignment([]) == []


def test_a_permuted_labelling_gives_no_alerts(spark):
    rows = [(i, i % 5, [3, 0, 4, 1, 2][i % 5]) for i in range(100)]
    t = spark.createDataFrame(rows, "product_id long, cluster_before int, cluster_after int")
    assert history.transition_alerts(t).count() == 100
    assert history.transition_alerts(matching.matched_transitions(t)).count() == 0


def test_segments_that_end_and_begin_and_absent_products(spark):
    rows = [(1, 0, 1), (2, 0, 1), (3, 1, 1), (4, 2, 0), (5, None, 0), (6, 1, None), (7, None, 3)]
    t = spark.createDataFrame(rows, "product_id long, cluster_before int, cluster_after int")
    got = {r.product_id: (r.cluster_before, r.cluster_after) for r in matching.matched_transitions(t).collect()}
    assert got[1] == (0, 0) and got[2] == (0, 0) and got[3] == (1, 0) and got[4] == (2, 2)
    assert got[5] == (None, 2) and got[6] == (1, None)
    assert got[7][1] >= 4  # a label that no product of an old segment has: a number of its own
    assert matching.matched_transitions(t.limit(0)).count() == 0
    assert {(r.cluster_before, r.cluster_after): r.continues for r in matching.matched_overlap(t).collect()} == {
        (0, 1): True, (1, 1): False, (2, 0): True}


def test_refit_on_the_same_products_keeps_every_label(spark):
    from skumix.plans import segmentation as S
    f = _features(spark, 200)
    a = S.segment(f, ks=(3,), gmm_ks=(2,), seed=1)
    b = S.segment(f, ks=(3,), gmm_ks=(2,), seed=9)
    try:
        moved = S.refit_transitions(a, b)
        assert moved.where(F.col("cluster_before") == F.col("cluster_after")).count() >= 190
    finally:
        a.release()
        b.release()


def test_fixed_label_helper_feeds_the_sampled_silhouette(spark):
    z = spark.createDataFrame([(1, -1.0, -1.0, 0.0), (2, -1.1, -1.0, 0.0), (3, 1.0, 1.0, 0.0), (4, 1.1, 1.0, 0.0)],
                              "product_id long, z_volume double, z_order_frequency double, z_concentration double")
    assert silhouette.silhouette_sampled(assign.label_fixed(z)).first().silhouette > 0.9
