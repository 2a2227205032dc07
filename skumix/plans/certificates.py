"""Certificates of fitted models.

A fit's numbers depend on how rows are dealt to tasks, so no other engine
can repeat them.  What makes them right can be checked by anyone: a K-means
label is the nearest center, a center the mean of its members; a mixture's
likelihood, memberships and weights follow from its parameters, and one more
step of the algorithm gains next to nothing.  Every statement is recomputed
here from the products and the model's parameters in plain column
expressions, one or two scans per model; only sums by cluster reach the
driver."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.distance import squared_distance
from ..operators.assign import silhouette_squared
from . import models as M

CENTER_TOL = 1e-4      # fixed value: a fit stops when no center moves farther
LIKELIHOOD_TOL = 0.01  # fixed value: or when the log-likelihood gains less
CLOSE = 1e-6           # relative difference of two sums in different order
SINGULAR = 1e-9        # least spread of a covariance, of its greatest, that counts as regular
LOOSE = 1e-2           # membership difference allowed where a covariance is singular
FLOOR = 2.0 ** -52     # fixed value: added to every point's density by the trainer


def _points(mi: M.ModelInput, scored: DataFrame, label: str, *more: Column) -> tuple[DataFrame, list[Column]]:
    d = len(mi.features)
    a = vector_to_array(M.FEATURES_COL)
    return (scored.select(F.col(label).alias("_label"), *[a[j].alias(f"_x{j}") for j in range(d)],
                          *[F.col(f).cast("double").alias(f"_raw{j}") for j, f in enumerate(mi.features)], *more),
            [F.col(f"_x{j}") for j in range(d)])


@dataclass
class KMeansFit:
    """What a fitted K-means claims; tests change one claim at a time."""
    centers: list
    cost: float
    sizes: list[int]
    iterations: int
    max_iter: int
    transform: object

    @classmethod
    def of(cls, model, max_iter: int = 100) -> KMeansFit:
        s = model.summary
        return cls([list(map(float, c)) for c in model.clusterCenters()], float(s.trainingCost),
                   list(s.clusterSizes), s.numIter, max_iter, model.transform)


def certify_kmeans(mi: M.ModelInput, fit: KMeansFit) -> dict:
    """One grouped scan.  ``nearest``: no label has a nearer center;
    ``centers_are_means``: a further step moves no center much (or the fit
    ran out of iterations); ``inertia_matches``: the training cost, taken
    before the last move, is the recomputed one or just above; ``residual``:
    the farthest move of that further step."""
    pts, x = _points(mi, fit.transform(mi.df), M.KMEANS_COL)
    d = F.array(*[squared_distance(x, c) for c in fit.centers])
    own, least = F.element_at("_d", F.col("_label") + 1), F.array_min("_d")
    got = (pts.withColumn("_d", d).groupBy("_label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(own).alias("inertia"),
        F.sum((own > least * (1 + CLOSE) + CLOSE).cast("int")).alias("farther"),
        *[F.avg(c).alias(f"m{j}") for j, c in enumerate(x)],
        *[F.avg(f"_raw{j}").alias(f"r{j}") for j in range(len(x))]).collect())
    dims = range(len(x))
    move = lambda r: math.dist([r[f"m{j}"] for j in dims], fit.centers[r["_label"]])
    residual = max(map(move, got), default=0.0)
    inertia = math.fsum(r["inertia"] for r in got)
    sizes = {r["_label"]: r["n"] for r in got}
    # centers of raw values: those of the members' means, within the move
    unscaled = all(abs(r[f"r{j}"] - (fit.centers[r["_label"]][j] * mi.std[j] + mi.mean[j]))
                   <= (move(r) + CLOSE) * max(mi.std[j], CLOSE) + CLOSE * abs(r[f"r{j}"]) for r in got for j in dims)
    return {"products": sum(sizes.values()), "clusters": len(fit.centers),
            "nearest": sum(r["farther"] for r in got) == 0,
            "centers_are_means": fit.iterations >= fit.max_iter or residual <= 10 * CENTER_TOL,
            "inertia_matches": inertia * (1 - CLOSE) <= fit.cost <= inertia * (1 + 1e-3) + CLOSE,
            "sizes_match": mi.weighted or [sizes.get(i, 0) for i in range(len(fit.sizes))] == fit.sizes,
            "unscaled_matches": unscaled, "residual": residual, "inertia": inertia}


@dataclass
class MixtureFit:
    """What a fitted Gaussian mixture claims."""
    weights: list[float]
    means: list
    covariances: list
    log_likelihood: float
    sizes: list[int]
    iterations: int
    max_iter: int
    transform: object

    @classmethod
    def of(cls, model, max_iter: int = 100) -> MixtureFit:
        s = model.summary
        return cls(list(map(float, model.weights)), [g.mean.toArray().tolist() for g in model.gaussians],
                   [g.cov.toArray().tolist() for g in model.gaussians], float(s.logLikelihood),
                   list(s.clusterSizes), s.numIter, max_iter, model.transform)


def whitening(cov) -> tuple[list, float]:
    """(A, u) with density exp(u - |A (x - mean)|^2 / 2): A is the inverse of
    the Cholesky factor; of a singular covariance the directions without
    spread are left out, as the trainer does."""
    import numpy as np
    cov = np.array(cov, float)
    d = len(cov)
    values, vectors = np.linalg.eigh(cov)
    least = 2.0 ** -52 * d * max(values.max(), 0.0)
    if values.min() > least:
        a = np.linalg.inv(np.linalg.cholesky(cov))
        spread = -2 * float(np.log(np.diag(a)).sum())
    else:
        kept = values > least
        a = (vectors[:, kept] / np.sqrt(values[kept])).T
        spread = float(np.log(values[kept]).sum())
    return a.tolist(), -0.5 * (d * math.log(2 * math.pi) + spread)


def regular(fit: MixtureFit) -> bool:
    """Whether every component spreads in all directions.  Without that the
    likelihood has no bound and the trainer's steps (on fewer directions)
    need not raise it; products that lie on a line or plane lead there."""
    import numpy as np
    values = [np.linalg.eigvalsh(np.array(c, float)) for c in fit.covariances]
    return all(v.min() > SINGULAR * max(v.max(), 0.0) for v in values)


def _densities(x: Sequence[Column], fit: MixtureFit) -> Column:
    """Floor + weight x density of each component, as an array."""
    out = []
    for w, mean, cov in zip(fit.weights, fit.means, fit.covariances):
        a, u = whitening(cov)
        quad = F.lit(0.0)
        for row in a:
            y = F.lit(0.0)
            for c, mu, v in zip(x, mean, row):
                y = y + (c - F.lit(mu)) * F.lit(v)
            quad = quad + y * y
        out.append(F.lit(FLOOR) + F.lit(w) * F.exp(F.lit(u) - quad * 0.5))
    return F.array(*out)


def _expectation(pts: DataFrame, x: Sequence[Column], fit: MixtureFit) -> DataFrame:
    """Points with ``_p`` (densities) and ``_t`` (their sum)."""
    return pts.withColumn("_p", _densities(x, fit)).withColumn(
        "_t", F.aggregate("_p", F.lit(0.0), lambda acc, v: acc + v))


def _next_step(pts: DataFrame, x: Sequence[Column], fit: MixtureFit):
    """(row of sums, the parameters after one more step)."""
    import numpy as np
    k, d = len(fit.weights), len(x)
    r = [F.col("_p")[i] / F.col("_t") for i in range(k)]
    given = F.col("_given")
    apart = F.greatest(*[F.abs(r[i] - given[i]) for i in range(k)], F.lit(0.0))
    sums = [F.sum(r[i]).alias(f"n{i}") for i in range(k)]
    sums += [F.sum(r[i] * x[a]).alias(f"s{i}_{a}") for i in range(k) for a in range(d)]
    sums += [F.sum(r[i] * x[a] * x[b]).alias(f"q{i}_{a}_{b}") for i in range(k) for a in range(d) for b in range(a, d)]
    got = _expectation(pts, x, fit).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.log("_t")).alias("likelihood"), F.max(apart).alias("apart"),
        F.sum((F.element_at(given, F.col("_label") + 1) < F.array_max(given)).cast("int")).alias("unlikely"),
        *[F.sum((F.col("_label") == i).cast("int")).alias(f"size{i}") for i in range(k)], *sums).first()
    weights, means, covs = [], [], []
    total = math.fsum(got[f"n{i}"] for i in range(k))
    for i in range(k):
        n = got[f"n{i}"]
        mean = np.array([got[f"s{i}_{a}"] / n for a in range(d)])
        square = np.array([[got[f"q{i}_{min(a, b)}_{max(a, b)}"] / n for b in range(d)] for a in range(d)])
        weights.append(n / total)
        means.append(mean.tolist())
        covs.append((square - np.outer(mean, mean)).tolist())
    return got, replace(fit, weights=weights, means=means, covariances=covs)


def certify_mixture(mi: M.ModelInput, fit: MixtureFit, bic: float | None = None) -> dict:
    """Two scans.  ``memberships_match``: every product's probabilities are
    the recomputed ones (closely if the mixture is regular, else to
    ``LOOSE``); ``labels_match``: its label is its likeliest component;
    ``likelihood_rises``: the final parameters' likelihood is the reported
    one (taken before the last step) or above; ``step_gains``: one more
    step does not lose; ``settled``: nor does it gain much, unless the fit
    ran out of iterations.  These three are claims on regular mixtures only
    (:func:`regular`), where the algorithm guarantees them.
    ``bic_matches``: of the given BIC."""
    pts, x = _points(mi, fit.transform(mi.df), M.GMM_COL, vector_to_array(M.GMM_PROB_COL).alias("_given"))
    got, after = _next_step(pts, x, fit)
    n, now, sound = got["n"], got["likelihood"], regular(fit)
    then = _expectation(pts, x, after).agg(F.sum(F.log("_t")).alias("l")).first()["l"]
    slack = CLOSE * (abs(now) + n)
    k, d = len(fit.weights), len(x)
    free = (k - 1) + k * d + k * d * (d + 1) // 2
    goes_on = sound and regular(after)
    return {"products": n, "components": k,
            "memberships_match": got["apart"] <= (CLOSE if sound else LOOSE),
            "labels_match": got["unlikely"] == 0,
            "likelihood_rises": not sound or now >= fit.log_likelihood - slack,
            "step_gains": not goes_on or then >= now - slack,
            "settled": not goes_on or fit.iterations >= fit.max_iter or (
                now - fit.log_likelihood <= 2 * LIKELIHOOD_TOL + slack and then - now <= 2 * LIKELIHOOD_TOL + slack),
            "sizes_match": mi.weighted or [got[f"size{i}"] for i in range(k)] == fit.sizes[:k],
            "weights_sum_to_one": abs(math.fsum(fit.weights) - 1) <= CLOSE,
            "bic_matches": bic is None or abs(bic - (free * math.log(n) - 2 * fit.log_likelihood)) <= CLOSE * abs(bic),
            "log_likelihood": now, "regular": sound}


KMEANS_CLAIMS = ("products", "clusters", "nearest", "centers_are_means", "inertia_matches", "sizes_match",
                 "unscaled_matches")
MIXTURE_CLAIMS = ("products", "components", "memberships_match", "labels_match", "likelihood_rises", "step_gains",
                  "settled", "sizes_match", "weights_sum_to_one", "bic_matches")


def _table(spark, rows: list[dict]) -> DataFrame:
    kinds = {bool: "boolean", int: "long", str: "string"}
    schema = ", ".join(f"{c} {kinds[type(v)]}" for c, v in rows[0].items())
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def kmeans_certificates(mi: M.ModelInput, fits: dict, max_iter: int = 100,
                        parallelism: int = M.PARALLEL_FITS) -> DataFrame:
    """A row for each (k, seed) of ``fits`` (fitted models)."""
    def row(key):
        got = certify_kmeans(mi, KMeansFit.of(fits[key], max_iter))
        return {"k": key[0], "seed": key[1], **{c: got[c] for c in KMEANS_CLAIMS}}

    return _table(mi.df.sparkSession, M._pool_map(row, list(fits), parallelism))


def mixture_certificates(mi: M.ModelInput, fits: dict, bics: dict | None = None, max_iter: int = 100,
                         parallelism: int = M.PARALLEL_FITS) -> DataFrame:
    """A row for each (k, seed) of ``fits``; ``bics``: k -> BIC to check."""
    def row(key):
        got = certify_mixture(mi, MixtureFit.of(fits[key], max_iter), (bics or {}).get(key[0]))
        return {"k": key[0], "seed": key[1], **{c: got[c] for c in MIXTURE_CLAIMS}}

    return _table(mi.df.sparkSession, M._pool_map(row, list(fits), parallelism))


def _chosen(rows: list[dict], metric: str, sign: int) -> int:
    """k of the best present metric, the smallest on ties."""
    present = [r for r in rows if r[metric] is not None]
    return min(present or rows, key=lambda r: (-sign * (r[metric] or 0.0), r["k"]))["k"]


def choice_certificate(mi: M.ModelInput, sweep: M.Sweep, chosen: int, metric: str, maximize: bool, label: str,
                       parallelism: int = M.PARALLEL_FITS) -> DataFrame:
    """For every k of a sweep, whether its silhouette is that of its
    labels, and whether the choice is the best row of the sweep."""
    def row(r):
        model = sweep.models[r["k"]]
        pts, _ = _points(mi, model.transform(mi.df), label)
        cols = [f"_x{j}" for j in range(len(mi.features))]
        value = silhouette_squared(pts, cols, "_label", decimals=None).first()[0]
        same = (value is None) == (r["silhouette"] is None) and (
            value is None or abs(value - r["silhouette"]) <= CLOSE)
        return {"k": r["k"], "silhouette_matches": same,
                "choice_is_best": chosen == _chosen(sweep.rows, metric, 1 if maximize else -1)}

    return _table(mi.df.sparkSession, M._pool_map(row, sweep.rows, parallelism))
