"""Model input, K-means and GMM fits, sweeps, selection.

Fits are MLlib estimators (distributed Lloyd / EM iterations).  The
driver only loops over k and receives metrics and centers; sweeps run
several fits at once from a thread pool so their small per-iteration
jobs overlap instead of queueing."""

from __future__ import annotations

import math
import re
import sys
import threading
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import MODEL_FEATURES, PRODUCT_ID
from ..operators.assign import silhouette_squared
from ..operators.scale import assemble, complete_rows, fit_vector_scaler
from ..session import written_table

FEATURES_COL = "features_scaled"
KMEANS_COL = "cluster_kmeans"
GMM_COL = "cluster_gmm"
GMM_PROB_COL = "probability_gmm"
DEFAULT_K = tuple(range(2, 11))  # fixed value: k = 2..10
WEIGHT_COL = "weight"


@dataclass
class ModelInput:
    """Scaled product vectors, deterministically partitioned and cached."""
    df: DataFrame
    n: int
    scaler: StandardScalerModel | None
    features: tuple[str, ...]
    cached: DataFrame | None = None
    points: DataFrame | None = None   # distinct scaled points + multiplicity, cached
    n_points: int = 0
    mean: tuple[float, ...] = ()      # per-feature scaling statistics (sample std)
    std: tuple[float, ...] = ()
    scaled_by_columns: bool = False   # population std: the scaler's own std does not apply

    def release(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()
        if self.points is not None:
            self.points.unpersist()

    @property
    def weighted(self) -> bool:
        return self.points is not None

    @property
    def fit_rows(self) -> int:
        return self.n_points if self.weighted else self.n

    @property
    def fit_frame(self) -> DataFrame:
        """What the estimators train on: an uncached projection of the
        cached input (distinct points with their multiplicity in
        ``weight``, or every product).  MLlib persists its own vector RDD
        for the length of a fit only when its input is not cached;
        training on a cached frame would convert cached rows back into
        vectors in every EM/Lloyd iteration (measured: GMM k=6 at sf0.1,
        4.1 s vs 6.0 s, identical model)."""
        if self.weighted:
            return self.points.select(FEATURES_COL, WEIGHT_COL)
        return self.df.select(FEATURES_COL)


ROWS_PER_PARTITION = 1_000_000


def model_partitions(n: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    """Partitions of the model input: about ``rows_per_partition`` rows each,
    a function of the row count only, so a run repeats on any cluster."""
    return max(1, math.ceil(n / rows_per_partition))


def prepare_model_input(features: DataFrame, cols: Sequence[str] = MODEL_FEATURES,
                        rows_per_partition: int = ROWS_PER_PARTITION, checkpoint: bool = True,
                        distinct_points: bool = False, ddof: int = 1) -> ModelInput:
    """Complete rows -> written table -> fixed hash partitioning by product
    id, sorted inside partitions -> vector -> scaled -> cached.

    K-means and GMM results depend on how rows are split over partitions,
    so the split is a pure function of the data (partition count from the
    row count, rows placed by product id), never of upstream tasks.  The
    written table cuts the lineage back to the transaction scan, so a lost
    executor re-reads it instead of re-running the roll-up.

    Models train on every product.  ``distinct_points=True`` trains on the
    distinct feature points weighted by how many products share them: the
    same objective over fewer rows, but initial centers are then drawn from
    the distinct points, which can end in a worse optimum.  ``ddof`` is 1
    for the sample and 0 for the population standard deviation."""
    base = complete_rows(features, cols)
    if checkpoint:
        base = written_table(base, "model-input")
    if distinct_points:
        return _distinct_point_input(base, tuple(cols), rows_per_partition, ddof)
    counts = base.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*cols).alias("points")).first()
    n = counts["n"]
    parts = model_partitions(n, rows_per_partition)
    stable = base.repartition(parts, PRODUCT_ID).sortWithinPartitions(PRODUCT_ID)
    # one shuffle: the partitioned vectors are cached, the scaler is fit on
    # that fixed layout (its sums, hence the models, depend on it), and the
    # scaled frame is a cheap projection of the cache
    vec = assemble(stable, cols, "features").persist(StorageLevel.MEMORY_AND_DISK)
    vec.count()
    scaler = fit_vector_scaler(vec, "features", FEATURES_COL)
    mean = tuple(float(x) for x in scaler.mean.toArray())
    std = tuple(float(x) for x in scaler.std.toArray())
    if ddof == 0:
        std = tuple(x * math.sqrt((n - 1) / n) if n > 1 else 0.0 for x in std)
        scaled = _scaled_vector(vec, cols, mean, std)
    else:
        scaled = scaler.transform(vec)
    return ModelInput(scaled, n, scaler, tuple(cols), cached=vec, n_points=counts["points"],
                      mean=mean, std=std, scaled_by_columns=ddof == 0)


def _scaled_vector(df: DataFrame, cols: Sequence[str], mean, std) -> DataFrame:
    """Append ``features_scaled`` = ((x - mean) / std, 0 where std is 0)."""
    z = [F.lit(0.0) if sd == 0 else (F.col(c).cast("double") - F.lit(mu)) / F.lit(sd)
         for c, mu, sd in zip(cols, mean, std)]
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(FEATURES_COL, array_to_vector(F.array(*z)))


def scale_like(mi: ModelInput, features: DataFrame) -> DataFrame:
    """Complete feature rows with the scaled vector of ``mi``'s statistics."""
    rows = complete_rows(features, mi.features)
    if mi.scaler is None or mi.scaled_by_columns:
        return _scaled_vector(rows, mi.features, mi.mean, mi.std)
    return mi.scaler.transform(assemble(rows, mi.features, "features"))


def _distinct_point_input(base: DataFrame, cols: tuple[str, ...], rows_per_partition: int,
                          ddof: int) -> ModelInput:
    """Distinct points weighted by multiplicity, without shuffling or
    caching the product table: one grouping (map-side combined, written
    once) gives the points, which are placed deterministically and cached;
    the scaling statistics come from the weighted points in a fixed order;
    the product table is read once more, to label every product."""
    grouped = written_table(base.groupBy(*cols).agg(F.count(F.lit(1)).alias(WEIGHT_COL)), "model-points")
    n_points = grouped.count()
    pts = (grouped.repartition(model_partitions(n_points, rows_per_partition), *cols)
           .sortWithinPartitions(*cols).persist(StorageLevel.MEMORY_AND_DISK))
    w = F.col(WEIGHT_COL).cast("double")
    first = pts.agg(F.sum(w).alias("n"), *[F.sum(w * F.col(c)).alias(c) for c in cols]).first()
    n = int(first["n"])
    mean = tuple(float(first[c]) / n for c in cols)
    second = pts.agg(*[F.sum(w * (F.col(c) - F.lit(mu)) * (F.col(c) - F.lit(mu))).alias(c)
                       for c, mu in zip(cols, mean)]).first()
    std = tuple(math.sqrt(float(second[c]) / (n - ddof)) if n > 1 else 0.0 for c in cols)
    points = _scaled_vector(pts, cols, mean, std).select(*cols, FEATURES_COL, WEIGHT_COL)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    points.count()
    pts.unpersist()
    return ModelInput(_scaled_vector(base, cols, mean, std), n, None, cols, points=points,
                      n_points=n_points, mean=mean, std=std)


def _evaluator(prediction_col: str) -> ClusteringEvaluator:
    return ClusteringEvaluator(featuresCol=FEATURES_COL, predictionCol=prediction_col,
                               metricName="silhouette", distanceMeasure="squaredEuclidean")


def _silhouette(predictions: DataFrame, prediction_col: str, sizes: Iterable[int],
                weighted: bool = False, dims: int = len(MODEL_FEATURES)) -> float | None:
    """G6; null when fewer than two clusters were predicted.

    Unweighted input: MLlib's evaluator.  Distinct points: the closed form
    with multiplicities (MLlib's weighted silhouette treats a weight as
    importance, not as copies, and would differ from the per-product
    value)."""
    if sum(1 for s in sizes if s > 0) < 2:
        return None
    if weighted:
        from pyspark.ml.functions import vector_to_array
        a = vector_to_array(FEATURES_COL)
        zc = [f"_z{i}" for i in range(dims)]
        flat = predictions.select(*[a[i].alias(z) for i, z in enumerate(zc)],
                                  F.col(prediction_col).alias("_label"), F.col(WEIGHT_COL))
        value = silhouette_squared(flat, zc, "_label", decimals=None, weight=WEIGHT_COL).first()[0]
        value = float("nan") if value is None else float(value)
    else:
        value = float(_evaluator(prediction_col).evaluate(predictions))
    return None if math.isnan(value) else value


def bic(log_likelihood: float, k: int, d: int, n: int) -> float:
    """-2 log L + p ln n, p = (k-1) + k d + k d (d+1) / 2 (full
    covariances).  Spark's GMM summary has no BIC."""
    p = (k - 1) + k * d + k * d * (d + 1) // 2
    return -2.0 * log_likelihood + p * math.log(n)


def fit_kmeans(mi: ModelInput, k: int, seed: int = 42, max_iter: int = 100) -> KMeansModel:
    """G4 (+C2: labels land in ``cluster_kmeans``).

    No clustering has more centers than distinct points (the trainer fails
    on it), so k is at most their number, which the input knows."""
    est = KMeans(k=max(1, min(k, mi.n_points)), seed=seed, maxIter=max_iter,
                 featuresCol=FEATURES_COL, predictionCol=KMEANS_COL)
    if mi.weighted:
        est = est.setWeightCol(WEIGHT_COL)
    return est.fit(mi.fit_frame)


_LAPACK_READY: dict[str, set[str]] = {}   # application -> its JVMs already initialised
_LAPACK_LOCK = threading.Lock()
LAPACK_PASSES = 20   # an executor without a free core may be missed by a pass


def application_jvms(spark) -> set[str]:
    """The addresses of the block managers of driver and executors."""
    return set(spark.sparkContext._jsc.sc().getExecutorMemoryStatus().keySet().mkString(" ").split())


def first_in_jvm(spark, what: str, value: Column, tasks: int) -> DataFrame:
    """A row for each of ``tasks`` tasks: ``value``, evaluated by the first of
    them in its JVM only, and null by the others.  The turn is a system
    property, which the JVM sets and hands back in one synchronised step."""
    turn = F.reflect(F.lit("java.lang.System"), F.lit("setProperty"), F.lit(f"skumix.first.{what}"), F.lit("taken"))
    return (spark.range(0, tasks, numPartitions=tasks).select(F.coalesce(turn, F.lit("null")).alias("before"))
            .select(F.when(F.col("before") == "null", value).alias("v")))


def init_lapack(spark) -> None:
    """Initialise the pure-Java LAPACK machine constants once, before any
    concurrent GMM fit.

    MLlib's GMM eigen-decomposes covariances with F2J LAPACK when no
    native LAPACK is installed; its ``Dlamch`` marks its cached constants
    as ready before computing them, so threads that make their first call
    at the same moment can read zeros, and ``dlascl`` then loops forever.
    One call from a single thread computes them for the whole JVM (in
    local mode the executors share it).  On a cluster one task of each
    executor computes them (:func:`first_in_jvm`), in as many passes as it
    takes to reach every executor of this application, those that come
    meanwhile included; one that has come since is reached before the next
    fit.  A wrong constant fails the run with a message, where EM would
    never end."""
    app, jvms = spark.sparkContext.applicationId, application_jvms(spark)
    with _LAPACK_LOCK:
        ready = _LAPACK_READY.setdefault(app, set())
        new = jvms - ready
        if not new:
            return
        drivers, reached = int(not ready), 0  # the driver is among the first
        try:
            safe_min = float(spark.sparkContext._jvm.org.netlib.lapack.Dlamch.dlamch("S"))
        except Exception:  # native LAPACK or another build: nothing to initialise
            ready |= new
            return
        if safe_min != sys.float_info.min:
            # an earlier concurrent first use left wrong constants in this JVM;
            # EM would then spin in dlascl, so fail fast instead
            raise RuntimeError(f"LAPACK machine constants are corrupt in this JVM (safe minimum {safe_min!r}); "
                               "restart the session or install a native LAPACK")
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            tasks = max(spark.sparkContext.defaultParallelism, 4 * len(jvms))
            safe = F.reflect(F.lit("org.netlib.lapack.Dlamch"), F.lit("dlamch"), F.lit("S")).cast("double")
            for _ in range(LAPACK_PASSES):
                got = [r["v"] for r in first_in_jvm(spark, "lapack", safe, tasks).collect() if r["v"] is not None]
                if any(v != sys.float_info.min for v in got):
                    raise RuntimeError("LAPACK machine constants are corrupt in an executor JVM; install a native "
                                       "LAPACK on the executors or restart them")
                reached += len(got)
                new |= application_jvms(spark) - ready  # a late one may have answered in place of one of the first
                if reached >= len(new) - drivers:
                    break
        ready |= new


def fit_gmm(mi: ModelInput, k: int, seed: int = 42, max_iter: int = 100) -> GaussianMixtureModel:
    """G11 (+C2: labels in ``cluster_gmm``, membership in ``probability_gmm``)."""
    init_lapack(mi.df.sparkSession)
    est = GaussianMixture(k=k, seed=seed, maxIter=max_iter, featuresCol=FEATURES_COL,
                          predictionCol=GMM_COL, probabilityCol=GMM_PROB_COL)
    if mi.weighted:
        est = est.setWeightCol(WEIGHT_COL)
    return est.fit(mi.fit_frame)


PARALLEL_FITS = 9  # default of ``parallelism``: fits that run at once


def _pool_map(fn, items, parallelism: int = PARALLEL_FITS):
    """Run independent fits from a thread pool.  Each fit caches its own
    copy of the vectors: on data that fills the cluster pass 1."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


@dataclass
class Sweep:
    table: DataFrame          # one row per k
    rows: list[dict]          # the same rows on the driver (a few numbers)
    models: dict[int, object]


def _runs(ks: Iterable[int], seed: int, n_init: int) -> list[tuple[int, int]]:
    return [(k, seed + i) for k in ks for i in range(n_init)]


def kmeans_sweep(mi: ModelInput, ks: Iterable[int] = DEFAULT_K, seed: int = 42, max_iter: int = 100,
                 parallelism: int = PARALLEL_FITS, n_init: int = 1) -> Sweep:
    """G7 (+G10): inertia (training cost) and silhouette for each k, of the
    run with the least inertia among ``n_init`` seeds (ties: first seed)."""
    jobs = _runs(ks, seed, n_init)
    fits = dict(zip(jobs, _pool_map(lambda j: fit_kmeans(mi, j[0], j[1], max_iter), jobs, parallelism)))
    best = {}
    for k, sd in jobs:
        cost = float(fits[(k, sd)].summary.trainingCost)
        if k not in best or cost < best[k][0]:
            best[k] = (cost, sd)

    def row(k):
        cost, sd = best[k]
        s = fits[(k, sd)].summary
        return {"k": k, "inertia": cost, "silhouette": _silhouette(
                    s.predictions, KMEANS_COL, s.clusterSizes, mi.weighted, len(mi.features)),
                "clusters": sum(1 for x in s.clusterSizes if x > 0), "iterations": s.numIter, "seed": sd}

    rows = _pool_map(row, best, parallelism)
    table = mi.df.sparkSession.createDataFrame(
        [tuple(r.values()) for r in rows],
        "k int, inertia double, silhouette double, clusters int, iterations int, seed int")
    return Sweep(table, rows, {k: fits[(k, sd)] for k, (_, sd) in best.items()})


def gmm_sweep(mi: ModelInput, ks: Iterable[int] = DEFAULT_K, seed: int = 42, max_iter: int = 100,
              parallelism: int = PARALLEL_FITS, n_init: int = 1) -> Sweep:
    """G13 (+G10, G12): log-likelihood, BIC and silhouette for each k, of the
    run with the highest log-likelihood among ``n_init`` seeds."""
    init_lapack(mi.df.sparkSession)
    jobs = _runs(ks, seed, n_init)
    fits = dict(zip(jobs, _pool_map(lambda j: fit_gmm(mi, j[0], j[1], max_iter), jobs, parallelism)))
    best = {}
    for k, sd in jobs:
        ll = float(fits[(k, sd)].summary.logLikelihood)
        if k not in best or ll > best[k][0]:
            best[k] = (ll, sd)

    def row(k):
        ll, sd = best[k]
        s = fits[(k, sd)].summary
        return {"k": k, "log_likelihood": ll, "bic": bic(ll, k, len(mi.features), mi.n),
                "silhouette": _silhouette(s.predictions, GMM_COL, s.clusterSizes, mi.weighted,
                                          len(mi.features)),
                "clusters": sum(1 for x in s.clusterSizes if x > 0), "iterations": s.numIter, "seed": sd}

    rows = _pool_map(row, best, parallelism)
    table = mi.df.sparkSession.createDataFrame(
        [tuple(r.values()) for r in rows],
        "k int, log_likelihood double, bic double, silhouette double, clusters int, iterations int, seed int")
    return Sweep(table, rows, {k: fits[(k, sd)] for k, (_, sd) in best.items()})


def bic_table(scores: DataFrame, d: int, n) -> DataFrame:
    """G12 on given (k, log_likelihood) rows: parameters and BIC.  ``n`` is
    a number or the name of a column."""
    k = F.col("k")
    params = (k - 1) + k * d + k * (d * (d + 1) // 2)
    size = F.col(n) if isinstance(n, str) else F.lit(n)
    return scores.withColumn("parameters", params).withColumn(
        "bic", F.lit(-2.0) * F.col("log_likelihood") + F.col("parameters") * F.log(size.cast("double")))


def best_of_sweep(table: DataFrame, metric: str, maximize: bool) -> DataFrame:
    """the row with the best metric, ties -> smallest k; a null or NaN
    metric never wins over a number (Spark sorts NaN above all numbers)."""
    m = F.col(metric)
    invalid = (m.isNull() | F.isnan(m)).cast("int")
    order = m.desc() if maximize else m.asc()
    return table.orderBy(invalid.asc(), order, F.col("k").asc()).limit(1)


def chosen_row(sweep: Sweep, metric: str, maximize: bool) -> dict:
    """The row of a sweep that :func:`best_of_sweep` chooses."""
    k = best_of_sweep(sweep.table, metric, maximize).first()["k"]
    return next(r for r in sweep.rows if r["k"] == k)


def recommend(km_silhouette: float | None, gmm_silhouette: float | None) -> str:
    """K-means only if its silhouette is strictly higher; a tie goes
    to GMM; a missing score loses to a present one."""
    if km_silhouette is None and gmm_silhouette is None:
        return "GMM"
    if gmm_silhouette is None:
        return "K-means"
    if km_silhouette is None:
        return "GMM"
    return "K-means" if km_silhouette > gmm_silhouette else "GMM"


def kmeans_centers(model: KMeansModel, mi: ModelInput) -> DataFrame:
    """Centers as rows (cluster, feature, scaled, unscaled)."""
    mean, std = mi.mean, mi.std
    rows = []
    for i, c in enumerate(model.clusterCenters()):
        for j, f in enumerate(mi.features):
            rows.append((i, f, float(c[j]), float(c[j] * std[j] + mean[j])))
    return mi.df.sparkSession.createDataFrame(rows, "cluster int, feature string, scaled double, unscaled double")


def gmm_components(model: GaussianMixtureModel, mi: ModelInput) -> DataFrame:
    """(component, weight, mean per feature, scaled and unscaled)."""
    mean, std = mi.mean, mi.std
    rows = []
    for i, (w, g) in enumerate(zip(model.weights, model.gaussians)):
        mu = g.mean.toArray()
        for j, f in enumerate(mi.features):
            rows.append((i, float(w), f, float(mu[j]), float(mu[j] * std[j] + mean[j])))
    return mi.df.sparkSession.createDataFrame(
        rows, "component int, weight double, feature string, scaled double, unscaled double")


def restart_fits(mi: ModelInput, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 100,
                 parallelism: int = PARALLEL_FITS) -> dict[tuple[str, int], object]:
    """The fitted models of ``n_init`` initialisations by (model, seed)."""
    init_lapack(mi.df.sparkSession)
    jobs = [(name, fit, seed + i) for name, fit in (("K-means", fit_kmeans), ("GMM", fit_gmm)) for i in range(n_init)]
    # all 2 x n_init fits in one pool: they are independent and latency-bound
    models = _pool_map(lambda j: j[1](mi, k, j[2], max_iter), jobs, parallelism)
    return {(name, s): m for (name, _, s), m in zip(jobs, models)}


def restarts(mi: ModelInput, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 100,
             parallelism: int = PARALLEL_FITS) -> DataFrame:
    """Every run of ``n_init`` initialisations and the chosen one, for
    K-means (lowest cost) and GMM (highest log-likelihood); ties -> earliest
    seed.  The sweeps take ``n_init`` too."""
    return restart_table(mi, k, restart_fits(mi, k, n_init, seed, max_iter, parallelism))


def restart_table(mi: ModelInput, k: int, fits: dict[tuple[str, int], object]) -> DataFrame:
    runs = [(m, s, float(f.summary.trainingCost if m == "K-means" else f.summary.logLikelihood))
            for (m, s), f in fits.items()]
    best_km = min((r for r in runs if r[0] == "K-means"), key=lambda r: (r[2], r[1]))
    best_gm = min((r for r in runs if r[0] == "GMM"), key=lambda r: (-r[2], r[1]))
    rows = [(m, k, s, v, (m, s) in ((best_km[0], best_km[1]), (best_gm[0], best_gm[1]))) for m, s, v in runs]
    return mi.df.sparkSession.createDataFrame(rows, "model string, k int, seed int, score double, chosen boolean")
