"""G5, G6 and fixed-center labels: column forms that an SQL engine can
check, built from per-cluster sufficient statistics (no pairs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import MODEL_FEATURES
from ..functions.distance import nearest_center, squared_distance
from .scale import zname

# Reference centers in scaled (volume, frequency,
# concentration) space, used to give deterministic labels for checks.
FIXED_CENTERS = (
    (-1.0, -1.0, 0.0),
    (0.0, 0.0, 0.0),
    (1.0, 1.0, 0.0),
    (0.0, 0.0, 2.0),
)

ZCOLS = tuple(zname(c) for c in MODEL_FEATURES)


def label_fixed(df: DataFrame, centers: Sequence[Sequence[float]] = FIXED_CENTERS,
                zcols: Sequence[str] = ZCOLS, label: str = "cluster") -> DataFrame:
    """Nearest-center label, computed row by row from literal centers."""
    return df.withColumn(label, nearest_center([F.col(c) for c in zcols], centers))


def inertia(df: DataFrame, centers: Sequence[Sequence[float]] = FIXED_CENTERS,
            zcols: Sequence[str] = ZCOLS, label: str = "cluster", decimals: int = 6) -> DataFrame:
    """Within-cluster sum of squared distances to the given centers."""
    cols = [F.col(c) for c in zcols]
    dists = F.array(*[squared_distance(cols, c) for c in centers])
    own = F.sum(F.element_at(dists, F.col(label) + 1))
    if decimals is not None:
        own = F.round(own, decimals)
    return df.agg(F.lit(len(centers)).alias("k"), own.alias("inertia"))


def silhouette_squared(df: DataFrame, zcols: Sequence[str] = ZCOLS, label: str = "cluster",
                       decimals: int | None = 6, weight: str | None = None) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, as MLlib's
    ClusteringEvaluator defines it, in closed form.

    Per cluster c: N_c, Y_c = sum x, Psi_c = sum |x|^2.  The mean squared
    distance of x to c is |x|^2 + Psi_c/N_c - 2 x.Y_c/N_c; for its own
    cluster it is scaled by N_c/(N_c - 1); a singleton scores 0.  The k
    cluster rows are folded into one array (bounded by k) and attached
    to every point as a scalar subquery, then all work is a projection
    plus one global average.  Null when fewer than two clusters.

    ``weight`` is a multiplicity: a row standing for w identical points
    gives exactly the silhouette of the table with each row repeated w
    times (cluster sizes and sums count copies; a point's own-cluster
    mean excludes only itself), so models fitted on distinct points are
    scored as if on every product."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    sq = None
    for c in zcols:
        t = F.col(c) * F.col(c)
        sq = t if sq is None else sq + t
    stats = df.groupBy(label).agg(
        F.sum(w).alias("n"),
        *[F.sum(w * F.col(c)).alias(f"y{i}") for i, c in enumerate(zcols)],
        F.sum(w * sq).alias("psi"),
    )
    arr = stats.agg(F.collect_list(F.struct(F.col(label).alias("c"), "n", "psi",
                                            *[f"y{i}" for i in range(len(zcols))])).alias("a")).scalar()

    def dist(s):
        dot = None
        for i, c in enumerate(zcols):
            t = F.col(c) * s[f"y{i}"]
            dot = t if dot is None else dot + t
        return F.col("_sq") + s["psi"] / s["n"] - F.lit(2.0) * dot / s["n"]

    # the stats array becomes a column first: higher-order functions may
    # not contain a subquery themselves
    pts = df.select(F.col(label).alias("_c"), *zcols, sq.alias("_sq"), w.alias("_w"), arr.alias("_stats"))
    pts = pts.withColumn("_d", F.transform("_stats", lambda s: F.struct(s["c"].alias("c"), s["n"].alias("n"),
                                                                       dist(s).alias("d"))))
    pts = pts.select(
        "_stats", "_w",
        F.filter(F.col("_d"), lambda s: s["c"] == F.col("_c"))[0].alias("_own"),
        F.array_min(F.transform(F.filter(F.col("_d"), lambda s: s["c"] != F.col("_c")),
                                lambda s: s["d"])).alias("_other"))
    own, other = F.col("_own"), F.col("_other")
    a = own["d"] * own["n"] / (own["n"] - F.lit(1.0))
    s = (F.when(own["n"] == 1, F.lit(0.0))
         .when(a < other, F.lit(1.0) - a / other)
         .when(a > other, other / a - F.lit(1.0))
         .otherwise(F.lit(0.0)))
    res = pts.agg((F.sum(F.col("_w") * s) / F.sum("_w")).alias("silhouette"),
                  F.max(F.size("_stats")).alias("_k"))
    sil = F.when(F.col("_k") >= 2, F.col("silhouette"))
    if decimals is not None:
        sil = F.round(sil, decimals)
    return res.select(sil.alias("silhouette"))


def lloyd_step(labelled: DataFrame, zcols: Sequence[str] = ZCOLS, label: str = "cluster",
               decimals: int | None = 6) -> DataFrame:
    """One K-means update from given labels: each new center is the mean
    of its members, as rows (cluster, feature, center, members).  One
    grouped aggregate; the iteration MLlib repeats inside a fit."""
    g = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("members"),
                                    *[F.avg(c).alias(c) for c in zcols])
    rows = g.select(label, "members", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("center")) for c in zcols])).alias("r"))
    center = F.col("r.center")
    if decimals is not None:
        center = F.round(center, decimals) + F.lit(0.0)
    return rows.select(label, F.col("r.feature").alias("feature"), center.alias("center"), "members")
