"""Cluster interpretation on labelled products: D10-D14, E4, E5, F1, F2,
H1-H3.  Every table is a grouped aggregate over the labels (map-side
partial aggregation, so a cluster holding a third of all products is
never gathered in one task) plus joins to k-row tables.

Medians and quartiles come from one written table of value counts per
labelling (:func:`label_counts`): pass it as ``counts`` to every function
that needs it, or each makes its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import CONCENTRATION, FREQUENCY, PRODUCT_ID, PRODUCT_NAME, VOLUME
from ..functions.columns import half_up_mean, nonneg_round, truncate_name, with_default
from ..functions.naming import UNDEFINED, segment_name
from .quantiles import pooled, quantiles_of, value_counts

PROFILE_FEATURES = (VOLUME, FREQUENCY, CONCENTRATION)


def _mean(c: str):
    """Mean computed from an exact sum: integer features sum as long,
    concentration as a decimal with ten places (exact for the two-decimal
    ratio, and wide enough for the unrounded one)."""
    x = F.col(c)
    total = F.sum(x.cast("decimal(28,10)")) if c == CONCENTRATION else F.sum(x)
    return total.cast("double") / F.count(F.lit(1))


def cluster_sizes(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """Products per cluster, by cluster id."""
    return labelled.groupBy(label).agg(F.count(F.lit(1)).alias("products")).orderBy(label)


def cluster_size_bars(labelled: DataFrame, k: int, label: str = "cluster") -> DataFrame:
    """D10 over every id 0..k-1, empty clusters as 0."""
    ids = labelled.sparkSession.range(k).select(F.col("id").cast("int").alias(label))
    sizes = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("products"))
    return (ids.join(sizes, label, "left")
            .select(label, F.coalesce("products", F.lit(0).cast("long")).alias("products"))
            .orderBy(label))


def label_counts(labelled: DataFrame, label: str = "cluster", cols: Sequence[str] = PROFILE_FEATURES) -> DataFrame:
    """Value counts by cluster and feature, written once."""
    return value_counts(labelled, cols, by=[label])


def global_medians(features: DataFrame, cols: Sequence[str] = PROFILE_FEATURES, counts: DataFrame | None = None):
    """One struct of exact medians as a scalar subquery column; attach it
    once (``withColumn``) and read its fields from that column."""
    counts = pooled(counts) if counts is not None else value_counts(features, cols)
    q = quantiles_of(counts, [0.5])  # one row per feature
    return q.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("q0"))).alias(c) for c in cols])
                 .alias("m")).scalar()


def cluster_profile(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """H1: size and mean/min/max of the three features per cluster."""
    aggs = [F.count(F.lit(1)).alias("products")]
    for c, short in ((VOLUME, "volume"), (FREQUENCY, "frequency"), (CONCENTRATION, "concentration")):
        aggs += [_mean(c).alias(f"mean_{short}"), F.min(c).alias(f"min_{short}"), F.max(c).alias(f"max_{short}")]
    return labelled.groupBy(label).agg(*aggs)


def cluster_vs_medians(labelled: DataFrame, label: str = "cluster",
                       counts: DataFrame | None = None) -> DataFrame:
    """E5: each cluster's means beside the global medians (a scalar
    subquery, not a cross join) and the strict comparisons."""
    prof = cluster_profile(labelled, label).withColumn("_med", global_medians(labelled, counts=counts))
    med = F.col("_med")
    out = prof.select(label, "mean_volume", "mean_frequency", "mean_concentration",
                      med[VOLUME].alias("median_volume"), med[FREQUENCY].alias("median_frequency"),
                      med[CONCENTRATION].alias("median_concentration"))
    return out.select(
        label,
        *[nonneg_round(c, 6).alias(c) for c in ("mean_volume", "mean_frequency", "mean_concentration",
                                                 "median_volume", "median_frequency", "median_concentration")],
        (F.col("mean_volume") > F.col("median_volume")).alias("volume_above"),
        (F.col("mean_frequency") > F.col("median_frequency")).alias("frequency_above"),
        (F.col("mean_concentration") > F.col("median_concentration")).alias("concentration_above"),
    )


def segment_names(labelled: DataFrame, label: str = "cluster",
                  counts: DataFrame | None = None) -> DataFrame:
    """H2: (cluster, segment) by the naming rule; several clusters may
    share one name."""
    prof = cluster_profile(labelled, label).withColumn("_med", global_medians(labelled, counts=counts))
    med = F.col("_med")
    return prof.select(label, segment_name(F.col("mean_volume"), F.col("mean_frequency"),
                                           F.col("mean_concentration"), med[VOLUME], med[FREQUENCY],
                                           med[CONCENTRATION]).alias("segment"))


def segment_summary(labelled: DataFrame, label: str = "cluster",
                    counts: DataFrame | None = None) -> DataFrame:
    """H3: cluster, name, size and the means rounded half-up to 1, 1 and
    2 decimals (from exact sums)."""
    g = labelled.groupBy(label).agg(
        F.count(F.lit(1)).alias("products"),
        F.sum(VOLUME).alias("_sv"), F.sum(FREQUENCY).alias("_sf"),
        F.sum(F.col(CONCENTRATION).cast("decimal(28,10)")).alias("_sc"),
        _mean(VOLUME).alias("_mv"), _mean(FREQUENCY).alias("_mf"), _mean(CONCENTRATION).alias("_mc"),
    ).withColumn("_med", global_medians(labelled, counts=counts))
    med = F.col("_med")
    name = segment_name(F.col("_mv"), F.col("_mf"), F.col("_mc"), med[VOLUME], med[FREQUENCY], med[CONCENTRATION])
    return g.select(
        label, with_default(name, UNDEFINED).alias("segment"), "products",
        half_up_mean(F.col("_sv"), F.col("products"), 1).alias("mean_volume"),
        half_up_mean(F.col("_sf"), F.col("products"), 1).alias("mean_frequency"),
        # half-up at two decimals, by exact decimal arithmetic
        (F.expr("(cast(_sc as decimal(30,10)) * 200 + products) div (2 * products)").cast("double") / 100.0)
        .alias("mean_concentration"),
    )


def names_to_products(labelled: DataFrame, names: DataFrame, label: str = "cluster") -> DataFrame:
    """Every product with its cluster's name.  ``names`` has one row
    per cluster (at most k rows), so broadcasting it is size-bounded."""
    return (labelled.select(PRODUCT_ID, label)
            .join(F.broadcast(names), label, "left")
            .select(PRODUCT_ID, label, with_default(F.col("segment"), UNDEFINED).alias("segment")))


def top_products(labelled: DataFrame, n: int = 5, label: str = "cluster") -> DataFrame:
    """F2 (+C5): n products of highest volume per cluster, ties by lowest
    product id; names cut to 50 characters.

    ``row_number() <= n`` is planned with a map-side WindowGroupLimit,
    so each task forwards at most n rows per cluster to the shuffle."""
    w = Window.partitionBy(label).orderBy(F.col(VOLUME).desc(), F.col(PRODUCT_ID).asc())
    return (labelled.select(label, PRODUCT_ID, PRODUCT_NAME, VOLUME, FREQUENCY)
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= n)
            .select(label, "rank", PRODUCT_ID, truncate_name(PRODUCT_NAME, 50).alias(PRODUCT_NAME),
                    VOLUME, FREQUENCY))


def boxplot_table(labelled: DataFrame, label: str = "cluster",
                  cols: Sequence[str] = PROFILE_FEATURES, decimals: int = 6,
                  counts: DataFrame | None = None) -> DataFrame:
    """Per cluster and feature: quartiles, whiskers (the most extreme
    data point within 1.5 IQR of the box) and the outlier count.

    Quartiles, whiskers and outliers all come from one written table of
    value counts; the quartile table has one row per (cluster, feature),
    bounded by k x 3, and is broadcast."""
    if counts is None:
        counts = label_counts(labelled, label, cols)
    q = quantiles_of(counts, (0.25, 0.5, 0.75), by=[label]).select(
        label, "feature", "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    lo = F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))
    j = counts.select(label, "feature", "x", F.col("n").alias("copies")).join(
        F.broadcast(q), [label, "feature"], "inner")
    inside = (F.col("x") >= lo) & (F.col("x") <= hi)
    w = j.groupBy(label, "feature", "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("copies"))).alias("outliers"))
    return w.select(label, "feature", "n",
                    *[nonneg_round(c, decimals).alias(c) for c in ("q1", "median", "q3",
                                                                   "whisker_low", "whisker_high")],
                    "outliers")


def _binned(df: DataFrame, by: Sequence[str], axes: Sequence[str], bins: int | None) -> DataFrame:
    """Points, or with ``bins`` the centers of equal-width bins per axis over
    each group's range, so that a plot's table has at most bins^axes rows."""
    if bins is None:
        return df
    ranges = df.groupBy(*by).agg(*[f(a).alias(f"_{n}_{a}") for a in axes for n, f in (("lo", F.min), ("hi", F.max))])
    j = df.join(ranges, list(by))
    for a in axes:
        lo, hi = F.col(f"_lo_{a}"), F.col(f"_hi_{a}")
        width = (hi - lo) / F.lit(float(bins))
        place = F.least(F.floor(F.try_divide(F.col(a) - lo, width)), F.lit(bins - 1))
        j = j.withColumn(a, F.when(hi == lo, F.col(a).cast("double")).otherwise(lo + (place + F.lit(0.5)) * width))
    return j.drop(*[f"_{n}_{a}" for a in axes for n in ("lo", "hi")])


def labelled_scatter_2d(labelled: DataFrame, names: DataFrame, label: str = "cluster",
                        pairs=((VOLUME, FREQUENCY), (FREQUENCY, CONCENTRATION)),
                        bins: int | None = None) -> DataFrame:
    """(cluster, segment, pair, x, y, products) behind the 2-D plots.
    ``bins`` bounds the table: points become bin centers per axis.
    ``names`` has one row per cluster (at most k)."""
    long = labelled.select(label, F.explode(F.array(*[
        F.struct(F.lit(f"{a}:{b}").alias("pair"), F.col(a).cast("double").alias("x"),
                 F.col(b).cast("double").alias("y")) for a, b in pairs])).alias("r")).select(label, "r.*")
    long = _binned(long, ["pair"], ["x", "y"], bins)
    g = long.groupBy(label, "pair", "x", "y").agg(F.count(F.lit(1)).alias("products"))
    return (g.join(F.broadcast(names), label, "left")
            .select(label, with_default(F.col("segment"), UNDEFINED).alias("segment"),
                    "pair", "x", "y", "products"))


def labelled_scatter_3d(labelled: DataFrame, names: DataFrame, label: str = "cluster",
                        bins: int | None = None) -> DataFrame:
    """(cluster, segment, volume, frequency, concentration, products);
    ``bins`` as in :func:`labelled_scatter_2d`."""
    axes = [VOLUME, FREQUENCY, CONCENTRATION]
    points = _binned(labelled.select(label, *axes, F.lit(1).alias("_all")), ["_all"], axes, bins)
    g = points.groupBy(label, VOLUME, FREQUENCY, CONCENTRATION).agg(F.count(F.lit(1)).alias("products"))
    return (g.join(F.broadcast(names), label, "left")
            .select(label, with_default(F.col("segment"), UNDEFINED).alias("segment"),
                    VOLUME, FREQUENCY, CONCENTRATION, "products"))
