"""The whole segmentation run: features -> models -> names -> export.

``segment`` returns a :class:`Segmentation` whose tables are DataFrames
over the cached model input; both models score the same frame, so the
two label columns never need a join (E2)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import ALL_FEATURES, CONCENTRATION, CUSTOMERS, PRODUCT_ID, PRODUCT_NAME, VOLUME
from ..functions.columns import concentration_ratio, smoothed_concentration
from ..functions.naming import UNDEFINED
from ..operators import history, matching, profile
from ..operators.quality import drop_any_null as drop_nulls
from ..sources import csv_io
from . import models as M


@dataclass
class Segmentation:
    input: M.ModelInput
    kmeans: M.Sweep
    gmm: M.Sweep
    k: int
    gmm_k: int
    kmeans_model: object
    gmm_model: object
    kmeans_best: dict
    gmm_best: dict
    recommended: str
    scored: DataFrame
    names: DataFrame
    restart_fits: dict | None = None   # fitted initialisations (G10), once asked for

    def release(self) -> None:
        self.input.release()


def segment(features: DataFrame, ks: Iterable[int] = M.DEFAULT_K, gmm_ks: Iterable[int] = M.DEFAULT_K,
            seed: int = 42, max_iter: int = 100, parallelism: int = M.PARALLEL_FITS,
            checkpoint: bool = True, n_init: int = 1, ddof: int = 1, concentration: str | None = None,
            drop_any_null: bool = False, distinct_points: bool = False,
            rows_per_partition: int = M.ROWS_PER_PARTITION) -> Segmentation:
    """Sweeps, choice, final models and names over a feature table.

    ``n_init`` runs every fit that many times and keeps the best;
    ``ddof=0`` scales by the population standard deviation;
    ``concentration`` ("ratio", "smoothed") derives it anew from volume and
    customers; ``drop_any_null`` leaves out feature rows with any null."""
    if concentration == "smoothed":
        features = features.withColumn(CONCENTRATION, smoothed_concentration(VOLUME, CUSTOMERS))
    elif concentration == "ratio":
        features = features.withColumn(CONCENTRATION, concentration_ratio(VOLUME, CUSTOMERS))
    elif concentration is not None:
        raise ValueError(f"unknown concentration formula {concentration!r}")
    if drop_any_null:
        features = drop_nulls(features)
    mi = M.prepare_model_input(features, checkpoint=checkpoint, distinct_points=distinct_points, ddof=ddof,
                               rows_per_partition=rows_per_partition)
    km = M.kmeans_sweep(mi, ks, seed, max_iter, parallelism, n_init)
    gm = M.gmm_sweep(mi, gmm_ks, seed, max_iter, parallelism, n_init)
    kb = M.chosen_row(km, "silhouette", maximize=True)      # G8
    gb = M.chosen_row(gm, "bic", maximize=False)            # G14
    # The sweep's model for the chosen k is the final model (same
    # data split and seed give the same fit, so no refit)
    kmodel, gmodel = km.models[kb["k"]], gm.models[gb["k"]]
    scored = gmodel.transform(kmodel.transform(mi.df))
    names = (profile.segment_names(scored, label=M.KMEANS_COL)
             .withColumnRenamed(M.KMEANS_COL, "cluster"))
    return Segmentation(mi, km, gm, kb["k"], gb["k"], kmodel, gmodel, kb, gb,
                        M.recommend(kb["silhouette"], gb["silhouette"]), scored, names)


def model_comparison(seg: Segmentation) -> DataFrame:
    """One row per model with its metrics and the recommendation."""
    rows = [("K-means", seg.k, seg.kmeans_best["silhouette"], seg.kmeans_best["inertia"], None),
            ("GMM", seg.gmm_k, seg.gmm_best["silhouette"], None, seg.gmm_best["bic"])]
    df = seg.input.df.sparkSession.createDataFrame(
        rows, "model string, k int, silhouette double, inertia double, bic double")
    return df.withColumn("recommended", F.lit(seg.recommended))


def label_join(seg: Segmentation) -> DataFrame:
    """Both labels per product, from one scored frame."""
    return seg.scored.select(PRODUCT_ID, M.KMEANS_COL, M.GMM_COL)


def join_labels(first: DataFrame, second: DataFrame) -> DataFrame:
    """E2 for labels that come from different tables: one row per product
    of either, null where a table has no label for it."""
    return first.join(second, PRODUCT_ID, "full_outer").select(PRODUCT_ID, M.KMEANS_COL, M.GMM_COL)


def final_table(seg: Segmentation) -> DataFrame:
    """H6: product, features, both labels and the K-means segment name."""
    return product_table(seg.scored, seg.names)


def product_table(scored: DataFrame, names: DataFrame) -> DataFrame:
    """H6 from scored products and the names of the K-means clusters (at
    most k rows: a size-bounded broadcast)."""
    return (scored.join(F.broadcast(names.withColumnRenamed("cluster", M.KMEANS_COL)), M.KMEANS_COL, "left")
            .select(PRODUCT_ID, PRODUCT_NAME, *ALL_FEATURES, M.KMEANS_COL, M.GMM_COL,
                    F.coalesce(F.col("segment"), F.lit(UNDEFINED)).alias("segment")))


def segment_summary(seg: Segmentation) -> DataFrame:
    """H3 on the K-means labels."""
    return profile.segment_summary(seg.scored, label=M.KMEANS_COL).withColumnRenamed(M.KMEANS_COL, "cluster")


def executive_summary(seg: Segmentation) -> DataFrame:
    """H5: recommended model and both models' metrics beside the products
    per named K-means cluster (the naming stays on K-means labels)."""
    return summary_table(seg.scored, seg.names, seg.recommended, {**seg.kmeans_best, "k": seg.k},
                         {**seg.gmm_best, "k": seg.gmm_k})


def summary_table(scored: DataFrame, names: DataFrame, recommended: str, kmeans: dict, gmm: dict) -> DataFrame:
    """H5 from scored products, cluster names and the chosen rows of both sweeps."""
    sizes = scored.groupBy(M.KMEANS_COL).agg(F.count(F.lit(1)).alias("products"))

    def number(x):
        return F.lit(x).cast("double")

    return (sizes.withColumnRenamed(M.KMEANS_COL, "cluster")
            .join(F.broadcast(names), "cluster", "left")
            .select(F.lit(recommended).alias("recommended_model"),
                    F.lit(kmeans["k"]).alias("k_kmeans"), number(kmeans["silhouette"]).alias("silhouette_kmeans"),
                    number(kmeans["inertia"]).alias("inertia_kmeans"),
                    F.lit(gmm["k"]).alias("k_gmm"), number(gmm["silhouette"]).alias("silhouette_gmm"),
                    number(gmm["bic"]).alias("bic_gmm"),
                    "cluster", F.coalesce(F.col("segment"), F.lit(UNDEFINED)).alias("segment"), "products"))


def export(seg: Segmentation, path: str, fmt: str = "csv") -> DataFrame:
    """A5 + A6: write the final table, return the manifest of what was
    written (rows counted by the write itself)."""
    return csv_io.write_counted(final_table(seg), path, fmt)


def label_products(seg: Segmentation, features: DataFrame) -> DataFrame:
    """Any feature rows scaled and labelled by the run's K-means model, as
    its final table is."""
    return seg.kmeans_model.transform(M.scale_like(seg.input, features))


def fitted_transitions(seg: Segmentation, period_feats: DataFrame) -> DataFrame:
    """X2 on the fitted segments: the label of each product in period 1 and
    2 (``history.period_features``), by the run's scaling and centers."""
    return history.pivot_periods(label_products(seg, period_feats).withColumnRenamed(M.KMEANS_COL, "cluster"))


def refit_transitions(before: Segmentation, after: Segmentation, labels: int | None = None) -> DataFrame:
    """X2 between two runs (a re-clustering of a later period): the label of
    each product in either, the later run's in the earlier run's numbers."""
    moved = history.segment_transitions(before.scored, after.scored, M.KMEANS_COL)
    return matching.matched_transitions(moved, labels)
