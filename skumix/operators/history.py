"""History coverage and segment transitions between periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import MODEL_FEATURES, PRODUCT_ID
from .assign import FIXED_CENTERS, label_fixed
from .features import clean_transactions, join_master, product_features
from .scale import complete_rows, standardise

MIN_WEEKS = 12  # fixed value: weeks of history the analysis asks for


def history_coverage(tx: DataFrame, min_weeks: int = MIN_WEEKS) -> DataFrame:
    """Distinct ISO weeks present vs the required minimum."""
    return tx.agg(
        F.count_distinct("week").alias("weeks"),
        F.min("week").alias("first_week"),
        F.max("week").alias("last_week"),
    ).select("weeks", "first_week", "last_week", F.lit(min_weeks).alias("min_weeks"),
             (F.col("weeks") >= min_weeks).alias("sufficient"))


def period_features(tx: DataFrame, master: DataFrame, cut: str, concentration: str = "ratio",
                    cleaned: bool = False) -> DataFrame:
    """Feature rows per (period, product) for the two periods (date < cut
    -> 1, else 2) from ONE scan, dedup and roll-up of the transactions
    (``cleaned``: rows are distinct with known products already)."""
    periods = tx.withColumn("period", F.when(F.col("date") < F.lit(cut).cast("date"), F.lit(1))
                            .otherwise(F.lit(2)))
    clean = periods if cleaned else clean_transactions(periods)
    feats = product_features(clean, concentration, by=("period", PRODUCT_ID))
    return complete_rows(join_master(feats, master, extra=("period",)))


def label_periods(period_feats: DataFrame,
                  centers: Sequence[Sequence[float]] = FIXED_CENTERS) -> DataFrame:
    """Label both periods in one pass with the same centers and the first
    period's scaling, so a changed label means changed behaviour.
    Materialise ``period_feats`` first: the statistics read it too."""
    first = period_feats.filter(F.col("period") == 1)
    return label_fixed(standardise(period_feats, MODEL_FEATURES, stats_from=first), centers)


def pivot_periods(labelled: DataFrame, label: str = "cluster") -> DataFrame:
    """(product, label in period 1, label in period 2) by one grouping;
    null where the product is absent."""
    return labelled.groupBy(PRODUCT_ID).agg(
        F.max(F.when(F.col("period") == 1, F.col(label))).alias("cluster_before"),
        F.max(F.when(F.col("period") == 2, F.col(label))).alias("cluster_after"))


def period_transitions(tx: DataFrame, master: DataFrame, cut: str,
                       centers: Sequence[Sequence[float]] = FIXED_CENTERS) -> DataFrame:
    """:func:`period_features`, :func:`label_periods` and :func:`pivot_periods`."""
    return pivot_periods(label_periods(period_features(tx, master, cut), centers))


def segment_transitions(before: DataFrame, after: DataFrame, label: str = "cluster") -> DataFrame:
    """Per product the label before and after (full outer join: a
    product may appear or vanish), as a product-level table."""
    b = before.select(PRODUCT_ID, F.col(label).alias("cluster_before"))
    a = after.select(PRODUCT_ID, F.col(label).alias("cluster_after"))
    return b.join(a, PRODUCT_ID, "full_outer")


def transition_counts(transitions: DataFrame) -> DataFrame:
    """Products per (cluster_before, cluster_after); null = absent."""
    return transitions.groupBy("cluster_before", "cluster_after").agg(F.count(F.lit(1)).alias("products"))


def transition_alerts(transitions: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Products whose segment changed, appeared or vanished."""
    kind = (F.when(F.col("cluster_before").isNull(), F.lit("appeared"))
            .when(F.col("cluster_after").isNull(), F.lit("vanished"))
            .otherwise(F.lit("changed")))
    changed = ~F.col("cluster_before").eqNullSafe(F.col("cluster_after"))
    return transitions.filter(changed).select(
        *extra, PRODUCT_ID, "cluster_before", "cluster_after", kind.alias("change"))
