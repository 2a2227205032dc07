"""Per-product feature roll-up and master join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import CONCENTRATION, CUSTOMERS, FREQUENCY, PRODUCT_ID, PRODUCT_NAME, VOLUME
from ..functions.columns import concentration_ratio, smoothed_concentration
from ..sources.tables import DERIVED_WEEK, derived_week

FEATURE_COLUMNS = (PRODUCT_ID, PRODUCT_NAME, VOLUME, FREQUENCY, CUSTOMERS, CONCENTRATION)


def clean_transactions(tx: DataFrame, key: str = PRODUCT_ID, drop_any_null: bool = False) -> DataFrame:
    """B1 + B4: drop rows with a null product id (or, with ``drop_any_null``,
    a null in any column: B3), then whole-row dedup.

    The filter sits below the dedup so Catalyst pushes it into the scan.
    Dedup is a hash aggregate on every column with a map-side partial
    step, so even a group of copies holding a third of all rows is
    collapsed inside each map task before the shuffle.  A week column
    derived from the date (tagged in its metadata by ``bind_roles``) is
    left out of the shuffle and re-derived after it: same rows, ~10 %
    fewer shuffled bytes."""
    kept = tx.dropna(how="any") if drop_any_null else tx.filter(F.col(key).isNotNull())
    week = derived_week(kept)
    if week is None:
        return kept.dropDuplicates()
    from ..functions.columns import week_key
    out = kept.drop(week).dropDuplicates()
    return out.withColumn(week, week_key(F.col("date")).alias(week, metadata=DERIVED_WEEK)).select(*tx.columns)


def product_features(tx: DataFrame, concentration: str = "ratio",
                     by: tuple[str, ...] = (PRODUCT_ID,), approx_rsd: float | None = None) -> DataFrame:
    """Volume, order frequency, unique customers and concentration in
    one aggregation.

    Catalyst plans the two distinct counts with an Expand: rows are
    shuffled on (product, order) and (product, customer) first, so a hot
    product is spread over many tasks by its order/customer ids; the
    final per-product merge only sees partial counts.

    ``approx_rsd`` (e.g. 0.02) switches both distinct counts to
    HyperLogLog++ sketches: fixed-size buffers merged map-side, no Expand
    and a single shuffle on the product key, at the given relative
    standard deviation.  Off by default (the reference counts exactly)."""
    if approx_rsd is None:
        freq = F.count_distinct("id")
        cust = F.count_distinct("customer_id")
    else:
        freq = F.approx_count_distinct("id", approx_rsd)
        cust = F.approx_count_distinct("customer_id", approx_rsd)
    agg = tx.groupBy(*by).agg(
        F.count(F.lit(1)).alias(VOLUME),
        freq.alias(FREQUENCY),
        cust.alias(CUSTOMERS),
    )
    if concentration == "ratio":
        conc = concentration_ratio(F.col(VOLUME), F.col(CUSTOMERS))
    elif concentration == "smoothed":
        conc = smoothed_concentration(F.col(VOLUME), F.col(CUSTOMERS))
    else:
        raise ValueError(f"unknown concentration formula {concentration!r}")
    return agg.withColumn(CONCENTRATION, conc)


def volume(tx: DataFrame) -> DataFrame:
    """Rows per product."""
    return tx.groupBy(PRODUCT_ID).agg(F.count(F.lit(1)).alias(VOLUME))


def order_frequency(tx: DataFrame) -> DataFrame:
    """Distinct order ids per product."""
    return tx.groupBy(PRODUCT_ID).agg(F.count_distinct("id").alias(FREQUENCY))


def unique_customers(tx: DataFrame) -> DataFrame:
    """D3: distinct non-null customers per product."""
    return tx.groupBy(PRODUCT_ID).agg(F.count_distinct("customer_id").alias(CUSTOMERS))


def join_master(features: DataFrame, master: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """E1 + C1: inner join on product id, master rows with a null id removed
    (B1), columns in reference order.

    No broadcast hint: the master can be as large as the feature table,
    so the strategy is left to the optimizer and AQE, which broadcast it
    only when its measured size is under the threshold."""
    m = master.filter(F.col(PRODUCT_ID).isNotNull())
    return features.join(m, PRODUCT_ID, "inner").select(*extra, *FEATURE_COLUMNS)


def rolled_up_clean(tx: DataFrame, concentration: str = "ratio", key: str = PRODUCT_ID) -> DataFrame:
    """B1 + B4 + D4 fused into one aggregation with a single big shuffle.

    Duplicate rows change neither distinct count, and the volume of the
    deduplicated table is the number of distinct whole rows per product,
    so all three are distinct aggregates of one Expand: rows go to the
    shuffle keyed by (product, row | order | customer) after a map-side
    partial aggregate, which both removes copies early and spreads a hot
    product over many reducers.  The null-key filter is pushed into the
    scan.  Equal to ``product_features(clean_transactions(tx))``."""
    others = [c for c in tx.columns if c != key]
    agg = tx.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_distinct(F.struct(*others)).alias(VOLUME),
        F.count_distinct("id").alias(FREQUENCY),
        F.count_distinct("customer_id").alias(CUSTOMERS),
    )
    if concentration == "ratio":
        conc = concentration_ratio(F.col(VOLUME), F.col(CUSTOMERS))
    else:
        conc = smoothed_concentration(F.col(VOLUME), F.col(CUSTOMERS))
    return agg.withColumn(CONCENTRATION, conc)


def feature_table(tx: DataFrame, master: DataFrame, concentration: str = "ratio",
                  fused: bool = False, approx_rsd: float | None = None,
                  drop_any_null: bool = False) -> DataFrame:
    """Clean -> roll up -> join master: the clustering input table.

    Default is the two-step plan (dedup shuffle on flat columns, then the
    distinct-count shuffle); ``fused=True`` uses :func:`rolled_up_clean`
    (one shuffle stage fewer, struct-valued keys).  On local[8] at sf0.1
    the flat two-step plan measured faster (1.5-2.4 s vs 2.2-3.2 s).
    ``approx_rsd`` switches the distinct counts to HyperLogLog sketches
    (see :func:`product_features`)."""
    if fused and approx_rsd is None and not drop_any_null:
        return join_master(rolled_up_clean(tx, concentration), master)
    clean = clean_transactions(tx, drop_any_null=drop_any_null)
    return join_master(product_features(clean, concentration, approx_rsd=approx_rsd), master)
