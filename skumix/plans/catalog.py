"""Registered queries: one per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables.  Column names match the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ALL_FEATURES
from ..functions.columns import truncate_name
from ..operators import assign, history, incremental, matching, profile, quality, scale, silhouette, stats, strategy
from ..operators import features as feat
from ..session import drop_shuffles, shared_path, written_table
from ..sources import csv_io, tables
from . import certificates as C
from . import models as M
from . import segmentation as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# ---- shared inputs -------------------------------------------------------

_MATERIALISED: dict = {}


def _run_key(spark: SparkSession, sf: str, what: str):
    return (spark.sparkContext.applicationId, sf.rstrip("/"), what)


def materialised(spark: SparkSession, sf: str, what: str, build) -> DataFrame:
    """Build a per-product table once per (application, tables) and write it
    to the shared folder.

    Every later analysis of the run (statistics, scaling, profiles,
    models) reads this table instead of re-running the scan, join, dedup
    and roll-up of the transactions; a lost executor re-reads its files.
    :func:`forget` drops the tables of a run whose inputs have changed."""
    key = _run_key(spark, sf, what)
    if key not in _MATERIALISED:
        _MATERIALISED[key] = written_table(build(), what.split(":")[0])
    return _MATERIALISED[key]


def forget(spark: SparkSession, sf: str | None = None) -> None:
    """Forget the shared tables and model runs of this application (of one
    folder of tables, or all) and release the models' cached points."""
    app = spark.sparkContext.applicationId

    def mine(key) -> bool:
        return key[0] == app and (sf is None or key[1] == sf.rstrip("/"))

    for key in [k for k in _RUNS if mine(k)]:
        _RUNS.pop(key).release()
    for key in [k for k in _MATERIALISED if mine(k)]:
        del _MATERIALISED[key]


def clean_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table of the clean tables (the clustering input)."""
    return materialised(spark, sf, "features", lambda: feat.feature_table(
        tables.transactions(spark, sf), tables.product_master(spark, sf)))


def dirty_features(spark: SparkSession, sf: str) -> DataFrame:
    """Feature table built from the dirty copies (nulls, duplicates)."""
    return materialised(spark, sf, "dirty_features", lambda: feat.feature_table(
        tables.dirty_transactions(spark, sf), tables.dirty_master(spark, sf)))


# ---- 2.1 sources, profiling ---------------------------------------------

@query("a2_table_profile")
def a2_table_profile(spark, sf):
    return quality.table_profile(tables.transactions(spark, sf))


@query("a2_preview_transactions")
def a2_preview_transactions(spark, sf):
    # (id, line) repeats in the driver tables: order by every column so the
    # first rows are well defined
    tx = tables.transactions(spark, sf)
    return quality.preview(tx, list(tx.columns), 5)


@query("a3_column_range")
def a3_column_range(spark, sf):
    return quality.column_range(tables.transactions(spark, sf), "date")


@query("a4_role_binding")
def a4_role_binding(spark, sf):
    return tables.transactions(spark, sf)


# ---- 2.2 cleaning, data quality ------------------------------------------

@query("a4_timestamp_role")
def a4_timestamp_role(spark, sf):
    """A date role with a time of day: two times of one day stay two rows
    through the whole-row dedup, exact copies become one."""
    li = tables.read_table(spark, sf, "lineitem")
    day = F.col("l_shipdate").cast("date").cast("timestamp")
    raw = li.select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("product"), F.col("l_suppkey").alias("buyer"),
        F.explode(F.array(day, day + F.expr("INTERVAL 9 HOURS"), day)).alias("at"))
    roles = {"id": "id", "product_id": "product", "customer_id": "buyer", "date": "at"}
    clean = feat.clean_transactions(tables.bind_roles(raw, roles, keep_others=True))
    return clean.select("id", "product_id", "customer_id", "date",
                        F.hour("date_source").alias("hour"))


@query("b1_null_key_filter")
def b1_null_key_filter(spark, sf):
    return quality.null_key_filter(tables.dirty_transactions(spark, sf))


@query("b2_cleaning_audit")
def b2_cleaning_audit(spark, sf):
    return quality.cleaning_audit(tables.dirty_master(spark, sf), "products").unionByName(
        quality.cleaning_audit(tables.dirty_transactions(spark, sf), "transactions"))


@query("b3_drop_any_null")
def b3_drop_any_null(spark, sf):
    return quality.drop_any_null(tables.dirty_transactions(spark, sf))


@query("b4_dedup")
def b4_dedup(spark, sf):
    return feat.clean_transactions(tables.dirty_transactions(spark, sf))


@query("b5_duplicate_audit")
def b5_duplicate_audit(spark, sf):
    tx = quality.null_key_filter(tables.dirty_transactions(spark, sf))
    return quality.duplicate_audit(tx)


@query("b5_master_key_audit")
def b5_master_key_audit(spark, sf):
    return quality.repeated_key_audit(tables.dirty_master(spark, sf))


@query("b6_distinct_weeks")
def b6_distinct_weeks(spark, sf):
    return quality.distinct_values(quality.null_key_filter(tables.dirty_transactions(spark, sf)), "week")


@query("b7_null_counts")
def b7_null_counts(spark, sf):
    return quality.null_counts(dirty_features(spark, sf))


# ---- 2.3 projections, scalar functions ------------------------------------

@query("c3_concentration")
def c3_concentration(spark, sf):
    return feat.product_features(feat.clean_transactions(tables.dirty_transactions(spark, sf)))


@query("c4_smoothed_concentration")
def c4_smoothed_concentration(spark, sf):
    f = feat.product_features(feat.clean_transactions(tables.transactions(spark, sf)), "smoothed")
    return f.select("product_id", "volume", "unique_customers",
                    F.round("concentration", 6).alias("concentration"))


@query("c5_truncated_names")
def c5_truncated_names(spark, sf):
    # the tables' names are short: repeat them with their key beyond 50 characters
    return tables.product_master(spark, sf).select("product_id", truncate_name(
        F.repeat(F.concat_ws("-", "product_name", F.col("product_id").cast("string")), 6), 50)
        .alias("product_name"))


# ---- 2.4 aggregations, statistics -----------------------------------------

@query("d1_volume")
def d1_volume(spark, sf):
    return feat.volume(feat.clean_transactions(tables.transactions(spark, sf)))


@query("d2_order_frequency")
def d2_order_frequency(spark, sf):
    return feat.order_frequency(feat.clean_transactions(tables.transactions(spark, sf)))


@query("d3_unique_customers")
def d3_unique_customers(spark, sf):
    return feat.unique_customers(feat.clean_transactions(tables.dirty_transactions(spark, sf)))


@query("d4_product_features")
def d4_product_features(spark, sf):
    return feat.product_features(feat.clean_transactions(tables.transactions(spark, sf)))


@query("d5_describe")
def d5_describe(spark, sf):
    return stats.describe(clean_features(spark, sf), ALL_FEATURES)


@query("d6_describe_median")
def d6_describe_median(spark, sf):
    return stats.describe(clean_features(spark, sf), ALL_FEATURES, median=True)


@query("d7_correlation")
def d7_correlation(spark, sf):
    return stats.correlation(clean_features(spark, sf), ALL_FEATURES)


@query("d8_histogram")
def d8_histogram(spark, sf):
    return stats.histogram(clean_features(spark, sf), ALL_FEATURES, bins=50)


@query("d9_scatter_pairs")
def d9_scatter_pairs(spark, sf):
    return stats.scatter_pairs(clean_features(spark, sf))


# ---- 2.5 joins ----------------------------------------------------------------

@query("e1_features_master_join")
def e1_features_master_join(spark, sf):
    return clean_features(spark, sf)


@query("e1_dirty_features_master_join")
def e1_dirty_features_master_join(spark, sf):
    return dirty_features(spark, sf)


# ---- 2.6 sorts, limits ----------------------------------------------------

@query("f3_preview")
def f3_preview(spark, sf):
    return quality.preview(clean_features(spark, sf), "product_id", 10)


# ---- 2.7 scaling and fixed-center labels ------------------------------------

def fixed_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Complete feature rows, standardised (column form) and labelled by
    the fixed centers: deterministic labels for every exact check.
    Materialised once per run (a per-product table) and shared."""
    return materialised(spark, sf, "fixed_labelled", lambda: assign.label_fixed(
        scale.standardise(scale.complete_rows(clean_features(spark, sf)))))


def fixed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Value counts of the fixed labelling, written once per run."""
    key = _run_key(spark, sf, "fixed_counts")
    if key not in _MATERIALISED:
        _MATERIALISED[key] = profile.label_counts(fixed_labelled(spark, sf))
    return _MATERIALISED[key]


def fixed_names(spark: SparkSession, sf: str) -> DataFrame:
    return profile.segment_names(fixed_labelled(spark, sf), counts=fixed_counts(spark, sf))


ZC = assign.ZCOLS


@query("g1_assemble")
def g1_assemble(spark, sf):
    v = scale.assemble(clean_features(spark, sf))
    a = vector_to_array("features")
    return v.select("product_id", a[0].alias("f_volume"), a[1].alias("f_order_frequency"),
                    a[2].alias("f_concentration"))


@query("g1_assemble_audit")
def g1_assemble_audit(spark, sf):
    return scale.assemble_audit(dirty_features(spark, sf))


@query("g2_standardise")
def g2_standardise(spark, sf):
    z = scale.standardise(scale.complete_rows(clean_features(spark, sf)), ddof=1)
    return z.select("product_id", *[F.round(c, 6).alias(c) for c in ZC])


@query("g2b_standardise_population")
def g2b_standardise_population(spark, sf):
    z = scale.standardise(scale.complete_rows(clean_features(spark, sf)), ddof=0)
    return z.select("product_id", *[F.round(c, 6).alias(c) for c in ZC])


@query("g3_scaling_audit")
def g3_scaling_audit(spark, sf):
    z = scale.standardise(scale.complete_rows(clean_features(spark, sf)), ddof=0)
    return scale.scaling_audit(z, ZC)


@query("g5_inertia_fixed")
def g5_inertia_fixed(spark, sf):
    return assign.inertia(fixed_labelled(spark, sf))


@query("g6_silhouette_fixed")
def g6_silhouette_fixed(spark, sf):
    return assign.silhouette_squared(fixed_labelled(spark, sf))


@query("g6b_silhouette_sampled")
def g6b_silhouette_sampled(spark, sf):
    """Plain Euclidean silhouette of the fixed labels from 1,000 points
    compared with all products."""
    return silhouette.silhouette_sampled(fixed_labelled(spark, sf))


@query("g4_lloyd_step_fixed")
def g4_lloyd_step_fixed(spark, sf):
    return assign.lloyd_step(fixed_labelled(spark, sf))


@query("fixed_labels")
def fixed_labels(spark, sf):
    lab = fixed_labelled(spark, sf)
    return lab.select("product_id", "cluster")


# ---- profiles, names, strategies on fixed labels ------------------------------

@query("d10_cluster_sizes")
def d10_cluster_sizes(spark, sf):
    return profile.cluster_sizes(fixed_labelled(spark, sf))


@query("d11_boxplot")
def d11_boxplot(spark, sf):
    return profile.boxplot_table(fixed_labelled(spark, sf), counts=fixed_counts(spark, sf))


@query("d12_cluster_bars")
def d12_cluster_bars(spark, sf):
    return profile.cluster_size_bars(fixed_labelled(spark, sf), len(assign.FIXED_CENTERS))


@query("d13_labelled_scatter_2d")
def d13_labelled_scatter_2d(spark, sf):
    lab = fixed_labelled(spark, sf)
    return profile.labelled_scatter_2d(lab, fixed_names(spark, sf))


@query("d14_labelled_scatter_3d")
def d14_labelled_scatter_3d(spark, sf):
    lab = fixed_labelled(spark, sf)
    return profile.labelled_scatter_3d(lab, fixed_names(spark, sf))


@query("e3_strategy_lookup")
def e3_strategy_lookup(spark, sf):
    return strategy.strategy_lookup(fixed_names(spark, sf))


@query("e4_names_to_products")
def e4_names_to_products(spark, sf):
    lab = fixed_labelled(spark, sf)
    return profile.names_to_products(lab, fixed_names(spark, sf))


@query("e5_cluster_vs_medians")
def e5_cluster_vs_medians(spark, sf):
    return profile.cluster_vs_medians(fixed_labelled(spark, sf), counts=fixed_counts(spark, sf))


@query("f1_order_by_cluster")
def f1_order_by_cluster(spark, sf):
    return fixed_labelled(spark, sf).select("cluster").distinct().orderBy("cluster")


@query("f2_top_products")
def f2_top_products(spark, sf):
    return profile.top_products(fixed_labelled(spark, sf), 5)


@query("h1_cluster_profile")
def h1_cluster_profile(spark, sf):
    return profile.cluster_profile(fixed_labelled(spark, sf))


@query("h2_segment_names")
def h2_segment_names(spark, sf):
    return fixed_names(spark, sf)


@query("h3_segment_summary")
def h3_segment_summary(spark, sf):
    return profile.segment_summary(fixed_labelled(spark, sf), counts=fixed_counts(spark, sf))


@query("h4_strategy_report")
def h4_strategy_report(spark, sf):
    return strategy.strategy_report(fixed_names(spark, sf))


@query("h4b_short_strategy")
def h4b_short_strategy(spark, sf):
    return strategy.short_strategy(fixed_names(spark, sf))


# ---- sinks ------------------------------------------------------------------

FEATURE_SCHEMA = ("product_id bigint, product_name string, volume bigint, order_frequency bigint, "
                  "unique_customers bigint, concentration double")


@query("a1_csv_roundtrip")
def a1_csv_roundtrip(spark, sf):
    path = csv_io.write_csv(clean_features(spark, sf).withColumn("product_name", awkward("product_name")),
                            shared_path(spark, "a1"))
    return csv_io.read_csv(spark, path, schema=FEATURE_SCHEMA, multi_line=True)


def awkward(name: str):
    """Names with a line break, quotes, commas and outer blanks, by product."""
    return (F.when(F.col("product_id") % 4 == 0, F.concat(name, F.lit('\nsecond "line", ')))
            .when(F.col("product_id") % 4 == 1, F.concat(F.lit('"'), name, F.lit(',"')))
            .when(F.col("product_id") % 4 == 2, F.concat(F.lit("  "), name))
            .otherwise(F.col(name)))


def _export_fixed(spark, sf) -> tuple[str, DataFrame]:
    lab = fixed_labelled(spark, sf)
    names = fixed_names(spark, sf)
    table = (lab.join(F.broadcast(names), "cluster", "left")
             .select("product_id", awkward("product_name").alias("product_name"), "volume",
                     "order_frequency", "unique_customers", "concentration", "cluster", "segment"))
    path = shared_path(spark, "a5")
    return path, csv_io.write_counted(table, path)


EXPORT_SCHEMA = FEATURE_SCHEMA + ", cluster int, segment string"


@query("a5_export_csv")
def a5_export_csv(spark, sf):
    return csv_io.read_csv(spark, _export_fixed(spark, sf)[0], schema=EXPORT_SCHEMA, multi_line=True)


@query("a6_export_manifest")
def a6_export_manifest(spark, sf):
    return _export_fixed(spark, sf)[1]


# ---- 2.10 history extensions --------------------------------------------------

PERIOD_CUT = "1998-07-01"


@query("x1_history_coverage")
def x1_history_coverage(spark, sf):
    return history.history_coverage(feat.clean_transactions(tables.transactions(spark, sf)))


def _transitions(spark, sf):
    pf = materialised(spark, sf, f"period_features:{PERIOD_CUT}", lambda: history.period_features(
        tables.transactions(spark, sf), tables.product_master(spark, sf), PERIOD_CUT))
    return history.pivot_periods(history.label_periods(pf))


@query("x2_segment_transitions")
def x2_segment_transitions(spark, sf):
    return history.transition_counts(_transitions(spark, sf))


@query("x3_transition_alerts")
def x3_transition_alerts(spark, sf):
    return history.transition_alerts(_transitions(spark, sf))


# Centers of a re-fit of the second period, numbered otherwise.
REFIT_CENTERS = ((0.1, 0.1, 1.8), (-0.9, -0.9, 0.1), (1.2, 1.1, 0.0), (0.1, 0.0, 0.1))


def _refit_transitions(spark, sf) -> DataFrame:
    """Per product the fixed label in period 1 and that of the re-fit, on the
    second period's own scale, in period 2."""
    pf = materialised(spark, sf, f"period_features:{PERIOD_CUT}", lambda: history.period_features(
        tables.transactions(spark, sf), tables.product_master(spark, sf), PERIOD_CUT))
    before = assign.label_fixed(scale.standardise(pf.where("period = 1")))
    after = assign.label_fixed(scale.standardise(pf.where("period = 2")), REFIT_CENTERS)
    return history.segment_transitions(before, after)


@query("x2_segment_matching")
def x2_segment_matching(spark, sf):
    """Overlaps of two fits' segments and which pairs are one segment."""
    return matching.matched_overlap(_refit_transitions(spark, sf), len(REFIT_CENTERS))


@query("x3_matched_alerts")
def x3_matched_alerts(spark, sf):
    """Alerts between two fits, after the new labels took the old numbers."""
    return history.transition_alerts(matching.matched_transitions(_refit_transitions(spark, sf), len(REFIT_CENTERS)))


# ---- 2.7 models (rows-only checks: results depend on the fitted model) ---------

_RUNS: dict = {}


def segmentation(spark: SparkSession, sf: str):
    """One segmentation run per (session, tables), shared by every model
    query so the sweeps are fitted once."""
    key = _run_key(spark, sf, "segmentation")
    if key not in _RUNS:
        # the feature table is already checkpointed: no second checkpoint
        _RUNS[key] = S.segment(clean_features(spark, sf), checkpoint=False)
    return _RUNS[key]


def _mi(spark, sf):
    return segmentation(spark, sf).input


@query("g4_kmeans_fit")
def g4_kmeans_fit(spark, sf):
    mi = _mi(spark, sf)
    return M.kmeans_centers(M.fit_kmeans(mi, 4), mi)


@query("g7_kmeans_sweep")
def g7_kmeans_sweep(spark, sf):
    return segmentation(spark, sf).kmeans.table


@query("g8_choose_k")
def g8_choose_k(spark, sf):
    return M.best_of_sweep(segmentation(spark, sf).kmeans.table, "silhouette", maximize=True)


@query("g9_final_kmeans")
def g9_final_kmeans(spark, sf):
    seg = segmentation(spark, sf)
    return M.kmeans_centers(seg.kmeans_model, seg.input)


def _restart_fits(spark, sf) -> dict:
    """The ten initialisations of both models, fitted once per run."""
    seg = segmentation(spark, sf)
    if seg.restart_fits is None:
        seg.restart_fits = M.restart_fits(seg.input, 4, n_init=10)
    return seg.restart_fits


@query("g10_restarts")
def g10_restarts(spark, sf):
    return M.restart_table(_mi(spark, sf), 4, _restart_fits(spark, sf))


@query("g11_gmm_fit")
def g11_gmm_fit(spark, sf):
    mi = _mi(spark, sf)
    return M.gmm_components(M.fit_gmm(mi, 3), mi)


@query("g12_bic")
def g12_bic(spark, sf):
    seg = segmentation(spark, sf)
    return M.bic_table(seg.gmm.table.select("k", "log_likelihood", F.lit(seg.input.n).alias("n")),
                       len(seg.input.features), "n")


@query("g13_gmm_sweep")
def g13_gmm_sweep(spark, sf):
    return segmentation(spark, sf).gmm.table


@query("g14_choose_components")
def g14_choose_components(spark, sf):
    return M.best_of_sweep(segmentation(spark, sf).gmm.table, "bic", maximize=False)


@query("g15_final_gmm")
def g15_final_gmm(spark, sf):
    seg = segmentation(spark, sf)
    return M.gmm_components(seg.gmm_model, seg.input)


# ---- certificates: what makes a fitted model right, recomputed from its parameters

@query("g4_kmeans_certificate")
def g4_kmeans_certificate(spark, sf):
    mi = _mi(spark, sf)
    return C.kmeans_certificates(mi, {(4, 42): M.fit_kmeans(mi, 4)})


@query("g7_kmeans_sweep_certificates")
def g7_kmeans_sweep_certificates(spark, sf):
    seg = segmentation(spark, sf)
    return C.kmeans_certificates(seg.input, {(r["k"], r["seed"]): seg.kmeans.models[r["k"]] for r in seg.kmeans.rows})


@query("g8_choice_certificate")
def g8_choice_certificate(spark, sf):
    seg = segmentation(spark, sf)
    return C.choice_certificate(seg.input, seg.kmeans, seg.k, "silhouette", True, M.KMEANS_COL)


@query("g9_final_kmeans_certificate")
def g9_final_kmeans_certificate(spark, sf):
    """The final model at the chosen k (the number itself depends on the fit)."""
    seg = segmentation(spark, sf)
    got = C.kmeans_certificates(seg.input, {(seg.k, 42): seg.kmeans_model})
    return got.withColumn("k_is_chosen", F.col("k") == seg.k).drop("k", "clusters")


@query("g10_restart_certificates")
def g10_restart_certificates(spark, sf):
    fits = _restart_fits(spark, sf)
    mi = _mi(spark, sf)
    table = M.restart_table(mi, 4, fits)
    worse = table.alias("a").join(table.where("chosen").alias("b"), "model").groupBy("model", F.col("a.seed").alias("seed")).agg(
        F.min(F.when(F.col("model") == "GMM", F.col("a.score") <= F.col("b.score"))
              .otherwise(F.col("a.score") >= F.col("b.score"))).alias("not_better_than_chosen"))
    own = C.kmeans_certificates(mi, {(4, s): f for (m, s), f in fits.items() if m == "K-means"}).select(
        F.lit("K-means").alias("model"), "seed", "products", (F.col("nearest") & F.col("centers_are_means") & F.col("inertia_matches")
                                                      & F.col("sizes_match")).alias("certified"))
    mixed = C.mixture_certificates(mi, {(4, s): f for (m, s), f in fits.items() if m == "GMM"}).select(
        F.lit("GMM").alias("model"), "seed", "products", (F.col("memberships_match") & F.col("labels_match")
                                                  & F.col("likelihood_rises") & F.col("step_gains") & F.col("sizes_match")).alias("certified"))
    return own.unionByName(mixed).join(worse, ["model", "seed"])


@query("g11_gmm_certificate")
def g11_gmm_certificate(spark, sf):
    mi = _mi(spark, sf)
    return C.mixture_certificates(mi, {(3, 42): M.fit_gmm(mi, 3)})


@query("g13_gmm_sweep_certificates")
def g13_gmm_sweep_certificates(spark, sf):
    seg = segmentation(spark, sf)
    return C.mixture_certificates(seg.input, {(r["k"], r["seed"]): seg.gmm.models[r["k"]] for r in seg.gmm.rows},
                                  {r["k"]: r["bic"] for r in seg.gmm.rows})


@query("g14_choice_certificate")
def g14_choice_certificate(spark, sf):
    seg = segmentation(spark, sf)
    return C.choice_certificate(seg.input, seg.gmm, seg.gmm_k, "bic", False, M.GMM_COL)


@query("g15_final_gmm_certificate")
def g15_final_gmm_certificate(spark, sf):
    """The final mixture at the chosen number of components."""
    seg = segmentation(spark, sf)
    got = C.mixture_certificates(seg.input, {(seg.gmm_k, 42): seg.gmm_model}, {seg.gmm_k: seg.gmm_best["bic"]})
    return got.withColumn("k_is_chosen", F.col("k") == seg.gmm_k).drop("k", "components")


@query("g16_model_comparison")
def g16_model_comparison(spark, sf):
    return S.model_comparison(segmentation(spark, sf))


@query("e2_label_join")
def e2_label_join(spark, sf):
    return S.label_join(segmentation(spark, sf))


@query("d10_model_cluster_sizes")
def d10_model_cluster_sizes(spark, sf):
    scored = segmentation(spark, sf).scored
    return profile.cluster_sizes(scored, M.KMEANS_COL).unionByName(
        profile.cluster_sizes(scored, M.GMM_COL).withColumnRenamed(M.GMM_COL, M.KMEANS_COL)) \
        .withColumnRenamed(M.KMEANS_COL, "cluster")


@query("h3_model_segment_summary")
def h3_model_segment_summary(spark, sf):
    return S.segment_summary(segmentation(spark, sf))


@query("h5_executive_summary")
def h5_executive_summary(spark, sf):
    return S.executive_summary(segmentation(spark, sf))


@query("h6_final_table")
def h6_final_table(spark, sf):
    return S.final_table(segmentation(spark, sf))


# ---- selection, comparison and reports on deterministic rows -------------------
# The same functions as above, on scores and labels that any engine can
# recompute: fixed centers (their first k, or all) and a second labelling.

def _fixed_scores(spark, sf) -> DataFrame:
    """(k, inertia, silhouette) of the first k fixed centers, k = 2..4."""
    z = materialised(spark, sf, "fixed_scaled", lambda: scale.standardise(
        scale.complete_rows(clean_features(spark, sf))))
    out = None
    for k in range(2, len(assign.FIXED_CENTERS) + 1):
        centers = assign.FIXED_CENTERS[:k]
        lab = assign.label_fixed(z, centers)
        one = assign.inertia(lab, centers).select(
            "k", "inertia", assign.silhouette_squared(lab).select("silhouette").scalar().alias("silhouette"))
        out = one if out is None else out.unionByName(one)
    return out


def _second_labels(spark, sf) -> DataFrame:
    """A labelling by three other fixed centers, as a second model's."""
    return assign.label_fixed(fixed_labelled(spark, sf), SECOND_CENTERS, label="cluster_gmm")


# Centers of the second labelling.
SECOND_CENTERS = ((-0.5, -0.5, -0.5), (0.5, 0.5, -0.5), (0.5, 0.5, 1.5))


def _second_names(spark, sf) -> DataFrame:
    # the medians are those of all products, whatever their labels
    return profile.segment_names(_second_labels(spark, sf), M.GMM_COL, counts=fixed_counts(spark, sf))


@query("d13_second_scatter_2d")
def d13_second_scatter_2d(spark, sf):
    """D13 on the labels of the second model (the mixture's column)."""
    return profile.labelled_scatter_2d(_second_labels(spark, sf), _second_names(spark, sf), M.GMM_COL)


@query("d14_second_scatter_3d")
def d14_second_scatter_3d(spark, sf):
    """D14 on the labels of the second model."""
    return profile.labelled_scatter_3d(_second_labels(spark, sf), _second_names(spark, sf), M.GMM_COL)


@query("f4_best_of_fixed_sweep")
def f4_best_of_fixed_sweep(spark, sf):
    scores = materialised(spark, sf, "fixed_scores", lambda: _fixed_scores(spark, sf))
    best = M.best_of_sweep(scores, "silhouette", maximize=True).withColumn("choice", F.lit("silhouette"))
    return best.unionByName(M.best_of_sweep(scores, "inertia", maximize=False)
                            .withColumn("choice", F.lit("inertia")))


@query("g12_bic_fixed")
def g12_bic_fixed(spark, sf):
    """The BIC formula on log-likelihoods -n / k of the scaled products."""
    n = fixed_labelled(spark, sf).count()
    scores = spark.range(2, 11).select(F.col("id").cast("int").alias("k"),
                                       (F.lit(-1.0 * n) / F.col("id")).alias("log_likelihood"))
    return M.bic_table(scores, len(scale.MODEL_FEATURES), n).withColumn("bic", F.round("bic", 6)).select(
        "k", F.round("log_likelihood", 6).alias("log_likelihood"), F.col("parameters").cast("long"), "bic")


def _two_models(spark, sf):
    """Silhouettes of both fixed labellings."""
    a = assign.silhouette_squared(fixed_labelled(spark, sf)).first()[0]
    b = assign.silhouette_squared(_second_labels(spark, sf), label="cluster_gmm").first()[0]
    return a, b


@query("g16_comparison_fixed")
def g16_comparison_fixed(spark, sf):
    a, b = _two_models(spark, sf)
    rows = [(name, x, y, M.recommend(x, y)) for name, x, y in (
        ("as scored", a, b), ("swapped", b, a), ("tie", a, a), ("first missing", None, b), ("second missing", a, None))]
    return spark.createDataFrame(rows, "case string, silhouette_kmeans double, silhouette_gmm double, "
                                       "recommended string")


@query("e2_two_labellings_fixed")
def e2_two_labellings_fixed(spark, sf):
    """E2 + C2: two labellings of the same products, joined by product."""
    first = fixed_labelled(spark, sf).select("product_id", F.col("cluster").alias("cluster_kmeans"))
    second = _second_labels(spark, sf).select("product_id", "cluster_gmm")
    return S.join_labels(first, second)


@query("h5_executive_fixed")
def h5_executive_fixed(spark, sf):
    a, b = _two_models(spark, sf)
    inertia = assign.inertia(fixed_labelled(spark, sf)).first()["inertia"]
    return S.summary_table(
        fixed_labelled(spark, sf).withColumnRenamed("cluster", M.KMEANS_COL), fixed_names(spark, sf),
        M.recommend(a, b), {"k": 4, "silhouette": a, "inertia": inertia}, {"k": 3, "silhouette": b, "bic": None})


@query("h6_final_table_fixed")
def h6_final_table_fixed(spark, sf):
    scored = _second_labels(spark, sf).withColumnRenamed("cluster", M.KMEANS_COL)
    return S.product_table(scored, fixed_names(spark, sf))


@query("h1_smoothed_profile")
def h1_smoothed_profile(spark, sf):
    """H1 + H3 on the unrounded smoothed concentration."""
    lab = fixed_labelled(spark, sf).withColumn("concentration", F.expr("volume / (unique_customers + 1.0D)"))
    p = profile.cluster_profile(lab).select(
        "cluster", "products", F.round("mean_concentration", 6).alias("mean_concentration"),
        F.round("min_concentration", 6).alias("min_concentration"),
        F.round("max_concentration", 6).alias("max_concentration"))
    return p


# ---- streaming form of X2/X3 ------------------------------------------------------

STREAM_BATCHES = 4             # fixed value: micro-batches that the log arrives in
STREAM_FILE_LINES = 250_000    # fixed value: lines of a file of a micro-batch


@query("x3_stream_transition_alerts")
def x3_stream_transition_alerts(spark, sf):
    """X3 computed by the streaming monitor: the transactions are laid
    down as two period datasets (before/after the cut), streamed with an
    available-now trigger, and the alerts table is read back."""
    import os
    from ..streaming import monitor
    # four micro-batches of as many files each: both periods arrive in several
    # batches, and a file (written by one task) does not grow with the log
    base = shared_path(spark, "stream")
    src = os.path.join(base, "input")
    tx = tables.transactions(spark, sf).withColumn(
        "period", F.when(F.col("date") < F.lit(PERIOD_CUT).cast("date"), F.lit(1)).otherwise(F.lit(2)))
    files = max(1, -(-tables.read_table(spark, sf, "lineitem").count() // (STREAM_BATCHES * STREAM_FILE_LINES)))
    tx.repartition(STREAM_BATCHES * files, "id").write.mode("overwrite").parquet(src)
    q = monitor.start_transition_monitor(spark, src, tables.product_master(spark, sf),
                                         os.path.join(base, "state"), os.path.join(base, "ckpt"),
                                         max_files_per_trigger=files)
    q.awaitTermination()
    for done in (src, os.path.join(base, "state", "transactions")):  # no copy of the log is kept
        monitor._remove(spark, done)
    return monitor.read_alerts(spark, os.path.join(base, "state")).select(
        "product_id", "cluster_before", "cluster_after", "change")


STREAM_DAYS = 364   # fixed value: 52 weeks a period
STREAM_LATE = 7     # fixed value: days a transaction may be late
STREAM_BUCKET_LINES = 125_000  # fixed value: lines of the log for each bucket of the stream's state


@query("x3_stateful_stream_alerts")
def x3_stateful_stream_alerts(spark, sf):
    """X3 by state: the transactions arrive in four time-ordered parts, after
    each of which the monitor is started anew from its checkpoint; alerts of
    all periods that the watermark has closed."""
    import os
    from ..streaming import monitor, stateful
    base = shared_path(spark, "stateful")
    src = os.path.join(base, "input")
    tx = tables.transactions(spark, sf).withColumn("period", stateful.period_of(F.col("date"), STREAM_DAYS))
    r = tx.agg(F.min("period").alias("first"), F.max("period").alias("last")).first()
    first, last = r["first"] or 0, r["last"] or 0
    spread = max(16, -(-tables.read_table(spark, sf, "lineitem").count() // STREAM_BUCKET_LINES))
    master = tables.product_master(spark, sf)
    reference = feat.join_master(feat.product_features(feat.clean_transactions(
        tx.where(F.col("period") == first).drop("period"))), master)
    numbers = stateful.reference_scale(scale.complete_rows(reference))
    drop_shuffles(spark)
    step = max(1, -(-(last - first + 1) // 4))
    for start in range(first, last + 1, step):
        part = tx.where((F.col("period") >= start) & (F.col("period") < start + step)).drop("period")
        part.write.mode("append").parquet(src)
        drop_shuffles(spark)
        stateful.start_label_monitor(spark, src, master, base, numbers, first, STREAM_DAYS,
                                     STREAM_LATE, spread=spread).awaitTermination()
        monitor._remove(spark, src)  # no copy of the log is kept
        drop_shuffles(spark)
    monitor._remove(spark, os.path.join(base, "checkpoint"))
    return stateful.read_alerts(spark, base)


# ---- state that arrivals merge into --------------------------------------------------

def _part_moments(spark, sf) -> DataFrame:
    """Moments of the feature table in eight parts, as if they came apart."""
    return materialised(spark, sf, "part_moments", lambda: incremental.moment_state(
        clean_features(spark, sf), by=(F.col("product_id") % 8)))


@query("d5_merged_describe")
def d5_merged_describe(spark, sf):
    return incremental.describe_merged(incremental.merged_moments(_part_moments(spark, sf)))


@query("d7_merged_correlation")
def d7_merged_correlation(spark, sf):
    return incremental.correlation_merged(incremental.merged_moments(_part_moments(spark, sf)))


@query("g2_merged_standardise")
def g2_merged_standardise(spark, sf):
    """G2 by the merged state of the complete rows' parts."""
    rows = scale.complete_rows(clean_features(spark, sf))
    state = incremental.moment_state(rows, scale.MODEL_FEATURES, F.col("product_id") % 8)
    numbers = incremental.scale_merged(incremental.merged_moments(state))
    return rows.select("product_id", *[F.round(
        (F.col(c).cast("double") - F.lit(m)) / F.lit(sd) if sd else F.lit(0.0), 6).alias(scale.zname(c))
        for c, (m, sd) in ((c, numbers[c]) for c in scale.MODEL_FEATURES)])


@query("d11_sketch_quartiles")
def d11_sketch_quartiles(spark, sf):
    """Quartiles by cluster from sketches of eight parts, merged: whether each
    lies within the stated rank error of its rank (values depend on the
    sketch's coin tosses)."""
    lab = fixed_labelled(spark, sf)
    parts = incremental.quantile_sketches(lab.withColumn("_part", F.col("product_id") % 8),
                                          profile.PROFILE_FEATURES, ["cluster", "_part"])
    q = incremental.sketch_quantiles(incremental.merged_sketches(parts, ["cluster"]), (0.25, 0.5, 0.75), ["cluster"])
    q = materialised(spark, sf, "sketch_quartiles", lambda: q)
    counts = fixed_counts(spark, sf)
    j = counts.select("cluster", "feature", "x", F.col("n").alias("copies")).join(F.broadcast(q), ["cluster", "feature"])
    eps = incremental.rank_error()

    def within(c: str, p: float):
        below = F.sum(F.when(F.col("x") < F.col(c), F.col("copies")).otherwise(0)) / F.max("n")
        upto = F.sum(F.when(F.col("x") <= F.col(c), F.col("copies")).otherwise(0)) / F.max("n")
        return (below <= p + eps) & (upto >= p - eps)

    return j.groupBy("cluster", "feature").agg(
        F.max("n").alias("n"), within("q0", 0.25).alias("q1_within"), within("q1", 0.5).alias("median_within"),
        within("q2", 0.75).alias("q3_within"))


def _row_store(spark, sf) -> incremental.RowStore:
    """The dirty transactions in three arrivals, the second one twice."""
    key = _run_key(spark, sf, "row_store")
    if key not in _STORES:
        tx = quality.null_key_filter(tables.dirty_transactions(spark, sf))
        store = incremental.RowStore(spark, shared_path(spark, "row-store"), tx.schema, buckets=16)
        for part in (2, 0, 1, 0):
            store.add(tx.where(F.pmod(F.col("id") + F.col("line"), F.lit(3)) == part), str(part))
        _STORES[key] = store
    return _STORES[key]


_STORES: dict = {}


@query("b4_incremental_dedup")
def b4_incremental_dedup(spark, sf):
    return _row_store(spark, sf).rows()


@query("b5_incremental_audit")
def b5_incremental_audit(spark, sf):
    return _row_store(spark, sf).audit()


@query("d4_weekly_state")
def d4_weekly_state(spark, sf):
    """D4 from weekly state: the weeks arrive in four groups out of order,
    one of them twice."""
    tx = tables.transactions(spark, sf)
    store = incremental.FeatureStore(spark, shared_path(spark, "weekly-state"))
    for group in (3, 1, 0, 2, 1):
        store.add(tx.where(F.col("week") % 4 == group))
    return store.features()
