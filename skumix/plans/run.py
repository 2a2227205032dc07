"""Command-line run: product master + transaction files -> every report
table and the labelled products, written under one output folder.

    python -m skumix --products products.csv --transactions tx.csv --out out/

Column names default to the reference's file layout and can be mapped
with --product-id, --product-name, --id, --customer-id, --week/--date.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import history, profile, quality, stats, strategy
from ..session import ensure_checkpoint_dir, remove_scratch, written_table
from ..sources.csv_io import read_csv, write_csv
from ..sources.tables import bind_roles
from . import models as M
from . import segmentation as S

# The column names of the reference's input files.
DEFAULT_COLUMNS = {
    "product_id": "Producto_ID",
    "product_name": "NombreProducto",
    "id": "id",
    "customer_id": "Cliente_ID",
    "week": "Semana",
}


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="skumix", description=__doc__.split("\n\n")[0])
    p.add_argument("--products", required=True, help="product master file or folder")
    p.add_argument("--transactions", required=True, help="transaction file or folder")
    p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    p.add_argument("--checkpoint-dir", default=None,
                   help="shared folder for checkpoints when the session has no spark.checkpoint.dir")
    p.add_argument("--input-format", default="csv", choices=("csv", "parquet"))
    p.add_argument("--output-format", default="csv", choices=("csv", "parquet"))
    p.add_argument("--infer-schema", action=argparse.BooleanOptionalAction, default=False,
                   help="CSV type inference (one extra pass over each file); without it CSV values are text")
    p.add_argument("--multi-line", action="store_true", help="CSV values may hold line breaks")
    for role, col in DEFAULT_COLUMNS.items():
        p.add_argument(f"--{role.replace('_', '-')}", default=col, help=f"column holding {role}")
    p.add_argument("--date", default=None, help="date column; the week is derived from it")
    p.add_argument("--approx-distinct", type=float, default=None, metavar="RSD",
                   help="HyperLogLog distinct counts at this relative std. deviation (default: exact)")
    p.add_argument("--k-min", type=int, default=2)
    p.add_argument("--k-max", type=int, default=10)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--max-iter", type=int, default=100)
    p.add_argument("--n-init", type=int, default=1, help="runs of every fit; the best is kept")
    p.add_argument("--ddof", type=int, default=1, choices=(0, 1), help="0: population standard deviation")
    p.add_argument("--concentration", default="ratio", choices=("ratio", "smoothed"))
    p.add_argument("--drop-any-null", action="store_true", help="drop transactions with a null in any column")
    p.add_argument("--parallelism", type=int, default=M.PARALLEL_FITS, help="fits that run at once")
    p.add_argument("--period-cut", default=None, metavar="DATE",
                   help="with --date: report segment transitions between before and from this day on")
    p.add_argument("--plot-bins", type=int, default=None, help="bound the scatter tables to bins per axis")
    return p.parse_args(argv)


def _read(spark: SparkSession, path: str, a: argparse.Namespace) -> DataFrame:
    if a.input_format == "csv":
        return read_csv(spark, path, infer=a.infer_schema, multi_line=a.multi_line)
    return spark.read.parquet(path)


def main(argv=None) -> dict:
    a = parse_args(argv)
    spark = SparkSession.builder.appName("skumix").getOrCreate()
    if a.checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(a.checkpoint_dir)
    ensure_checkpoint_dir(spark)
    products = _read(spark, a.products, a)
    raw_tx = _read(spark, a.transactions, a)

    master = products.select(F.col(a.product_id).alias("product_id"),
                             F.col(a.product_name).alias("product_name"))
    roles = {"id": a.id, "product_id": a.product_id, "customer_id": a.customer_id}
    if a.date:
        roles["date"] = a.date
    elif a.week in raw_tx.columns:
        roles["week"] = a.week
    tx = bind_roles(raw_tx, roles, keep_others=True)

    written: dict[str, str] = {}

    def out(name: str, df: DataFrame) -> None:
        path = os.path.join(a.out, name)
        write_csv(df, path, a.output_format)
        written[name] = path

    # the log is scanned and grouped by whole rows once; audits, weeks,
    # coverage, features and periods all read this table of (row, copies)
    copies = written_table(quality.with_copies(tx), "rows")
    rows = copies.drop(quality.COPIES)

    # cleaning audits (B2, B5), distinct weeks (B6), history coverage
    out("cleaning_audit", quality.cleaning_audit(master, "products").unionByName(
        quality.cleaning_audit(copies, "transactions", copies=quality.COPIES)))
    out("duplicate_audit", quality.copies_audit(quality.null_key_filter(copies)))
    out("master_key_audit", quality.repeated_key_audit(master))
    if "week" in rows.columns:
        out("weeks", quality.distinct_values(quality.null_key_filter(rows), "week"))
        out("history_coverage", history.history_coverage(quality.null_key_filter(rows)))

    # features (D4 + E1), written once; the rows are distinct already
    clean = rows.dropna(how="any") if a.drop_any_null else quality.null_key_filter(rows)
    features = written_table(feat.join_master(
        feat.product_features(clean, a.concentration, approx_rsd=a.approx_distinct), master), "features")
    out("features", features)
    out("null_counts", quality.null_counts(features))
    out("describe", stats.describe(features, median=True))
    out("correlation", stats.correlation(features))
    out("histogram", stats.histogram(features))
    out("scatter_pairs", stats.scatter_pairs(features, bins=a.plot_bins))

    # models, selection, comparison
    ks = tuple(range(a.k_min, a.k_max + 1))
    seg = S.segment(features, ks, ks, a.seed, a.max_iter, a.parallelism, checkpoint=False,
                    n_init=a.n_init, ddof=a.ddof)
    out("kmeans_sweep", seg.kmeans.table)
    out("gmm_sweep", seg.gmm.table)
    out("model_comparison", S.model_comparison(seg))
    out("kmeans_centers", M.kmeans_centers(seg.kmeans_model, seg.input))
    out("gmm_components", M.gmm_components(seg.gmm_model, seg.input))

    # interpretation on the K-means labels
    labelled = written_table(seg.scored.drop("features", M.FEATURES_COL, M.GMM_PROB_COL)
                             .withColumnRenamed(M.KMEANS_COL, "cluster"), "labelled")
    out("cluster_profile", profile.cluster_profile(labelled))
    out("cluster_sizes", profile.cluster_sizes(labelled))
    out("cluster_bars", profile.cluster_size_bars(labelled, seg.k))
    out("boxplot", profile.boxplot_table(labelled))
    out("scatter_2d", profile.labelled_scatter_2d(labelled, seg.names, bins=a.plot_bins))
    out("scatter_3d", profile.labelled_scatter_3d(labelled, seg.names, bins=a.plot_bins))
    out("gmm_cluster_profile", profile.cluster_profile(labelled, M.GMM_COL))
    out("gmm_scatter_3d", profile.labelled_scatter_3d(
        labelled, profile.segment_names(labelled, M.GMM_COL), M.GMM_COL, a.plot_bins))
    out("short_strategy", strategy.short_strategy(seg.names))
    out("segment_summary", S.segment_summary(seg))
    out("top_products", profile.top_products(labelled, 5))
    out("strategy_report", strategy.strategy_report(seg.names))
    out("executive_summary", S.executive_summary(seg))

    # segment changes between two periods, by the fitted segments
    if a.period_cut and a.date:
        periods = written_table(history.period_features(
            clean, master, a.period_cut, concentration=a.concentration, cleaned=True), "periods")
        moves = written_table(S.fitted_transitions(seg, periods), "transitions")
        out("transitions", history.transition_counts(moves))
        out("alerts", history.transition_alerts(moves))

    # labelled products (A5) and what was written
    manifest = S.export(seg, os.path.join(a.out, "segments"), a.output_format)
    written["segments"] = os.path.join(a.out, "segments")
    n_rows = manifest.agg(F.max("n_rows")).first()[0]
    summary = {"recommended_model": seg.recommended, "k_kmeans": seg.k, "k_gmm": seg.gmm_k,
               "products": n_rows, "outputs": written}
    print(json.dumps(summary))
    seg.release()
    remove_scratch(spark)
    return summary
