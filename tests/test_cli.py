"""The command-line run over CSV files laid out like the reference's."""

import os

from pyspark.sql import functions as F

from skumix.plans import run
from skumix.sources import tables

SF = "/root/testdata/sf0.001"


def test_cli_end_to_end(spark, tmp_path):
    prod = tables.product_master(spark, SF).select(F.col("product_id").alias("Producto_ID"),
                                                    F.col("product_name").alias("NombreProducto"))
    tx = tables.transactions(spark, SF).select(
        "id", F.col("product_id").alias("Producto_ID"), F.col("customer_id").alias("Cliente_ID"),
        F.col("week").alias("Semana"), F.col("line").alias("Linea"))
    prod.write.option("header", True).csv(str(tmp_path / "products"))
    tx.write.option("header", True).csv(str(tmp_path / "tx"))
    out = tmp_path / "out"
    summary = run.main(["--products", str(tmp_path / "products"), "--transactions", str(tmp_path / "tx"),
                        "--out", str(out), "--k-max", "4", "--max-iter", "20"])
    expected = tables.product_master(spark, SF).count()
    assert summary["products"] == expected
    assert summary["recommended_model"] in ("K-means", "GMM")
    for name in ("features", "kmeans_sweep", "gmm_sweep", "strategy_report", "segments", "cleaning_audit"):
        assert os.path.isdir(out / name), name
    seg = spark.read.option("header", True).csv(str(out / "segments"))
    assert seg.count() == expected
    assert {"cluster_kmeans", "cluster_gmm", "segment"} <= set(seg.columns)


def test_cli_parquet_date_and_approx(spark, tmp_path):
    prod = tables.product_master(spark, SF).select(F.col("product_id").alias("pid"),
                                                    F.col("product_name").alias("pname"))
    tx = tables.transactions(spark, SF).select(
        F.col("id").alias("order_id"), F.col("product_id").alias("pid"), F.col("customer_id").alias("cust"),
        F.col("date").alias("day"), F.col("line"))
    prod.write.parquet(str(tmp_path / "p"))
    tx.write.parquet(str(tmp_path / "t"))
    out = tmp_path / "out"
    summary = run.main(["--products", str(tmp_path / "p"), "--transactions", str(tmp_path / "t"),
                        "--out", str(out), "--input-format", "parquet", "--output-format", "parquet",
                        "--product-id", "pid", "--product-name", "pname", "--id", "order_id",
                        "--customer-id", "cust", "--date", "day", "--approx-distinct", "0.02",
                        "--k-max", "3", "--max-iter", "10"])
    assert summary["products"] == tables.product_master(spark, SF).count()
    weeks = spark.read.parquet(str(out / "weeks"))
    assert weeks.count() > 0 and weeks.columns == ["week"]
