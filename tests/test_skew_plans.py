"""Skew: a product holding a third of all rows gives exact results, and
the physical plans keep the shapes that spread hot keys."""

import pandas as pd

from skumix.operators import features as feat
from skumix.operators import profile

TX = "id long, line int, product_id long, customer_id long, week int"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark, n=3000):
    rows = []
    for i in range(n):
        hot = i % 3 == 0                       # product 1 holds a third of all rows
        rows.append((i // 4, i % 4, 1 if hot else 2 + i % 50, (i * 7) % 97, 1))
    rows += rows[:600]                         # a large group of exact copies
    return rows


def test_hot_product_features_exact(spark):
    rows = _skewed(spark)
    got = {r.product_id: r for r in feat.product_features(
        feat.clean_transactions(spark.createDataFrame(rows, TX).repartition(7))).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "line", "product_id", "customer_id", "week"]).drop_duplicates()
    want = pdf.groupby("product_id").agg(volume=("id", "size"), order_frequency=("id", "nunique"),
                                         unique_customers=("customer_id", "nunique"))
    assert len(got) == len(want)
    for pid, w in want.iterrows():
        g = got[pid]
        assert (g.volume, g.order_frequency, g.unique_customers) == (
            w.volume, w.order_frequency, w.unique_customers)


def test_distinct_counts_shuffle_beyond_the_product_key(spark):
    df = feat.product_features(feat.clean_transactions(spark.createDataFrame(_skewed(spark), TX)))
    plan = _plan(df)
    assert "Expand" in plan
    # the distinct values travel with the product key, so one hot product
    # is spread over reducers by its orders and customers
    assert "hashpartitioning(product_id" in plan and ", customer_id" in plan


def test_top_k_limits_rows_before_the_shuffle(spark):
    rows = [(i, f"p{i}", i % 13, i % 5, 1, 1.0, 0 if i % 3 else 1) for i in range(500)]
    lab = spark.createDataFrame(rows, "product_id long, product_name string, volume long, "
                                      "order_frequency long, unique_customers long, concentration double, "
                                      "cluster int")
    plan = _plan(profile.top_products(lab, 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_cluster_profile_exact(spark):
    rows = [(i, "p", i % 17, i % 5, 1, float(i % 3), 0 if i % 3 else 1) for i in range(3000)]
    lab = spark.createDataFrame(rows, "product_id long, product_name string, volume long, "
                                      "order_frequency long, unique_customers long, concentration double, "
                                      "cluster int")
    got = {r.cluster: r for r in profile.cluster_profile(lab).collect()}
    pdf = pd.DataFrame(rows, columns=["product_id", "n", "volume", "f", "u", "c", "cluster"])
    for c, g in pdf.groupby("cluster"):
        assert got[c].products == len(g)
        assert got[c].mean_volume == g.volume.sum() / len(g)


def test_no_query_plan_copies_its_statistics_subqueries(spark):
    """Every registered query keeps a compact plan: statistics subqueries
    are attached once, never copied into pushed-down filters."""
    import re

    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    qs = entry.queries()
    for name in entry.oracle_sql():
        if name in ("x3_stream_transition_alerts", "a1_csv_roundtrip", "a5_export_csv", "a6_export_manifest"):
            continue
        plan = _plan(qs[name](spark, sf))
        subq = len(re.findall(r"Subquery subquery", plan))
        exch = len(re.findall(r"Exchange (hash|Single|range)", plan))
        assert subq <= 10 and exch <= 10, (name, subq, exch)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
