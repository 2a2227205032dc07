"""Fixtures of FIXTURES.md §4: nulls, duplicates, zero customers,
rounding, the two concentration formulas, orphans, repeated keys."""

from pyspark.sql import functions as F

from skumix.operators import features as feat
from skumix.operators import quality
from skumix.functions.columns import concentration_ratio, smoothed_concentration

TX = "id long, line int, product_id long, customer_id long, week int"


def test_null_keys_filter_vs_any_null(spark):
    rows = [(1, 1, 10, 100, 1), (2, 1, None, 100, 1), (3, 1, 10, None, 1), (4, 1, None, None, 1)]
    df = spark.createDataFrame(rows, TX)
    b1 = quality.null_key_filter(df)
    b3 = quality.drop_any_null(df)
    assert b1.count() == 2 and b3.count() == 1
    a = quality.cleaning_audit(df, "transactions").first()
    assert (a.original, a.removed, a.remaining) == (4, 2, 2)
    assert a.removed + a.remaining == a.original


def test_exact_duplicates(spark):
    rows = [(1, 1, 10, 100, 1)] * 3 + [(1, 2, 10, 100, 1)]
    df = spark.createDataFrame(rows, TX)
    d = feat.clean_transactions(df)
    assert d.count() == 2
    audit = quality.duplicate_audit(df).first()
    assert (audit.rows, audit.distinct_rows, audit.removed) == (4, 2, 2)
    f = feat.product_features(d).first()
    assert (f.volume, f.order_frequency, f.unique_customers) == (2, 1, 1)


def test_zero_customers_gives_null_not_error(spark):
    rows = [(1, 1, 10, None, 1), (2, 1, 10, None, 1), (3, 1, 11, 5, 1)]
    f = {r.product_id: r for r in feat.product_features(spark.createDataFrame(rows, TX)).collect()}
    assert f[10].unique_customers == 0 and f[10].concentration is None
    assert f[11].concentration == 1.0


def test_rounding_half_up(spark):
    df = spark.createDataFrame([(23, 40), (41, 40), (51, 40), (87, 40)], "v long, c long")
    got = [r.x for r in df.select(concentration_ratio(F.col("v"), F.col("c")).alias("x")).collect()]
    assert got == [0.58, 1.03, 1.28, 2.18]


def test_two_concentration_formulas(spark):
    df = spark.createDataFrame([(10, 4)], "v long, c long")
    r = df.select(concentration_ratio(F.col("v"), F.col("c")).alias("c3"),
                  smoothed_concentration(F.col("v"), F.col("c")).alias("c4")).first()
    assert (r.c4, r.c3) == (2.0, 2.5)


def test_orphans_dropped_by_inner_join(spark):
    tx = spark.createDataFrame([(1, 1, 10, 100, 1), (2, 1, 99, 100, 1)], TX)
    master = spark.createDataFrame([(10, "a"), (11, "b")], "product_id long, product_name string")
    out = feat.feature_table(tx, master).collect()
    assert [r.product_id for r in out] == [10]


def test_repeated_master_key_fans_out_and_is_reported(spark):
    tx = spark.createDataFrame([(1, 1, 10, 100, 1)], TX)
    master = spark.createDataFrame([(10, "a"), (10, "a2"), (None, "x")], "product_id long, product_name string")
    assert feat.feature_table(tx, master).count() == 2
    a = quality.repeated_key_audit(master).first()
    assert (a.repeated_keys, a.extra_rows) == (1, 1)


def test_null_counts_one_row_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a long, b string")
    got = {r.column_name: r.null_count for r in quality.null_counts(df).collect()}
    assert got == {"a": 1, "b": 2}


def test_role_binding_by_name(spark):
    from skumix.sources.tables import bind_roles
    src = spark.createDataFrame([(7, 3, 9, 1)], "oid long, pid long, cid long, qty long")
    out = bind_roles(src, {"id": "oid", "product_id": "pid", "customer_id": "cid", "quantity": "qty"})
    assert out.columns == ["id", "product_id", "customer_id", "quantity"]
    out2 = bind_roles(src.drop("qty"), {"id": "oid", "product_id": "pid", "customer_id": "cid", "quantity": "qty"})
    assert out2.columns == ["id", "product_id", "customer_id"]


def test_fused_roll_up_equals_two_step(spark):
    rows = [(1, 1, 10, 100, 1)] * 3 + [(1, 2, 10, 100, 1), (2, 1, 10, None, 1), (3, 1, None, 5, 1),
                                        (3, 2, 11, None, 2), (3, 2, 11, None, 2)]
    tx = spark.createDataFrame(rows, TX)
    a = feat.rolled_up_clean(tx)
    b = feat.product_features(feat.clean_transactions(tx))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_approximate_distinct_option_close(spark):
    rows = [(i // 3, i % 3, i % 7, (i * 13) % 401, 1) for i in range(6000)]
    tx = spark.createDataFrame(rows, TX)
    exact = {r.product_id: r for r in feat.product_features(tx).collect()}
    approx = {r.product_id: r for r in feat.product_features(tx, approx_rsd=0.01).collect()}
    for pid, e in exact.items():
        a = approx[pid]
        assert a.volume == e.volume
        assert abs(a.order_frequency - e.order_frequency) <= 0.05 * e.order_frequency
        assert abs(a.unique_customers - e.unique_customers) <= 0.05 * e.unique_customers


def test_csv_inferred_schema_roundtrip(spark, tmp_path):
    from skumix.sources.csv_io import read_csv, write_csv
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", 3.0)], "product_id long, product_name string, c double")
    path = write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, path, infer=True)
    types = dict(back.dtypes)
    assert types["product_id"] in ("int", "bigint") and types["c"] == "double"
    assert sorted(r.product_id for r in back.collect()) == [1, 2]


def test_derived_week_rederived_after_dedup(spark):
    import datetime as dt
    from skumix.sources.tables import bind_roles
    src = spark.createDataFrame(
        [(1, 10, 5, dt.date(2020, 12, 31)), (1, 10, 5, dt.date(2020, 12, 31)), (2, 10, 6, dt.date(2021, 1, 4))],
        "oid long, pid long, cid long, d date")
    tx = bind_roles(src, {"id": "oid", "product_id": "pid", "customer_id": "cid", "date": "d"})
    assert tx.schema["week"].metadata.get("skumix.derived") == "iso_week_of_date"
    out = feat.clean_transactions(tx)
    assert out.columns == tx.columns
    got = sorted((r.id, r.week) for r in out.collect())
    assert got == [(1, 202053), (2, 202101)]   # ISO week-year: 2020-12-31 is week 53 of 2020
    # a week that is not derived from the date stays part of the row identity
    tx2 = bind_roles(src.withColumn("w", F.lit(7)), {"id": "oid", "product_id": "pid", "customer_id": "cid",
                                                      "week": "w"})
    assert feat.clean_transactions(tx2).count() == 2


def test_no_unmapped_column_is_lost_or_shadowed(spark):
    """Columns named like a role or a derived one keep their values under a
    free name, so rows that differ only there stay two rows."""
    from skumix.operators import features as feat
    from skumix.sources import tables
    raw = spark.createDataFrame(
        [(1, 7, 3, "2024-01-02", 1, "a", "x", "k"), (1, 7, 3, "2024-01-02", 2, "a", "x", "k"),
         (1, 7, 3, "2024-01-02", 1, "b", "x", "k"), (1, 7, 3, "2024-01-02", 1, "b", "y", "k")],
        "nr long, sku long, buyer long, day string, id int, week string, source_id string, date_source string")
    bound = tables.bind_roles(raw, {"id": "nr", "product_id": "sku", "customer_id": "buyer", "date": "day"},
                              keep_others=True)
    assert sorted(bound.columns) == sorted(["id", "product_id", "customer_id", "date", "date_source", "week", "source_id_",
                                            "source_week", "source_id", "source_date_source"])
    assert feat.clean_transactions(bound).count() == 4
    assert sorted(r.source_id_ for r in bound.collect()) == [1, 1, 1, 2]


def test_a_task_holds_a_bounded_number_of_lines(spark, tmp_path):
    """The join and the dedup of a log of many tasks are dealt out by lines,
    and the rows are those of the plain join."""
    from skumix.sources import tables
    lines = [(i // 4 if i % 90 else None, i % 4, i % 50 if i % 70 else None, "1996-01-02") for i in range(12_000)]
    orders = [(o, o % 97 if o % 11 else None) for o in range(2_900)] + [(5, 5), (None, 1)]
    (spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, d string")
     .selectExpr("l_orderkey", "l_linenumber", "l_partkey", "CAST(d AS TIMESTAMP) AS l_shipdate")
     .write.parquet(str(tmp_path / "lineitem.parquet")))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    plain = tables.transactions(spark, str(tmp_path))
    dealt = tables.transactions(spark, str(tmp_path), lines_per_task=400)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    held = feat.clean_transactions(dealt).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held <= 2 * 400
    want = {r.product_id: r for r in feat.product_features(feat.clean_transactions(plain)).collect()}
    assert {r.product_id: r for r in feat.product_features(feat.clean_transactions(dealt)).collect()} == want
