"""Naming rule, strategy joins, top-n ties, box plot, history fixtures."""

import datetime as dt

from skumix.functions.naming import HIGH_CENTRALISED, HIGH_DISPERSED, LOW, MEDIUM
from skumix.operators import history, profile, strategy

LAB = ("product_id long, product_name string, volume long, order_frequency long, unique_customers long, "
       "concentration double, cluster int")


def _lab(spark, rows):
    return spark.createDataFrame(rows, LAB)


def test_name_rule_each_name_and_equality(spark):
    # medians over all 11 products: volume 10.0, frequency 10.0, concentration 2.0
    rows = [
        (1, "a", 20, 20, 1, 3.0, 0), (2, "b", 20, 20, 1, 3.0, 0),     # high, conc above -> centralised
        (3, "c", 20, 20, 1, 1.0, 1), (4, "d", 20, 20, 1, 1.0, 1),     # high, conc below -> dispersed
        (5, "e", 1, 1, 1, 1.0, 2), (6, "f", 1, 1, 1, 1.0, 2),         # both below -> low
    ] + [(7 + i, "g", 10, 10, 1, 2.0, 3) for i in range(5)]          # equal to the medians -> medium
    names = {r.cluster: r.segment for r in profile.segment_names(_lab(spark, rows)).collect()}
    assert names == {0: HIGH_CENTRALISED, 1: HIGH_DISPERSED, 2: LOW, 3: MEDIUM}


def test_shared_name_keeps_both_clusters(spark):
    names = spark.createDataFrame([(0, LOW), (1, LOW)], "cluster int, segment string")
    out = strategy.strategy_lookup(names).collect()
    assert sorted(r.cluster for r in out) == [0, 1]
    assert all(r.storage for r in out)


def test_unknown_segment_keeps_row_with_default(spark):
    names = spark.createDataFrame([(0, "unheard_of"), (1, MEDIUM)], "cluster int, segment string")
    rep = strategy.strategy_report(names).collect()
    unknown = [r for r in rep if r.cluster == 0]
    assert len(unknown) == 1 and unknown[0].value == strategy.UNMAPPED
    assert unknown[0].segment == "UNHEARD_OF"
    known = [r for r in rep if r.cluster == 1]
    assert [r.attribute for r in known] == ["DESCRIPTION", "STORAGE", "REPLENISHMENT", "STOCK LEVEL",
                                           "ROTATION", "KPIS"]
    short = {r.cluster: r.storage for r in strategy.short_strategy(names).collect()}
    assert short[0] == strategy.SHORT["other"][0]


def test_top_ties_lowest_ids(spark):
    rows = [(i, f"p{i}", 50, 5, 1, 1.0, 0) for i in (17, 3, 9, 11, 5, 8, 2)]
    top = profile.top_products(_lab(spark, rows), 5).orderBy("rank").collect()
    assert [r.product_id for r in top] == [2, 3, 5, 8, 9]


def test_name_truncated_to_50(spark):
    rows = [(1, "x" * 80, 5, 5, 1, 1.0, 0)]
    top = profile.top_products(_lab(spark, rows), 5).first()
    assert len(top.product_name) == 50


def test_boxplot_whiskers_are_data_points(spark):
    vols = [1, 2, 3, 4, 5, 6, 7, 8, 100]
    rows = [(i, "p", v, v, 1, 1.0, 0) for i, v in enumerate(vols)]
    b = {r.feature: r for r in profile.boxplot_table(_lab(spark, rows)).collect()}["volume"]
    assert (b.q1, b.median, b.q3) == (3.0, 5.0, 7.0)
    assert (b.whisker_low, b.whisker_high, b.outliers) == (1.0, 8.0, 1)


def test_cluster_bars_zero_filled(spark):
    rows = [(1, "a", 1, 1, 1, 1.0, 0), (2, "b", 1, 1, 1, 1.0, 2)]
    bars = [(r.cluster, r.products) for r in profile.cluster_size_bars(_lab(spark, rows), 4).collect()]
    assert bars == [(0, 1), (1, 0), (2, 1), (3, 0)]


def test_summary_half_up_means(spark):
    # volumes 1 and 2 -> 1.5 ; frequencies 1, 1, 2, 2 (two clusters) ; concentration 1.005 -> 1.01
    rows = [(1, "a", 1, 1, 1, 1.00, 0), (2, "b", 2, 2, 1, 1.01, 0)]
    s = profile.segment_summary(_lab(spark, rows)).first()
    assert (s.mean_volume, s.mean_frequency, s.mean_concentration) == (1.5, 1.5, 1.01)


TX = "id long, line int, date date, week int, product_id long, customer_id long"


def test_short_history(spark):
    d = dt.date(2024, 3, 4)
    rows = [(1, 1, d, 202410, 1, 1), (2, 1, d, 202411, 1, 1)]
    r = history.history_coverage(spark.createDataFrame(rows, TX)).first()
    assert (r.weeks, r.min_weeks, r.sufficient) == (2, 12, False)


def test_two_periods_transitions(spark):
    before = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "product_id long, cluster int")
    after = spark.createDataFrame([(1, 0), (2, 3), (4, 1)], "product_id long, cluster int")
    tr = history.segment_transitions(before, after)
    alerts = {r.product_id: r.change for r in history.transition_alerts(tr).collect()}
    assert alerts == {2: "changed", 3: "vanished", 4: "appeared"}
    counts = {(r.cluster_before, r.cluster_after): r.products for r in history.transition_counts(tr).collect()}
    assert counts[(0, 0)] == 1 and counts[(None, 1)] == 1
