"""Every registered query with an oracle equals DuckDB on sf0.001."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], ORACLE[name], SF)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["product_id", "product_name", "volume", "order_frequency", "unique_customers",
                          "concentration", "cluster_kmeans", "cluster_gmm", "segment"]


def test_every_query_has_unique_columns_and_rows(spark):
    """The driver sorts columns by name before hashing: names must be
    unique; rows-only (model) queries must still return rows."""
    qs = entry.queries()
    for name in sorted(set(qs) - set(ORACLE)):
        df = qs[name](spark, SF)
        assert len(set(df.columns)) == len(df.columns), name
        assert df.count() > 0, name
