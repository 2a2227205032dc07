"""Loading the driver tables and binding them to the transaction roles.

The reference reads two CSV files: a product master and a transaction
log with an id, a product, a customer and a week.  The test tables are a
TPC-H style star schema, so the transaction log is ``lineitem`` joined to
``orders`` (for the customer) and the master is ``part``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import week_key

# Role -> source column for the driver tables (A4).  ``line`` is kept so
# that two lines of one order for one part stay two rows through dedup.
TPCH_TRANSACTION_ROLES = {
    "id": "l_orderkey",
    "line": "l_linenumber",
    "date": "l_shipdate",
    "product_id": "l_partkey",
    "customer_id": "o_custkey",
}

TRANSACTION_COLUMNS = ("id", "line", "date", "week", "product_id", "customer_id")

# Schema metadata marking a column computed from another one (the ISO week
# of the date): a whole-row dedup may drop it before shuffling and
# re-derive it afterwards without changing the result.
DERIVED_WEEK = {"skumix.derived": "iso_week_of_date"}


def derived_week(df: DataFrame) -> str | None:
    """Name of a week column tagged as derived from ``date`` (if both exist)."""
    for f in df.schema.fields:
        if (f.metadata or {}).get("skumix.derived") == "iso_week_of_date" and "date" in df.columns:
            return f.name
    return None


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bind_roles(df: DataFrame, roles: dict[str, str], optional: tuple[str, ...] = ("quantity",),
               keep_others: bool = False) -> DataFrame:
    """A4: rename source columns to roles by an explicit name map.

    Required roles must be present; optional roles (quantity) are kept
    only when mapped and present.  Never binds by position.  The date
    role, when given, is cast to a date and its ISO week key derived; if
    the source holds more than a date (a time of day, text), it is kept as
    ``date_source``, so that two transactions of one day stay two rows
    through a whole-row deduplication.  A ``week`` role takes an existing
    week column as is.  ``keep_others`` carries every unmapped source
    column along unchanged; one that is named like a role or a derived
    column becomes ``source_<name>`` (with further underscores if need be).
    """
    required = [r for r in ("id", "product_id", "customer_id") if r not in roles]
    if required:
        raise ValueError(f"missing required roles: {required}")
    cols: list[Column] = []
    for role, source in roles.items():
        if role in optional and source not in df.columns:
            continue
        c = F.col(source)
        if role == "date":
            cols.append(c.cast("date").alias("date"))
            if df.schema[source].dataType.simpleString() != "date":
                cols.append(c.alias("date_source"))
            if "week" not in roles:
                cols.append(week_key(c).alias("week", metadata=DERIVED_WEEK))
        else:
            cols.append(c.alias(role))
    if keep_others:
        mapped = set(roles.values())
        taken = {r.lower() for r in roles} | ({"date", "week", "date_source"} if "date" in roles else set())
        others = [c for c in df.columns if c not in mapped]
        free = {c.lower() for c in others} | taken
        for c in others:
            name = c
            if c.lower() in taken:  # a lost column would make different rows equal
                name = f"source_{c}"
                while name.lower() in free:
                    name += "_"
                free.add(name.lower())
            cols.append(F.col(f"`{c}`").alias(name))
    return df.select(*cols)


# Lines of the transaction log that one task joins, deduplicates and groups,
# and from how many such tasks on the log is dealt out by that number.
LINES_PER_TASK = 250_000
DEALT_FROM_TASKS = 8


def transactions(spark: SparkSession, sf_dir: str, lines_per_task: int = LINES_PER_TASK) -> DataFrame:
    """Transaction log = lineitem ⨝ orders, bound to roles.

    Only the five needed columns are read (ReadSchema is pruned), and
    the join is a plain equi-join: AQE picks broadcast or sort-merge from
    runtime sizes.  A log of more than a few tasks' lines is dealt out by
    order with ``lines_per_task`` lines a task (the count is read from the
    files' footers).  The sorts of the join, the whole-row dedup and the
    partial roll-up run in that one stage and hold every line of the task;
    partitions by bytes (64 MB compressed, millions of lines) made them
    grow with the table.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    tasks = math.ceil(li.count() / lines_per_task)
    if tasks > DEALT_FROM_TASKS:
        li, od = li.repartition(tasks, "l_orderkey"), od.repartition(tasks, "o_orderkey")
    joined = li.join(od, li["l_orderkey"] == od["o_orderkey"], "inner")
    # the ship date is a day: its type may be a timestamp at midnight, which adds nothing
    joined = joined.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return bind_roles(joined, TPCH_TRANSACTION_ROLES).select(*TRANSACTION_COLUMNS)


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master = part(p_partkey, p_name)."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


# Dirt injection for the cleaning queries.  The driver tables have no
# nulls and no duplicate rows, so nulls and copies are made by arithmetic
# both Spark and the SQL oracle share.  Every source row is kept.
# Fixed values (shared with the oracle SQL):
#   product id null  when (id * 7 + line) % 50 = 0
#   customer id null when (id * 7 + line) % 41 = 0
#   one extra copy of every row with id % 20 = 0
#   master: product id null when p_partkey % 97 = 0,
#           one extra copy of every row with p_partkey % 89 = 0
def _copies(n_copies) -> "Column":
    """Repeat each row ``n_copies`` times in the projection (one scan,
    no self-union)."""
    return F.explode(F.sequence(F.lit(1), n_copies)).alias("_copy")


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    key = F.col("id") * 7 + F.col("line")
    copies = F.when(F.col("id") % 20 == 0, F.lit(2)).otherwise(F.lit(1))
    return tx.select(
        "id", "line", "date", "week",
        F.when(key % 50 == 0, F.lit(None)).otherwise(F.col("product_id")).alias("product_id"),
        F.when(key % 41 == 0, F.lit(None)).otherwise(F.col("customer_id")).alias("customer_id"),
        _copies(copies),
    ).drop("_copy")


def dirty_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = product_master(spark, sf_dir)
    pid = F.col("product_id")
    # the extra copy keeps its original id, the first copy may be nulled
    return (m.select("product_id", "product_name",
                     _copies(F.when(pid % 89 == 0, F.lit(2)).otherwise(F.lit(1))))
            .select(F.when((pid % 97 == 0) & (F.col("_copy") == 1), F.lit(None)).otherwise(pid)
                    .alias("product_id"), "product_name"))
