"""Profiling, cleaning and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import week_key
from ..sources.tables import derived_week


def _long_form(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One aggregation producing an array of structs, exploded into rows."""
    return df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("r")).select("r.*")


_TYPE_NAMES = {"bigint": "bigint", "int": "integer", "string": "string", "double": "double",
               "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp without time zone"}


def table_profile(df: DataFrame) -> DataFrame:
    """A2: one row per column: (column_name, ordinal, data_type, n_rows),
    from a single count job."""
    n = F.count(F.lit(1))
    structs = [F.struct(F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                        F.lit(_TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString()))
                        .alias("data_type"),
                        n.alias("n_rows"))
               for i, f in enumerate(df.schema.fields)]
    return _long_form(df, structs)


def preview(df: DataFrame, key: str | list[str], n: int = 5) -> DataFrame:
    """first n rows in key order (a top-n: each task keeps n rows)."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*keys).limit(n)


def column_range(df: DataFrame, column: str) -> DataFrame:
    """A3: min and max of one column."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def null_key_filter(df: DataFrame, key: str = "product_id") -> DataFrame:
    """B1."""
    return df.filter(F.col(key).isNotNull())


def cleaning_audit(df: DataFrame, table: str, key: str = "product_id", copies: str | None = None) -> DataFrame:
    """B2: (table, original, removed, remaining) in one aggregation
    (the reference runs one job per number).  ``copies`` names a column
    that says how many rows a row stands for."""
    n = F.col(copies) if copies else F.lit(1).cast("long")
    none = F.lit(0).cast("long")
    return df.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum(n), none).alias("original"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), n)), none).alias("removed"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), n)), none).alias("remaining"),
    )


def drop_any_null(df: DataFrame) -> DataFrame:
    """Rows with a null in any column are removed."""
    return df.dropna(how="any")


COPIES = "_copies"


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct whole rows with how often each occurs: one grouping that
    serves the audits, the dedup and the roll-up.  Partial aggregation
    collapses copies inside each map task, so a hot group of copies never
    travels whole; a week derived from the date is left out of the shuffle."""
    week = derived_week(df)
    keys = [c for c in df.columns if c != week]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES))
    if week is not None:
        g = g.withColumn(week, week_key(F.col("date")))
    return g.select(*df.columns, COPIES)


def copies_audit(rows: DataFrame) -> DataFrame:
    """B5 over :func:`with_copies`: (rows, distinct_rows, removed)."""
    return rows.agg(
        F.sum(COPIES).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.sum(F.col(COPIES) - 1).alias("removed"),
    )


def duplicate_audit(df: DataFrame) -> DataFrame:
    """(rows, distinct_rows, removed) from one grouping on all columns."""
    return copies_audit(with_copies(df))


def repeated_key_audit(df: DataFrame, key: str = "product_id") -> DataFrame:
    """B5 (master): keys present more than once and the extra rows they
    add to an inner join (the master is not deduplicated)."""
    g = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rep = g.filter(F.col("n") > 1)
    return rep.agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("extra_rows"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """B6."""
    return df.select(column).distinct()


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, ordinal, null_count) for every column, one job."""
    structs = [F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                        F.count_if(F.col(c).isNull()).alias("null_count"))
               for i, c in enumerate(df.columns)]
    return _long_form(df, structs)
