"""CSV scan, CSV sink and the sink manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, multi_line: bool = False) -> DataFrame:
    """A1: header CSV.  An explicit schema avoids the inference pass (a
    full extra scan); ``infer=True`` reproduces the reference's read.
    Quotes are doubled inside quoted values.  ``multi_line`` reads values
    with line breaks, at the price of one task per file."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        (writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        writer.format(fmt).save(path)


def write_csv(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """A5: write every row, no index column, one file per task.

    Written by the executors in parallel (no single-file coalesce, which
    would funnel the table through one task).  Values with commas, quotes,
    outer blanks or line breaks are quoted and read back unchanged (line
    breaks with ``read_csv(..., multi_line=True)``)."""
    _write(df, path, fmt)
    return path


def write_counted(df: DataFrame, path: str, fmt: str = "csv") -> DataFrame:
    """A5 + A6 in one pass: write, and return the manifest (column_name,
    ordinal, n_rows) with the rows counted while they were written."""
    seen = Observation()
    _write(df.observe(seen, F.count(F.lit(1)).alias("n")), path, fmt)
    n = seen.get["n"]
    return df.sparkSession.createDataFrame([(c, i + 1, n) for i, c in enumerate(df.columns)],
                                           "column_name string, ordinal int, n_rows long")


def write_manifest(spark: SparkSession, path: str, fmt: str = "csv",
                   schema: StructType | str | None = None) -> DataFrame:
    """Rows written and the column list, read back from the sink.

    One row per column: (column_name, ordinal, n_rows)."""
    if fmt == "csv":
        written = read_csv(spark, path, schema=schema, multi_line=True)
    else:
        written = spark.read.format(fmt).load(path)
    n = written.agg(F.count(F.lit(1)).alias("n")).scalar()
    cols = [F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"))
            for i, c in enumerate(written.columns)]
    return (written.sparkSession.range(1)
            .select(F.explode(F.array(*cols)).alias("c"))
            .select("c.column_name", "c.ordinal", n.alias("n_rows")))
