"""Exact quantiles by cumulative counts, at any number of distinct values.

Values are grouped with their counts, dealt by range over (group, feature,
value) and written once; a value's rank is the count of the earlier range
parts (one row per part) plus a running count inside its part.  No task
ever holds the value map of a whole group, as a percentile aggregate does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_table


def value_counts(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, x, n, part): distinct non-null values of each column
    as doubles with their counts, in range parts of (feature, x): quantiles
    of the groups and of the whole table (``pooled``) follow from it."""
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols])).alias("r"))
    counts = (long.select(*by, "r.feature", "r.x").where(F.col("x").isNotNull())
              .groupBy(*by, "feature", "x").agg(F.count(F.lit(1)).alias("n")))
    dealt = counts.repartitionByRange(*[F.col(c) for c in ("feature", "x", *by)])
    return written_table(dealt.withColumn("part", F.spark_partition_id()), "value-counts")


def pooled(counts: DataFrame) -> DataFrame:
    """The counts without their groups."""
    return counts.groupBy("feature", "part", "x").agg(F.sum("n").alias("n"))


def quantiles_of(counts: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n, q0, q1, ...): linear interpolation between the two
    nearest ranks, per group of :func:`value_counts`."""
    key = [*by, "feature"]
    parts = counts.groupBy(*key, "part").agg(F.sum("n").alias("m"))
    earlier = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*key, "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("before"),
                         F.sum("m").over(Window.partitionBy(*key)).alias("total"))
    inside = Window.partitionBy(*key, "part").orderBy("x")
    ranked = (counts.withColumn("cum", F.sum("n").over(inside)).join(parts, [*key, "part"])
              .select(*key, "x", "total", (F.col("before") + F.col("cum")).alias("hi"),
                      (F.col("before") + F.col("cum") - F.col("n")).alias("lo")))

    def at(rank):
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col("x")))

    place = [(F.col("total") - 1) * F.lit(float(p)) for p in probabilities]
    found = ranked.groupBy(*key).agg(F.max("total").alias("n"), *[
        a for i, h in enumerate(place) for a in (at(F.floor(h)).alias(f"_lo{i}"), at(F.ceil(h)).alias(f"_hi{i}"))])
    return found.select(*key, "n", *[
        (F.col(f"_lo{i}") + ((F.col("n") - 1) * F.lit(float(p)) - F.floor((F.col("n") - 1) * F.lit(float(p))))
         * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}") for i, p in enumerate(probabilities)])


def exact_quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float],
                    by: Sequence[str] = ()) -> DataFrame:
    return quantiles_of(value_counts(df, cols, by), probabilities, by)
