"""State that new rows merge into, so that history is not read again.

- :func:`moment_state`: counts, means and co-moments by part (a period, a
  file); describe, correlation and scaling of any parts follow from their
  merged state (D5, D7, G2, G3).
- :func:`quantile_sketches`: mergeable KLL sketches by group and feature with
  a stated rank error, an opt-in beside the exact quantiles (D6, D11, E5).
- :class:`RowStore`: rows kept once, in hash buckets; an arriving file is
  compared with the buckets it touches only (B4, B5).
- :class:`FeatureStore`: per part the distinct orders and customers of each
  product, exactly or as sketches; the roll-up over all parts (D2-D4) reads
  that state, not the transactions.

A part or file that arrives again replaces what it had left before, so a
repeated run changes nothing."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ALL_FEATURES, CONCENTRATION, CUSTOMERS, FREQUENCY, PRODUCT_ID, VOLUME
from ..functions.columns import concentration_ratio
from .features import clean_transactions

PART = "part"


# ---- co-moments (D5, D7, G2, G3) ----------------------------------------------------

def moment_state(df: DataFrame, cols: Sequence[str] = ALL_FEATURES, by: str | Column = PART) -> DataFrame:
    """(part, a, b, n, mean_a, mean_b, c, least, most) for every pair of
    columns a, b (a not after b) over the rows that have both: ``c`` is the
    sum of (a - mean_a)(b - mean_b).  One grouped scan; the sums are taken
    about the running means, so large values lose nothing."""
    part = F.col(by) if isinstance(by, str) else by
    x = {c: F.col(c).cast("double") for c in cols}
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            both = x[a].isNotNull() & x[b].isNotNull()
            u, v, k = F.when(both, x[a]), F.when(both, x[b]), f"{len(pairs)}"
            aggs += [F.count(u).alias(f"n{k}"), F.avg(u).alias(f"u{k}"), F.avg(v).alias(f"v{k}"),
                     F.covar_pop(u, v).alias(f"c{k}"), F.min(u).alias(f"lo{k}"), F.max(u).alias(f"hi{k}")]
            pairs.append(F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"n{k}").alias("n"), F.col(f"u{k}").alias("mean_a"),
                F.col(f"v{k}").alias("mean_b"), (F.col(f"c{k}") * F.col(f"n{k}")).alias("c"),
                F.col(f"lo{k}").alias("least"), F.col(f"hi{k}").alias("most")))
    return (df.groupBy(part.alias(PART)).agg(*aggs)
            .select(PART, F.explode(F.array(*pairs)).alias("r")).select(PART, "r.*"))


def merged_moments(state: DataFrame) -> DataFrame:
    """The state of all given parts as one part: co-moments add up with what
    the parts' means differ from the common mean."""
    n = F.col("n").cast("double")
    means = state.groupBy("a", "b").agg(
        F.sum("n").alias("all"), F.try_divide(F.sum(n * F.col("mean_a")), F.sum(n)).alias("ma"),
        F.try_divide(F.sum(n * F.col("mean_b")), F.sum(n)).alias("mb"))
    apart = n * (F.col("mean_a") - F.col("ma")) * (F.col("mean_b") - F.col("mb"))
    # a row for each pair of columns: a bounded broadcast, the parts stay where they are
    return (state.join(F.broadcast(means), ["a", "b"]).groupBy("a", "b").agg(
        F.max("all").alias("n"), F.max("ma").alias("mean_a"), F.max("mb").alias("mean_b"),
        F.sum(F.coalesce(F.col("c") + apart, F.lit(0.0))).alias("c"),
        F.min("least").alias("least"), F.max("most").alias("most")))


def describe_merged(merged: DataFrame, decimals: int | None = 6) -> DataFrame:
    """(feature, n, mean, stddev, min, max) as :func:`.stats.describe`."""
    r = (lambda c: F.round(c, decimals) + F.lit(0.0)) if decimals is not None else (lambda c: c)
    return merged.where("a = b").select(
        F.col("a").alias("feature"), "n", r(F.col("mean_a")).alias("mean"),
        r(F.when(F.col("n") > 1, F.sqrt(F.col("c") / (F.col("n") - 1)))).alias("stddev"),
        F.col("least").alias("min"), F.col("most").alias("max"))


def correlation_merged(merged: DataFrame, decimals: int | None = 6) -> DataFrame:
    """(feature_a, feature_b, corr), both orders, as :func:`.stats.correlation`.
    The spreads are those of the pair's own rows if no value is missing."""
    # a row for each pair of columns: bounded, whatever the data
    rows = merged.agg(F.collect_list(F.struct("a", "b", "c")).alias("r"))
    spread = F.map_from_entries(F.transform(F.filter("r", lambda x: x["a"] == x["b"]),
                                            lambda x: F.struct(x["a"], x["c"])))
    one = (rows.select(spread.alias("s"), F.explode("r").alias("x"))
           .select("x.*", F.col("s")[F.col("x.a")].alias("sa"), F.col("s")[F.col("x.b")].alias("sb")))
    corr = F.when((F.col("sa") > 0) & (F.col("sb") > 0), F.col("c") / F.sqrt(F.col("sa") * F.col("sb")))
    as_is, turned = (F.struct(F.col(x).alias("feature_a"), F.col(y).alias("feature_b")) for x, y in ("ab", "ba"))
    both = F.when(F.col("a") == F.col("b"), F.array(as_is)).otherwise(F.array(as_is, turned))
    return one.select(F.explode(both).alias("p"), (
        F.round(corr, decimals) + F.lit(0.0) if decimals is not None else corr).alias("corr")).select("p.*", "corr")


def scale_merged(merged: DataFrame, ddof: int = 1) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation per feature (a few numbers) for scaling."""
    return {r["a"]: (r["mean_a"], (r["c"] / (r["n"] - ddof)) ** 0.5 if r["n"] > ddof else 0.0)
            for r in merged.where("a = b").collect()}


# ---- quantile sketches (D6, D11, E5) ---------------------------------------------------

SKETCH_K = 400  # size of a sketch


def rank_error(k: int = SKETCH_K) -> float:
    """Rank error that sketches of size k are held to by the query and the
    tests: 1.03 % at 400, somewhat above what is published for them."""
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """(by..., feature, sketch): one pass, one row per group and task shuffled."""
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols])).alias("r"))
    return (long.select(*by, "r.*").where("x IS NOT NULL").groupBy(*by, "feature")
            .agg(F.kll_sketch_agg_double("x", k).alias("sketch")))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the same feature (and ``by``) as one."""
    return sketches.groupBy(*by, "feature").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n, q0, q1, ...): a value of the column at each rank,
    within :func:`rank_error`."""
    return sketches.select(*by, "feature", F.kll_sketch_get_n_double("sketch").alias("n"), *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probabilities)])


# ---- rows kept once (B4, B5) -------------------------------------------------------------

def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class RowStore:
    """Distinct rows under ``path``/rows/arrival=<name>/bucket=<n>, and what
    each arrival held under ``path``/audit/arrival=<name>."""

    def __init__(self, spark: SparkSession, path: str, schema, buckets: int = 64):
        self.spark, self.schema, self.buckets = spark, schema, buckets
        self.root, self.audits = os.path.join(path, "rows"), os.path.join(path, "audit")

    def _read(self) -> DataFrame:
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        if not _exists(self.spark, self.root):
            return self.spark.createDataFrame([], f"{kinds}, _arrival string, _bucket int")
        return self.spark.read.schema(f"{kinds}, _arrival string, _bucket int").parquet(self.root)

    def rows(self) -> DataFrame:
        return self._read().select(*[f"`{f.name}`" for f in self.schema.fields])

    def add(self, arrival: DataFrame, name: str) -> None:
        """Keep the rows of an arrival that no other arrival has brought.

        One grouping of the arrival's rows and of those kept in the buckets
        that they fall into: copies inside a task meet before the shuffle,
        nulls are equal, and neither side is sorted or shuffled again."""
        cols = [F.col(f"`{f.name}`") for f in self.schema.fields]
        own = arrival.withColumn("_bucket", F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int")).persist()
        try:
            seen = own.agg(F.collect_set("_bucket").alias("b"), F.count(F.lit(1)).alias("n")).first()
            other = self._read().where(F.col("_bucket").isin(*seen["b"]) if seen["b"] else F.lit(False)).where(
                F.col("_arrival") != name)
            both = own.select(*cols, "_bucket", F.lit(False).alias("_kept")).unionAll(
                other.select(*cols, "_bucket", F.lit(True).alias("_kept")))
            new = (both.groupBy(*cols, "_bucket").agg(F.max("_kept").alias("_kept")).where(~F.col("_kept")).drop("_kept"))
            # rows are ready before the folder they replace goes: an arrival never reads its own
            new.write.mode("overwrite").partitionBy("_bucket").parquet(os.path.join(self.root, f"_arrival={name}"))
            self.spark.createDataFrame([(int(seen["n"]),)], "n long").coalesce(1).write.mode("overwrite").parquet(
                os.path.join(self.audits, f"_arrival={name}"))
        finally:
            own.unpersist()

    def audit(self) -> DataFrame:
        """(rows, distinct_rows, removed) over all arrivals."""
        arrived = (self.spark.read.schema("n long, _arrival string").parquet(self.audits)
                   if _exists(self.spark, self.audits) else self.spark.createDataFrame([], "n long"))
        kept = self._read().agg(F.count(F.lit(1)).alias("distinct_rows"))
        rows = arrived.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        return rows.select("rows", kept.scalar().alias("distinct_rows")).select(
            "rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows")).alias("removed"))


# ---- distinct counts by part (D2-D4) ------------------------------------------------------

class FeatureStore:
    """Per part (a week) and product: rows, and the distinct orders and
    customers, as values (exact) or sketches of fixed size.  A row belongs to
    one part, so rows add up; orders and customers of several parts meet."""

    def __init__(self, spark: SparkSession, path: str, exact: bool = True, lg_k: int = 12):
        self.spark, self.exact, self.lg_k = spark, exact, lg_k
        self.root = os.path.join(path, "exact" if exact else "sketches")

    def add(self, tx: DataFrame, part: str = "week") -> None:
        """Take in (or replace) all parts that ``tx`` has rows of; a part
        comes whole."""
        clean = clean_transactions(tx).withColumn("_part", F.col(part))
        if self.exact:
            each = clean.select("_part", PRODUCT_ID, F.explode(F.array(
                F.struct(F.lit(VOLUME).alias("kind"), F.lit(None).cast("long").alias("value")),
                F.struct(F.lit(FREQUENCY).alias("kind"), F.col("id").alias("value")),
                F.struct(F.lit(CUSTOMERS).alias("kind"), F.col("customer_id").alias("value")))).alias("r"))
            state = (each.select("_part", PRODUCT_ID, "r.*").where(F.col("value").isNotNull() | (F.col("kind") == VOLUME))
                     .groupBy("_part", PRODUCT_ID, "kind", "value").agg(F.count(F.lit(1)).alias("n")))
        else:
            state = clean.groupBy("_part", PRODUCT_ID).agg(
                F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("id", self.lg_k).alias("orders"),
                F.hll_sketch_agg("customer_id", self.lg_k).alias("customers"))
        (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(self.root))

    def features(self, parts: Sequence | None = None) -> DataFrame:
        """(product, volume, order frequency, customers, concentration) over
        all parts, or the given ones."""
        state = self.spark.read.parquet(self.root)
        if parts is not None:
            state = state.where(F.col("_part").isin(*parts))
        if self.exact:
            once = state.groupBy(PRODUCT_ID, "kind", "value").agg(F.sum("n").alias("n"))
            out = once.groupBy(PRODUCT_ID).agg(
                F.sum(F.when(F.col("kind") == VOLUME, F.col("n"))).alias(VOLUME),
                *[F.count(F.when(F.col("kind") == c, 1)).alias(c) for c in (FREQUENCY, CUSTOMERS)])
        else:
            out = state.groupBy(PRODUCT_ID).agg(
                F.sum("n").alias(VOLUME), F.hll_sketch_estimate(F.hll_union_agg("orders")).alias(FREQUENCY),
                F.hll_sketch_estimate(F.hll_union_agg("customers")).alias(CUSTOMERS))
        return out.withColumn(CONCENTRATION, concentration_ratio(F.col(VOLUME), F.col(CUSTOMERS)))
