"""Describe, median, correlation, histogram, scatter pairs.

Each statistic table is one aggregation over the feature table, folded
into long form (feature, ...) so that results are numeric rows, not
printed strings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import ALL_FEATURES
from ..functions.columns import nonneg_round
from .quantiles import exact_quantiles


def _long_form(df: DataFrame, structs: list[Column]) -> DataFrame:
    return df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def _long_form_row(one: DataFrame, structs: list[Column]) -> DataFrame:
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def describe(features: DataFrame, cols: Sequence[str] = ALL_FEATURES, median: bool = False,
             exact_median: bool = True, decimals: int = 6) -> DataFrame:
    """D5 (and D6 with ``median=True``): (feature, n, mean, stddev, min,
    max[, median]) per feature in one pass.

    The exact median comes from cumulative value counts (no one-task map);
    ``exact_median=False`` uses ``percentile_approx`` (fixed-size sketch)."""
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        fields = [
            F.lit(c).alias("feature"),
            F.count(x).alias("n"),
            nonneg_round(F.avg(x), decimals).alias("mean"),
            nonneg_round(F.stddev_samp(x), decimals).alias("stddev"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        ]
        if median and not exact_median:
            m = F.percentile_approx(x, 0.5, 100000).cast("double")
            fields.append(nonneg_round(m, decimals).alias("median"))
        structs.append(F.struct(*fields))
    out = _long_form(features, structs)
    if median and exact_median:
        q = exact_quantiles(features, cols, [0.5])
        out = out.join(q.select("feature", nonneg_round("q0", decimals).alias("median")), "feature", "left")
    return out


def correlation(features: DataFrame, cols: Sequence[str] = ALL_FEATURES,
                decimals: int = 6) -> DataFrame:
    """Pearson correlation for every ordered pair, long form."""
    names = list(cols)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    # each unordered pair once, mirrored afterwards
    one = features.agg(*[F.corr(F.col(names[i]).cast("double"), F.col(names[j]).cast("double"))
                         .alias(f"c{i}_{j}") for i, j in pairs])
    return _long_form_row(one, [F.struct(
        F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
        nonneg_round(f"c{min(i, j)}_{max(i, j)}", decimals).alias("corr"))
        for i, a in enumerate(names) for j, b in enumerate(names)])


def histogram(features: DataFrame, cols: Sequence[str] = ALL_FEATURES, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, every bin
    listed (zero counts included).  A constant feature uses
    [x - 0.5, x + 0.5] like numpy.

    The range is a scalar subquery; values are binned in one projection
    and counted by (feature, bin) with map-side partial counts, so only
    <= features x bins rows are shuffled."""
    ranges = features.agg(*[F.struct(F.min(c).cast("double").alias("lo"),
                                     F.max(c).cast("double").alias("hi")).alias(c) for c in cols])
    rng = ranges.select(F.struct(*cols).alias("s")).scalar()
    withr = features.select(*cols, rng.alias("_rng"))
    long = withr.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"),
                 F.col("_rng")[c]["lo"].alias("lo"), F.col("_rng")[c]["hi"].alias("hi"))
        for c in cols])).alias("r")).select("r.*")
    lo = F.when(F.col("hi") == F.col("lo"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    hi = F.when(F.col("hi") == F.col("lo"), F.col("hi") + 0.5).otherwise(F.col("hi"))
    binned = (long.filter(F.col("x").isNotNull())
              .select("feature", F.least(F.floor((F.col("x") - lo) * (F.lit(float(bins)) / (hi - lo))),
                                         F.lit(bins - 1)).cast("int").alias("bin")))
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    # the full grid of bins: features x bins rows, derived from the range row
    grid = ranges.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c)["lo"].alias("lo"), F.col(c)["hi"].alias("hi"))
        for c in cols])).alias("r")).select("r.*").select(
            "feature", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    glo = F.when(F.col("hi") == F.col("lo"), F.col("lo") - 0.5).otherwise(F.col("lo"))
    ghi = F.when(F.col("hi") == F.col("lo"), F.col("hi") + 0.5).otherwise(F.col("hi"))
    width = (ghi - glo) / F.lit(float(bins))
    grid = grid.select("feature", "bin",
                       (glo + F.col("bin") * width).alias("bin_lower"),
                       F.when(F.col("bin") == bins - 1, ghi).otherwise(glo + (F.col("bin") + 1) * width)
                       .alias("bin_upper"))
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin", F.round("bin_lower", 6).alias("bin_lower"),
                    F.round("bin_upper", 6).alias("bin_upper"),
                    F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("n")))


DEFAULT_PAIRS = (("volume", "order_frequency"), ("order_frequency", "concentration"))


def scatter_pairs(features: DataFrame, pairs: Sequence[tuple[str, str]] = DEFAULT_PAIRS,
                  bins: int | None = None) -> DataFrame:
    """The table behind a scatter plot: distinct (x, y) points and how
    many products sit on each, per feature pair.  ``bins`` bounds the table
    to bins x bins rows per pair: points become bin centers."""
    long = features.select(F.explode(F.array(*[
        F.struct(F.lit(f"{a}:{b}").alias("pair"), F.col(a).cast("double").alias("x"),
                 F.col(b).cast("double").alias("y")) for a, b in pairs])).alias("r")).select("r.*")
    from .profile import _binned
    return _binned(long, ["pair"], ["x", "y"], bins).groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("n"))
