"""Feature vector, standardisation (column and vector forms), audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import MODEL_FEATURES
from ..functions.columns import nonneg_round


def zname(c: str) -> str:
    return f"z_{c}"


def complete_rows(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows the assembler accepts: no null in any model feature (a product
    with zero known customers has a null concentration)."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def assemble(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES, out: str = "features") -> DataFrame:
    """G1: dense vector of the model features (incomplete rows removed
    first; the assembler would raise on them)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(complete_rows(df, cols))


def assemble_audit(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows kept and dropped by :func:`complete_rows`, one job."""
    complete = None
    for c in cols:
        complete = F.col(c).isNotNull() if complete is None else complete & F.col(c).isNotNull()
    return df.agg(F.count_if(complete).alias("kept"), F.count_if(~complete).alias("dropped"))


def standardise(df: DataFrame, cols: Sequence[str] = MODEL_FEATURES, ddof: int = 1,
                stats_from: DataFrame | None = None) -> DataFrame:
    """G2 (ddof=1, sample std) / G2b (ddof=0, population std), column form.

    z = (x - mean) / std, and 0 when std is 0 or undefined.  The means
    and stds are one scalar subquery (a struct), so the table is not
    joined to its own statistics.  ``stats_from`` scales with another
    table's statistics (e.g. a reference period)."""
    src = stats_from if stats_from is not None else df
    std = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = src.agg(F.struct(*[F.struct(F.avg(F.col(c).cast("double")).alias("mean"),
                                     std(F.col(c).cast("double")).alias("std")).alias(c)
                            for c in cols]).alias("s")).scalar()
    # the statistics struct is attached once as a column, so the plan has
    # a single subquery however many times its fields are used
    out = df.withColumn("_zstats", st)
    for c in cols:
        s = F.col("_zstats")[c]
        out = out.withColumn(zname(c), F.when(F.coalesce(s["std"], F.lit(0.0)) == 0, F.lit(0.0))
                             .otherwise((F.col(c).cast("double") - s["mean"]) / s["std"]))
    return out.drop("_zstats")


def fit_vector_scaler(df: DataFrame, input_col: str = "features",
                      output_col: str = "features_scaled") -> StandardScalerModel:
    """G2, vector form (mean 0, sample std 1) as the models consume it."""
    return StandardScaler(inputCol=input_col, outputCol=output_col,
                          withMean=True, withStd=True).fit(df)


def scaling_audit(df: DataFrame, cols: Sequence[str], decimals: int = 6) -> DataFrame:
    """Mean and population std of each scaled column, long form."""
    structs = [F.struct(F.lit(c).alias("feature"),
                        nonneg_round(F.avg(c), decimals).alias("mean"),
                        nonneg_round(F.stddev_pop(c), decimals).alias("std"))
               for c in cols]
    return df.agg(F.array(*structs).alias("a")).select(F.explode("a").alias("r")).select("r.*")
