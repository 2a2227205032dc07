"""Silhouette with plain Euclidean distances, estimated from a sample.

The plain distance has no closed form by cluster sums, so the exact value
needs all pairs.  Here a bounded sample of points is compared with every
point: one scan, in which each task sums the distances from the sample
points to the points of each cluster, and one small aggregate.  The mean
over the sample estimates the silhouette; its standard error (with the
correction for a finite table) says how far off it may be.  A sample as
large as the table gives the exact value, with a standard error of 0."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import PRODUCT_ID
from .assign import ZCOLS

SAMPLE = 1000          # points of the sample
MAX_SAMPLE = 20_000    # bound of the sample: it travels with every task
BLOCK_PAIRS = 2_000_000  # distances held at once


def sample_rows(df: DataFrame, sample: int, seed: int, zcols: Sequence[str], label: str,
                id_col: str) -> list:
    """The ``sample`` rows of least md5(id:seed): the same rows wherever
    and however the table is stored."""
    if not 0 < sample <= MAX_SAMPLE:
        raise ValueError(f"a sample has 1 to {MAX_SAMPLE} points, not {sample}")
    order = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))
    return (df.orderBy(order, id_col, *zcols).limit(sample)
            .select(F.col(label).alias("label"), *zcols).collect())


def _distance_sums(points: DataFrame, rows: list, zcols: Sequence[str]) -> DataFrame:
    """(i, own, cluster, s, n): summed distances from sample point i to the
    ``n`` points of each cluster, one row per task, point and cluster."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        sample = np.array([r[1:] for r in rows], float)
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        step = max(1, BLOCK_PAIRS // len(sample))
        for b in batches:
            labels = b.column(0).to_numpy()
            x = np.column_stack([b.column(1 + j).to_numpy() for j in range(len(zcols))])
            for c in np.unique(labels).tolist():
                own = x[labels == c]
                counts[c] = counts.get(c, 0) + len(own)
                total = sums.setdefault(c, np.zeros(len(sample)))
                for i in range(0, len(own), step):
                    part = own[i:i + step]
                    square = np.zeros((len(sample), len(part)))
                    for j in range(x.shape[1]):
                        apart = sample[:, j, None] - part[None, :, j]
                        square += apart * apart
                    total += np.sqrt(square).sum(1)
        for c, s in sums.items():
            m = len(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(m), pa.int32()), pa.array([int(r[0]) for r in rows], pa.int32()),
                 pa.array([c] * m, pa.int32()), pa.array(s), pa.array([counts[c]] * m, pa.int64())],
                ["i", "own", "cluster", "s", "n"])

    return points.mapInArrow(run, "i int, own int, cluster int, s double, n long")


def silhouette_sampled(df: DataFrame, zcols: Sequence[str] = ZCOLS, label: str = "cluster",
                       sample: int = SAMPLE, seed: int = 42, id_col: str = PRODUCT_ID,
                       decimals: int | None = 6) -> DataFrame:
    """One row: silhouette, standard_error, sampled, points.

    A point alone in its cluster scores 0; null with fewer than two
    clusters.  Rows without a label or a coordinate are left out."""
    complete = df.select(id_col, F.col(label).cast("int").alias("_c"),
                         *[F.col(c).cast("double").alias(c) for c in zcols]).dropna(subset=["_c", *zcols])
    rows = sample_rows(complete, sample, seed, zcols, "_c", id_col)
    if not rows:
        return df.sparkSession.createDataFrame([(None, None, 0, 0)], "silhouette double, standard_error double, "
                                               "sampled long, points long")
    by = (_distance_sums(complete.select("_c", *zcols), rows, zcols)
          .groupBy("i", "own", "cluster").agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    mine = F.col("own") == F.col("cluster")
    each = by.groupBy("i").agg(
        F.max(F.when(mine & (F.col("n") > 1), F.col("s") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("s") / F.col("n"))).alias("b"), F.sum("n").alias("points"))
    s = (F.when(F.col("a").isNull(), 0.0)
         .when(F.col("a") < F.col("b"), 1.0 - F.col("a") / F.col("b"))
         .when(F.col("a") > F.col("b"), F.col("b") / F.col("a") - 1.0).otherwise(0.0))
    one = each.select(F.when(F.col("b").isNotNull(), s).alias("s"), "points").agg(
        F.avg("s").alias("mean"), F.stddev_samp("s").alias("dev"), F.count("*").alias("sampled"),
        F.max("points").alias("points"))
    error = F.coalesce(F.col("dev"), F.lit(0.0)) * F.sqrt(
        (1.0 - F.col("sampled") / F.col("points")) / F.col("sampled"))
    number = lambda c: (F.round(c, decimals) + F.lit(0.0)) if decimals is not None else c
    return one.select(number(F.col("mean")).alias("silhouette"),
                      F.when(F.col("mean").isNotNull(), number(error)).alias("standard_error"), "sampled", "points")
