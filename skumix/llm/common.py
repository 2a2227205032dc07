"""Shared helpers: tables, written intermediates, column naming, words."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: a word is a run of anything but ASCII white space


# Rows and bytes of an Arrow batch between the JVM and Python.  Spark's own
# defaults hold 10,000 texts at once, several times over.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
           "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m")}


def in_batches(df: DataFrame) -> DataFrame:
    """``df``, with small Arrow batches set for its session unless the
    session has values of its own: memory of a task is bounded by them."""
    conf = df.sparkSession.conf
    for key, (default, ours) in BATCHES.items():
        if conf.get(key, None) == default:
            conf.set(key, ours)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    so that a lost executor re-reads files instead of repeating the work.
    ``session.remove_scratch`` deletes it."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) alone, null text as empty: further columns of the input,
    whatever their names, cannot clash with an operator's own."""
    return in_batches(docs).select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def crc_mod(c: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (the fold rule of the contracts)."""
    return F.crc32(c.cast("string").cast("binary")) % m


def crc_mod_py(doc_id, m: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % m


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    name: str, folds: int = 3, held: int = 1):
    """Training rows of a two-class model: (written table of doc_id, text, y,
    calib; rows of each class among all training labels).

    Labels come only from rows outside the held-out fold.  At most
    ``per_class`` rows of each class are taken (smallest id hash first), so
    the id list that is broadcast is bounded by that parameter; a fifth of
    them (``calib``) is left out of the counts and calibrates the scores.
    A document labelled more than once counts as 1 if any label says so."""
    own = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
           .where(crc_mod(F.col("doc_id"), folds) != held)
           .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
           .select("doc_id", "y", F.xxhash64("doc_id").alias("h")))
    parts = [own.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class) for y in (0, 1)]
    ids = parts[0].unionByName(parts[1]).select(
        "doc_id", "y", (F.pmod("h", F.lit(5)) == 0).alias("calib"))
    totals = {int(r["y"]): int(r["n"]) for r in own.groupBy("y").agg(F.count("*").alias("n")).collect()
              if r["y"] in (0, 1)}
    sample = written(ids_and_text(docs).join(F.broadcast(ids), "doc_id"), name)
    return sample, (totals.get(0, 0), totals.get(1, 0))


def fit_logistic(x, y, weights, ridge: float = 1e-2, steps: int = 60):
    """Coefficients (last: intercept) of a weighted logistic regression by
    damped Newton steps on a few columns.  Driver side, bounded rows."""
    import numpy as np
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weights * (p - y)) + ridge * np.r_[w[:-1], 0]
        h = (a * (weights * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w
