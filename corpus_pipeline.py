"""The corpus pipeline: documents in, packed token sequences out.

``STAGES`` lists (name, function); each function takes (spark, docs,
sf_dir) and returns a DataFrame that ``run`` writes as Parquet and reads
again as the next one's docs.  All but the last return the columns of
documents.  An empty table passes through every stage; null texts count as
empty and are rejected by the first."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skumix.llm import packing, quality_rules, secrets, simhash, toxicity  # noqa: E402
from skumix.llm.common import table, written  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go (models learned from the stage's documents)."""
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (the smallest doc_id)."""
    return simhash.keep_first(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, decoded layers included, are replaced in the texts."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in sequences of at most 1024: the pieces with
    their ids, those of a sequence one after the other."""
    return packing.piece_rows(packing.pack_sequences(docs), with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("toxicity", ordinary),
    ("simhash near-dedup", near_dedup),
    ("secret scans", no_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # toxicity models and packing are not SQL: tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{i}-{name.replace(' ', '-')}")
    return docs
