"""Distance expressions over feature columns (no joins, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(cols: Sequence[Column], center: Sequence[float]) -> Column:
    """Sum of squared coordinate differences, summed left to right."""
    total = None
    for c, v in zip(cols, center):
        d = c - F.lit(float(v))
        term = d * d
        total = term if total is None else total + term
    return total


def nearest_center(cols: Sequence[Column], centers: Sequence[Sequence[float]],
                   decimals: int | None = 9) -> Column:
    """Index of the nearest center; ties go to the lowest index.

    Centers are a handful of literals (k x d numbers), so every row is
    labelled in one codegen'd projection: no cross join with a centers
    table.  Distances are rounded before comparing so that two engines
    summing in a different order still agree.

    The label is declared non-null (-1 would mark a row without
    coordinates, which complete rows never are): a nullable label joined
    to anything makes the optimizer infer ``isnotnull(label)`` and push
    it below the projection, copying the whole distance expression (and
    any scalar subqueries inside it) into a filter."""
    cands = []
    for i, center in enumerate(centers):
        d = squared_distance(cols, center)
        if decimals is not None:
            d = F.round(d, decimals)
        cands.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    return F.coalesce(F.array_min(F.array(*cands))["i"], F.lit(-1))
