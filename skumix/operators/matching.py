"""X2 between re-fits: which new segment continues which old one.

Two fits number their segments independently, so a changed number says
nothing.  The products that both label are counted by (old, new) label, one
grouped aggregate; the k x k counts are matched one to one such that as many
products as possible keep their segment, and the new labels take the old
numbers.  A new segment without a counterpart gets a number of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LABELS = 2000  # the counts are matched on the driver: bounded by labels, not products


def label_counts(both: DataFrame, before: str = "cluster_before", after: str = "cluster_after") -> DataFrame:
    """(cluster_before, cluster_after, products); null where a product is absent."""
    return (both.groupBy(F.col(before).cast("int").alias("cluster_before"), F.col(after).cast("int").alias("cluster_after"))
            .agg(F.count(F.lit(1)).alias("products")))


def overlap_counts(both: DataFrame, before: str = "cluster_before", after: str = "cluster_after") -> DataFrame:
    """The counts of the products that have both labels."""
    return label_counts(both, before, after).where("cluster_before IS NOT NULL AND cluster_after IS NOT NULL")


def assignment(gain: Sequence[Sequence[int]]) -> list[int]:
    """Column of every row of a square integer table such that the columns
    differ and the sum is greatest; of equal sums the least list of columns.
    Successive shortest augmenting paths with potentials, k^3 steps."""
    k = len(gain)
    if not k:
        return []
    # a preference below one unit of gain: earlier rows choose first
    base = k + 1
    unit = base ** (k + 1)
    cost = [[j * base ** (k - 1 - i) - int(gain[i][j]) * unit for j in range(k)] for i in range(k)]
    rows, cols, owner, way = [0] * (k + 1), [0] * (k + 1), [0] * (k + 1), [0] * (k + 1)
    for i in range(1, k + 1):
        owner[0], j0 = i, 0
        least, used = [None] * (k + 1), [False] * (k + 1)
        while owner[j0]:
            used[j0] = True
            i0, step, j1 = owner[j0], None, 0
            for j in range(1, k + 1):
                if not used[j]:
                    reduced = cost[i0 - 1][j - 1] - rows[i0] - cols[j]
                    if least[j] is None or reduced < least[j]:
                        least[j], way[j] = reduced, j0
                    if step is None or least[j] < step:
                        step, j1 = least[j], j
            for j in range(k + 1):
                if used[j]:
                    rows[owner[j]] += step
                    cols[j] -= step
                elif least[j] is not None:
                    least[j] -= step
            j0 = j1
        while j0:
            owner[j0], j0 = owner[way[j0]], way[j0]
    out = [0] * k
    for j in range(1, k + 1):
        out[owner[j] - 1] = j - 1
    return out


def match_labels(counts: DataFrame, labels: int | None = None) -> dict[int, int]:
    """New label -> old label, or a number that no old segment has, from
    :func:`label_counts` (labels of products that only one side has count as
    labels, not as overlap).

    ``labels``: number of labels on either side (default: as seen)."""
    rows = counts.limit(MAX_LABELS * MAX_LABELS + 1).collect()
    size = max([labels or 0, *(r[c] + 1 for r in rows for c in ("cluster_before", "cluster_after")
                               if r[c] is not None)], default=0)
    if size > MAX_LABELS:
        raise ValueError(f"{size} labels: segments are matched up to {MAX_LABELS}")
    gain = [[0] * size for _ in range(size)]
    for r in rows:
        if r["cluster_before"] is not None and r["cluster_after"] is not None:
            gain[r["cluster_before"]][r["cluster_after"]] = r["products"]
    mapping = {new: old for old, new in enumerate(assignment(gain)) if gain[old][new]}
    fresh = size
    for new in range(size):
        if new not in mapping:  # no product came from an old segment that is still free
            mapping[new], fresh = fresh, fresh + 1
    return mapping


def relabel(df: DataFrame, mapping: dict[int, int], label: str = "cluster_after") -> DataFrame:
    """``label`` in the numbers of the old segments (at most k literals)."""
    if not mapping:
        return df
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.withColumn(label, F.element_at(pairs, F.col(label).cast("int")))


def matched_transitions(transitions: DataFrame, labels: int | None = None) -> DataFrame:
    """(product, cluster_before, cluster_after) with the new labels matched
    to the old ones: a permuted labelling leaves every product in place."""
    return relabel(transitions, match_labels(label_counts(transitions), labels))


def matched_overlap(transitions: DataFrame, labels: int | None = None) -> DataFrame:
    """The counts, and which pairs of labels are one segment."""
    mapping = match_labels(label_counts(transitions), labels)
    return relabel(overlap_counts(transitions).withColumn("continues", F.col("cluster_after")), mapping, "continues").withColumn(
        "continues", F.col("continues") == F.col("cluster_before"))
