"""Embedding near-duplicates by cross-polytope hashing.

Each vector is rotated pseudo-randomly (three rounds of random signs and a
fast Hadamard transform) and hashed to the nearest signed axis; a table
joins ``AXES`` such hashes.  A vector lives in one bucket per table and
also probes the next most likely ones.  Vectors that meet in a bucket are
candidates; their cosine is verified in double precision.

Exact copies collapse first (and count with their number).  A pair is
counted only in the first bucket in which it meets, decided from the two
rows alone, so no pair is ever listed or shuffled: a bucket emits a link
count per vector and a spanning forest.  Buckets above ``BLOCK`` rows are
split into blocks and every pair of blocks is a group of its own.

Defined results: vectors that are null, empty, zero or hold null or
non-finite components link with nothing; vectors of different lengths do
not link; repeated rows are copies of one vector; an empty table gives an
empty result; further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_batches, written
from .components import components

THRESHOLD = 0.95  # fixed value: least cosine of a link
TABLES = 6        # hash tables
AXES = 2          # cross-polytope hashes joined in a table
PROBES = 3        # further buckets a vector probes in each table
BLOCK = 2048      # rows compared at once
SEED = 20


def hadamard(x):
    """Fast Hadamard transform of the rows of a float array (width 2^k)."""
    import numpy as np
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / d ** 0.5


def codes(unit, tables: int = TABLES, axes: int = AXES, probes: int = PROBES, seed: int = SEED):
    """(rows, tables, 1 + probes) bucket codes of unit vectors, home first."""
    import numpy as np
    n, dim = unit.shape
    wide = 1 << max(1, (dim - 1).bit_length())
    rng = np.random.default_rng(seed * 1_000_003 + wide)
    signs = rng.choice(np.array([-1.0, 1.0]), size=(tables, axes, 3, wide))
    padded = np.zeros((n, wide))
    padded[:, :dim] = unit
    out = np.zeros((n, tables, 1 + probes), np.int64)
    rows = np.arange(n)
    for t in range(tables):
        best, gains = [], []
        for a in range(axes):
            x = padded
            for r in range(3):
                x = hadamard(x * signs[t, a, r])
            size = np.abs(x)
            top = np.argpartition(-size, min(probes, wide - 1), axis=1)[:, :probes + 1]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
            value = np.take_along_axis(x, top, 1)
            best.append(top * 2 + (value < 0))
            gains.append(np.abs(value[:, :1]) - np.abs(value))
        home = np.zeros(n, np.int64)
        for b in best:
            home = home * (2 * wide) + b[:, 0]
        out[:, t, 0] = home
        # probes: replace one axis by its next choices, least loss first
        loss = np.concatenate([g[:, 1:] for g in gains], axis=1)
        alt = np.concatenate([(b[:, 1:] - b[:, :1]) * (2 * wide) ** (axes - 1 - a)
                              for a, b in enumerate(best)], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        for p in range(probes):
            j = order[:, min(p, order.shape[1] - 1)]
            out[:, t, 1 + p] = home + alt[rows, j]
    return out


def unit_rows(vectors):
    import numpy as np
    v = np.asarray(vectors, np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _emit_codes(batches: Iterator) -> Iterator:
    """(node, n, embedding) -> one row for each bucket the vector is in."""
    import numpy as np
    import pyarrow as pa
    for b in batches:
        lists = b.column("embedding")
        sizes = lists.value_lengths().to_numpy()
        for dim in np.unique(sizes):
            part = b.filter(pa.array(sizes == dim))
            flat = np.asarray(part.column("embedding").flatten(), np.float64).reshape(-1, dim)
            c = codes(unit_rows(flat))
            n, tables, each = c.shape
            rows = np.repeat(np.arange(n), tables * each)
            table = np.tile(np.repeat(np.arange(tables), each), n)
            again = np.zeros(c.shape, bool)  # few dimensions: a probe may be chosen twice
            for p in range(1, each):
                again[..., p] = (c[..., p:p + 1] == c[..., :p]).any(-1)
            once = ~again.reshape(-1)
            rows, table = rows[once], table[once]
            whole = pa.FixedSizeListArray.from_arrays(pa.array(c.reshape(-1)), tables * each)
            whole = whole.cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), dim), pa.int32()), pa.array(table, pa.int32()),
                 pa.array(c.reshape(-1)[once], pa.int64()),
                 *(part.column(k).take(pa.array(rows)) for k in ("node", "n", "embedding")),
                 whole.take(pa.array(rows))],
                ["dim", "tbl", "bucket", "node", "n", "embedding", "codes"])


def _first_meeting(ci, cj, tables: int):
    """(table, bucket) where two rows meet first; ci, cj: (pairs, tables, 1 + probes)."""
    import numpy as np
    n, none = len(ci), np.iinfo(np.int64).max
    table, bucket = np.full(n, -1), np.zeros(n, np.int64)
    for t in range(tables):
        shared = (ci[:, t, :, None] == cj[:, t, None, :]).any(2)   # homes and probes alike
        least = np.where(shared, ci[:, t], none).min(1)
        new = (table < 0) & (least < none)
        table[new], bucket[new] = t, least[new]
    return table, bucket


def _compare(threshold: float):
    """Rows sorted by (dim, tbl, bucket, x, y) -> link counts and forest edges."""

    def group(g):
        import numpy as np
        unit = unit_rows(np.stack(g["embedding"].to_list()))
        code = np.stack(g["codes"].to_list()).reshape(len(g), TABLES, -1)
        node, n, block = g["node"].to_numpy(), g["n"].to_numpy(), g["block"].to_numpy()
        tbl, bucket, x, y = (int(g[k].iloc[0]) for k in ("tbl", "bucket", "x", "y"))
        left, right = np.nonzero(block == x)[0], np.nonzero(block == y)[0]
        counts, pairs = np.zeros(len(g), np.int64), []
        for s in range(0, len(left), 512):
            i, j = np.nonzero(unit[left[s:s + 512]] @ unit[right].T >= threshold)
            i, j = left[s + i], right[j]
            once = node[i] < node[j] if x == y else node[i] != node[j]
            i, j = i[once], j[once]
            for k in range(0, len(i), 100_000):
                a, b = i[k:k + 100_000], j[k:k + 100_000]
                t, at = _first_meeting(code[a], code[b], TABLES)
                here = (t == tbl) & (at == bucket)
                a, b = a[here], b[here]
                np.add.at(counts, a, n[b])
                np.add.at(counts, b, n[a])
                pairs.append((a, b))
        label = np.arange(len(g))
        a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, int)
        b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, int)
        while len(a):  # smallest label of the connected rows
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
        linked, moved = np.nonzero(counts)[0], np.nonzero(label != np.arange(len(g)))[0]
        return ([0] * len(linked) + [1] * len(moved), [*node[linked], *node[moved]],
                [*counts[linked], *node[label[moved]]])

    def run(batches):
        import pandas as pd
        import pyarrow as pa
        key = ["dim", "tbl", "bucket", "x", "y"]
        held = None

        def out(df):
            for _, g in df.groupby(key, sort=False):
                if len(g) > 1:
                    kind, a, b = group(g)
                    if kind:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                            ["kind", "a", "b"])

        for b in batches:
            df = b.to_pandas()
            held = df if held is None else pd.concat([held, df], ignore_index=True)
            if not len(held):
                continue
            last = (held[key] == held[key].iloc[-1]).all(axis=1)
            if not last.all():  # the last group may go on in the next batch
                yield from out(held[~last])
                held = held[last].reset_index(drop=True)
        if held is not None and len(held):
            yield from out(held)

    return run


def _valid(c: str) -> Column:
    v = F.col(c)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) != F.lit(float("inf")).cast("double")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    base = in_batches(vectors).select(F.col(id_col).alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    base = base.withColumn("ok", _valid("embedding"))
    reps = written(base.where("ok").groupBy("embedding")
                   .agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
                   .withColumn("node", F.monotonically_increasing_id()), "embed-reps")
    rows = written(reps.select("node", "n", "embedding").mapInArrow(
        _emit_codes, "dim int, tbl int, bucket long, node long, n long, "
        "embedding array<double>, codes array<bigint>"), "embed-codes")
    sizes = (rows.groupBy("dim", "tbl", "bucket").agg(F.count("*").alias("rows"))
             .where("rows > 1").withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")))
    dealt = (rows.join(sizes, ["dim", "tbl", "bucket"])
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
             .drop("rows", "blocks", "other"))
    key = ["dim", "tbl", "bucket", "x", "y"]
    found = written(dealt.repartition(*key).sortWithinPartitions(*key)
                    .mapInArrow(_compare(threshold), "kind int, a long, b long"), "embed-links")
    links = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("links"))
    roots = components(found.where("kind = 1").select(F.col("a").alias("u"), F.col("b").alias("v")), "embed")
    named = (reps.join(links, reps["node"] == links["a"], "left")
             .join(roots, reps["node"] == roots["node"], "left")
             .select("embedding", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("root", reps["node"]).alias("root")))
    named = written(named, "embed-named")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("embedding", "n_links", "component_id")
    good = base.where("ok").join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = base.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
