"""Vector code compression: product quantisation in exact integers.

A vector's components become integers ``floor(4096 x)``, cut into equal
consecutive parts; each part position has a codebook whose entries are moved
by rounds of nearest-entry assignment and componentwise floor means.

Parts of one position are sorted along a Hilbert curve and stored in flat
blocks, so that a block's rows lie close together.  A block keeps the box
(least and greatest component) and the sums of its rows.  In a round the
distances from the box to all entries leave a shortlist: an entry that is
farther from the box's nearest point than some other entry is from its
farthest point can be nearest to no row.  A block with one entry left adds
its sums without a look at its rows; the others evaluate their rows against
the shortlist with an integer kernel.  Codebooks (parts x entries vectors)
are all that travels between rounds; blocks are written once and read again
in each round, so a lost executor costs its tasks only.

The curve only decides which rows share a block, never a result.  Equal
parts are spread over blocks and partitions by their row number.

Defined results: rows whose vector is null or holds a null or non-finite
component are dropped; rows with a null id stay and start a codebook only
after all others; repeated rows are rows of their own; fewer rows than
entries give as many entries as rows; an empty table gives an empty result;
further columns are ignored.  Vectors of different lengths, a length that
the parts do not divide, or components of 16384 and more raise ValueError
(squared distances must fit 64 bits)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, written

SCALE = 4096      # fixed value: steps of a component
PARTS = 8         # fixed value: parts of a vector
ENTRIES = 16      # fixed value: entries of a codebook
ROUNDS = 6        # fixed value: rounds of moving entries
BLOCK = 256       # rows of a block
CURVE_BITS = 62   # bits of a place on the curve
LARGEST = 1 << 26  # components stay below this


@dataclass
class Codebooks:
    """``entries[part]``: integer array (entries, width)."""
    entries: list = field(default_factory=list)

    def sha256(self) -> str:
        """Digest of all components as decimals, by part, entry and position."""
        text = ",".join(str(int(x)) for e in self.entries for row in e for x in row)
        return hashlib.sha256(text.encode()).hexdigest()


def hilbert_places(x, bits: int):
    """Places on the Hilbert curve of the cells ``x`` (rows, axes), each
    coordinate below 2**bits; bits * axes <= 62.  Skilling's transform."""
    import numpy as np
    x = x.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << 1) | ((x[i] >> level) & 1)
    return place


def shortlists(lo, hi, entries):
    """For boxes (rows, width): which entries can be nearest to some point in
    them.  Ties stay, so the lowest index can win them later."""
    import numpy as np
    below, above = lo[:, None, :] - entries, entries - hi[:, None, :]
    near = np.maximum(np.maximum(below, above), 0)
    far = np.maximum(np.abs(below), np.abs(above))
    near, far = (near * near).sum(2), (far * far).sum(2)
    return near <= far.min(1, keepdims=True)


def nearest(rows, entries, among):
    """(index, squared distance) of the nearest of ``entries[among]``, the
    lowest index on ties (``among`` ascends)."""
    import numpy as np
    apart = rows[:, None, :] - entries[among]
    d = (apart * apart).sum(2)
    best = d.argmin(1)
    return among[best], d[np.arange(len(rows)), best]


def _stacked(column, width: int, kind):
    import numpy as np
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _integers(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(row, vec_id, label, v): kept rows with integer components, numbered."""
    x = F.col(f"`{vec_col}`")
    fits = F.forall(x, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    # null components fail the comparison; NaN is greater than infinity in Spark
    scaled = F.transform(x, lambda c: F.floor(F.least(F.greatest(
        c.cast("double") * SCALE, F.lit(-2.0 * LARGEST)), F.lit(2.0 * LARGEST))))
    return (in_batches(vectors).where(x.isNotNull() & fits)
            .select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("vec_id"),
                    F.col(f"`{label_col}`").alias("label"), scaled.alias("v")))


def _spread(rows: DataFrame) -> list:
    """Per position: number of rows, sum, sum of squares, greatest size, and
    the least and greatest length of a vector (equal in all rows)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            v = b.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            if not len(sizes):
                continue
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if sizes.min() != sizes.max():  # reported below; positions have no meaning then
                flat, width = np.zeros(1, np.int64), 1
            else:
                width = int(sizes.max())
            x = flat.reshape(len(flat) // width if width else 0, width) if width else np.zeros((1, 1), np.int64)
            f = x.astype(float)
            size = x.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array([len(sizes)] * size, pa.int64()),
                 pa.array(f.sum(0)), pa.array((f * f).sum(0)), pa.array(np.abs(x).max(0)),
                 pa.array([int(sizes.min())] * size, pa.int32()), pa.array([int(sizes.max())] * size, pa.int32())],
                ["at", "n", "s", "ss", "top", "least", "most"])

    kinds = "at int, n long, s double, ss double, top long, least int, most int"
    return (rows.select("v").mapInArrow(run, kinds).groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
                 F.max("top").alias("top"), F.min("least").alias("least"), F.max("most").alias("most"))
            .orderBy("at").collect())


def _blocks(rows: DataFrame, parts: int, width: int, spread: list, block: int) -> DataFrame:
    """(part, n, lo, hi, sums, ids, v): flat blocks along the Hilbert curve,
    their arrays as little-endian binary columns."""
    import numpy as np
    n = np.array([max(1, r["n"]) for r in spread], float)
    mean = np.array([r["s"] for r in spread]) / n
    dev = np.sqrt(np.maximum(np.array([r["ss"] for r in spread]) / n - mean * mean, 0)) + 1e-9
    bits = max(1, min(8, CURVE_BITS // max(1, width)))
    axes = [np.sort(np.argsort(-dev[p * width:(p + 1) * width], kind="stable")[:CURVE_BITS]) + p * width
            for p in range(parts)]  # of very wide parts the axes of the greatest spread

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        cells = 1 << bits
        for b in batches:
            size = b.num_rows
            v = b.column("v").flatten().to_numpy(zero_copy_only=False).astype("<i4").reshape(size, parts * width)
            for p in range(parts):
                own = v[:, axes[p]]
                cell = np.clip((own - mean[axes[p]]) / dev[axes[p]] / 6 + 0.5, 0, 1 - 1e-9) * cells
                flat = np.ascontiguousarray(v[:, p * width:(p + 1) * width]).tobytes()
                step = 4 * width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * size, pa.int32()), pa.array(hilbert_places(cell.astype(np.int64), bits)),
                     b.column("row"), pa.array([flat[i * step:(i + 1) * step] for i in range(size)], pa.binary())],
                    ["part", "place", "row", "v"])

    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def made(part, ids, v):
            lo, hi, sums = v.min(0), v.max(0), v.sum(0, dtype=np.int64)
            return (part, len(v), lo.tobytes(), hi.tobytes(), sums.tobytes(), ids.tobytes(), v.tobytes())

        def table(out):
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                              ["part", "n", "lo", "hi", "sums", "ids", "v"])

        part, ids, vals = -1, np.zeros(0, "<i8"), np.zeros((0, width), "<i4")
        for b in batches:
            out = []
            of, rows_, v = b.column("part").to_numpy(), b.column("row").to_numpy(), _stacked(b.column("v"), width, "<i4")
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            for s, e in zip(edges, edges[1:]):
                if s == e:
                    continue
                if of[s] != part:
                    if len(ids):
                        out.append(made(part, ids, vals))
                    part, ids, vals = int(of[s]), ids[:0], vals[:0]
                ids, vals = np.r_[ids, rows_[s:e]], np.r_[vals, v[s:e]]
                while len(ids) >= block:
                    out.append(made(part, ids[:block], vals[:block]))
                    ids, vals = ids[block:], vals[block:]
            if out:
                yield table(out)
        if len(ids):
            yield table([made(part, ids, vals)])

    placed = rows.select("row", "v").mapInArrow(cut, "part int, place long, row long, v binary")
    return (placed.repartitionByRange("part", "place", "row").sortWithinPartitions("part", "place", "row")
            .mapInArrow(pack, "part int, n int, lo binary, hi binary, sums binary, ids binary, v binary"))


def _assigned(b, width: int, books: list):
    """For every block of an Arrow batch: (part, index of its only entry or
    None, its rows' entries, their distances, the rows).  The rows of a block
    with one entry left are not looked at: callers have the sums."""
    import numpy as np
    of = b.column("part").to_numpy()
    lo, hi = (_stacked(b.column(c), width, "<i4").astype(np.int64) for c in ("lo", "hi"))
    keep = np.zeros((len(of), max(len(e) for e in books)), bool)
    for p in set(of.tolist()):
        at = of == p
        keep[np.ix_(at, range(len(books[p])))] = shortlists(lo[at], hi[at], books[p])
    only = np.where(keep.sum(1) == 1, keep.argmax(1), -1)
    return of, keep, only


def _round(blocks: DataFrame, width: int, books: list) -> dict:
    """Sums and counts of the parts nearest to each entry."""
    size = max(len(e) for e in books)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        sums = np.zeros((len(books), size, width + 1), np.int64)  # the last column counts
        for b in batches:
            of, keep, only = _assigned(b, width, books)
            n, totals = b.column("n").to_numpy(), _stacked(b.column("sums"), width, "<i8")
            whole = only >= 0
            np.add.at(sums, (of[whole], only[whole]), np.column_stack([totals[whole], n[whole]]))
            for i in np.flatnonzero(~whole):
                rows = np.frombuffer(b.column("v")[int(i)].as_buffer(), "<i4").reshape(-1, width).astype(np.int64)
                got, _ = nearest(rows, books[of[i]], np.flatnonzero(keep[i]))
                np.add.at(sums[of[i]], got, np.column_stack([rows, np.ones(len(rows), np.int64)]))
        part, entry, at = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype("i4")), pa.array(entry.astype("i4")), pa.array(at.astype("i4")),
             pa.array(sums[part, entry, at])], ["part", "entry", "at", "s"])

    got = (blocks.select("part", "n", "lo", "hi", "sums", "v")
           .mapInArrow(run, "part int, entry int, at int, s long")
           .groupBy("part", "entry", "at").agg(F.sum("s").alias("s")).collect())
    return {(r["part"], r["entry"], r["at"]): r["s"] for r in got}


def _coded(blocks: DataFrame, width: int, books: list) -> DataFrame:
    """(row, part, entry, error) of every part of every row."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for b in batches:
            of, keep, _ = _assigned(b, width, books)
            for i in range(len(of)):
                rows = np.frombuffer(b.column("v")[i].as_buffer(), "<i4").reshape(-1, width).astype(np.int64)
                got, d = nearest(rows, books[of[i]], np.flatnonzero(keep[i]))
                ids = np.frombuffer(b.column("ids")[i].as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.full(len(ids), of[i], "i4")),
                     pa.array(got.astype("i4")), pa.array(d)], ["row", "part", "entry", "error"])

    return (blocks.select("part", "lo", "hi", "ids", "v")
            .mapInArrow(run, "row long, part int, entry int, error long"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error per kept row; the codebooks).  ``code``:
    two hex digits per part; ``error``: squared distances over all parts."""
    import numpy as np
    if entries > 256:
        raise ValueError("a code has two hex digits per part: at most 256 entries")
    rows = written(_integers(vectors, id_col, vec_col, label_col), "vector-rows")
    spread = _spread(rows)
    long, width = (max(r["most"] for r in spread), 0) if spread else (0, 0)
    if spread:
        if long != min(r["least"] for r in spread):
            raise ValueError("vectors of different lengths")
        if long % parts:
            raise ValueError(f"vectors of {long} components cannot be cut into {parts} equal parts")
        if max(r["top"] for r in spread) >= LARGEST:
            raise ValueError(f"components of {LARGEST // SCALE} and more are not supported")
        width = long // parts
    if not width:  # no rows, or vectors without components: all parts are equal
        blank = "00" * parts
        books = [np.zeros((1, 0), np.int64)] * parts if spread else []
        return rows.select("vec_id", "label", F.lit(blank).alias("code"),
                           F.lit(0).cast("long").alias("error")), Codebooks(books)
    first = [r["v"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()]
    books = [np.array([v[p * width:(p + 1) * width] for v in first], np.int64) for p in range(parts)]
    blocks = written(_blocks(rows, parts, width, spread, block), "vector-blocks")
    for _ in range(rounds):
        got = _round(blocks, width, books)
        for p, book in enumerate(books):
            for e in range(len(book)):
                n = got.get((p, e, width), 0)
                if n:  # unused entries stay
                    book[e] = [got.get((p, e, j), 0) // n for j in range(width)]
    codes = _coded(blocks, width, books).groupBy("row").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "entry"))),
                                 lambda x: F.lower(F.lpad(F.hex(x["entry"]), 2, "0"))), "").alias("code"),
        F.sum("error").alias("error"))
    return (rows.select("row", "vec_id", "label").join(codes, "row")
            .select("vec_id", "label", "code", "error")), Codebooks(books)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``label_error``: the error summed over rows of equal label, nulls together."""
    totals = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, codes["label"].eqNullSafe(totals["of_label"])).drop("of_label")
