"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint stands for all variants within half the radius
(2 of 4 bits: 1 + 64 + 2016 of them).  Two fingerprints within 4 bits share
a variant, and two that share one are within 4 bits, so groups of equal
variants give exactly the links.  Variants are shuffled by their leading
``PREFIX_BITS``: a fingerprint is sent once to each of the prefixes its
variants have (1 + 16 + 120 of them) and the variants under that prefix
are made there, sorted and compared, a bounded number at a time.  A group
of colliding fingerprints is linked as a star to its smallest member and
the links are verified by their bit distance; no pairs are listed.

Exact copies collapse into one fingerprint before anything is emitted, so
a group with a third of all rows costs as much as a single document.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; repeated rows each get a row with the same component; an
empty table gives an empty result; a null doc_id takes part, but is never
a component's id unless all are null; further columns are ignored
(``simhash_components``) or returned unchanged (``keep_first``)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, in_batches, written
from .components import components

SHINGLE = 4        # fixed value: words of a shingle
RADIUS = 4         # fixed value: bits in which linked fingerprints may differ
SEED = 42          # fixed value: seed of XXH64
PREFIX_BITS = 16   # leading bits of a variant that decide where it is compared
CHUNK_ROWS = 32_768          # received rows compared at once
SLICE_VARIANTS = 2_000_000   # variants held at once


def fingerprint(text: bytes) -> int:
    """SimHash of the 4-word shingles of a UTF-8 text (ASCII lower case)."""
    import numpy as np
    from xxhash import xxh64_intdigest
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxh64_intdigest(line, SEED)  # one shingle: every bit is the majority
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = len(words) - SHINGLE + 1
    h = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in
                     zip(starts[:n].tolist(), ends[SHINGLE - 1:].tolist())), "<u8", n)
    set_bits = np.zeros(64, np.int64)
    for i in range(0, n, 4096):  # bounded memory for long texts
        bits = np.unpackbits(h[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa
    for b in batches:
        texts = b.column("text").cast(pa.binary()).to_pylist()
        fp = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), pa.array(fp, pa.int64())],
                                         ["doc_id", "h", "fp"])


def _masks(bits: int, flips: int):
    """All masks over ``bits`` low bits with at most ``flips`` bits set."""
    import numpy as np
    from itertools import combinations
    return np.array([sum(1 << i for i in c) for k in range(flips + 1)
                     for c in combinations(range(bits), k)], np.uint64)


def _links(prefix: int, half: int):
    """Task function: rows (key, fp) in order of key -> links (u, v)."""

    def compare(keys, fps):
        import numpy as np
        low_bits = 64 - prefix
        flips = np.bitwise_count((fps >> np.uint64(low_bits)) ^ keys)
        parts = [(np.nonzero(flips == j)[0], _masks(low_bits, half - j)) for j in range(half + 1)]
        start = (keys << np.uint64(low_bits)) | (fps & np.uint64((1 << low_bits) - 1))
        total = sum(len(i) * len(m) for i, m in parts)
        slices = 1 << max(0, (total // SLICE_VARIANTS).bit_length())
        for s in range(slices):
            variants, owners = [], []
            for rows, masks in parts:
                step = max(1, SLICE_VARIANTS // (4 * len(masks)))
                for i in range(0, len(rows), step):
                    r = rows[i:i + step]
                    v = (start[r][:, None] ^ masks[None, :]).ravel()
                    o = np.repeat(r, len(masks))
                    if slices > 1:  # every variant belongs to one slice
                        mix = (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                        own = (mix & np.uint64(slices - 1)) == s
                        v, o = v[own], o[own]
                    variants.append(v)
                    owners.append(o)
            v, o = np.concatenate(variants), np.concatenate(owners)
            ordered = np.sort(v)
            twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
            if not len(twice):
                continue
            at = np.minimum(np.searchsorted(twice, v), len(twice) - 1)
            hit = twice[at] == v
            group, f = at[hit], fps[o[hit]]
            smallest = np.full(len(twice), np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(smallest, group, f)
            a, b = f, smallest[group]
            real = (a != b) & (np.bitwise_count(a ^ b) <= 2 * half)  # verified
            yield np.unique(np.column_stack([a[real], b[real]]), axis=0)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        keys, fps = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

        def out(k, f):
            for pairs in compare(k, f):
                if len(pairs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)],
                        ["u", "v"])

        for b in batches:
            keys = np.r_[keys, b.column("key").to_numpy().astype(np.uint64)]
            fps = np.r_[fps, b.column("fp").to_numpy().view(np.uint64)]
            while len(keys) >= CHUNK_ROWS:
                # whole keys only: the last one may go on in the next batch
                cut = int(np.searchsorted(keys, keys[min(len(keys) - 1, 2 * CHUNK_ROWS)], "left"))
                if cut == 0:
                    cut = int(np.searchsorted(keys, keys[0], "right"))
                    if cut == len(keys):
                        break
                yield from out(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield from out(keys, fps)

    return run


def links(distinct: DataFrame, radius: int = RADIUS, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """Star links (u, v) of the distinct fingerprints ``fp``: their connected
    components are those of all pairs within ``radius`` (even) bits."""
    half = radius // 2
    masks = [int(m) for m in _masks(prefix_bits, half)]
    top = F.shiftrightunsigned("fp", 64 - prefix_bits)
    spread = (distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("m"))
              .select("fp", top.bitwiseXOR(F.col("m")).cast("long").alias("key")))
    return (spread.repartition("key").sortWithinPartitions("key")
            .select("key", "fp").mapInArrow(_links(prefix_bits, half), "u long, v long").distinct())


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with doc_id, text hash, fp), (fp, root of its component)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = in_batches(docs).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    rows = written(d.mapInArrow(_fingerprints, f"doc_id {kind}, h long, fp long"), "simhash-fp")
    distinct = written(rows.select("fp").distinct(), "simhash-distinct")
    roots = components(links(distinct), "simhash")
    comp = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))
    return rows, written(comp, "simhash-components")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    rows, comp = _grouped(docs, id_col, text_col)
    # one row per fingerprint first: copies never meet in one task
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("d"))
    least = (first.join(comp, "fp").groupBy("root").agg(F.min("d").alias("component_id")))
    named = written(comp.join(least, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component (smallest id, then text hash), its columns
    unchanged; of rows repeated in full one stays."""
    rows, comp = _grouped(docs, id_col, text_col)
    first = rows.groupBy("fp").agg(F.min(F.struct(F.isnull("doc_id").alias("n"), "doc_id", "h")).alias("s"))
    kept = (first.join(comp, "fp").groupBy("root").agg(F.min("s").alias("s"))
            .select(F.col("s.doc_id").alias("k_id"), F.col("s.h").alias("k_h")))
    kept = written(kept, "simhash-kept")
    h = free_name(docs, "text_hash")
    d = docs.withColumn(h, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = d.join(kept, d[id_col].eqNullSafe(kept["k_id"]) & (d[h] == kept["k_h"]), "left_semi")
    return joined.dropDuplicates([id_col, h]).drop(h)
