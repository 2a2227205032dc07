"""Exact removal of long repeated passages with a logarithmic index family.

A byte goes when a string of 50 bytes that covers it also starts in a
document with a smaller id.  Texts are gathered into batches; a batch gets a
sparse suffix array: of the 35 grams of 16 bytes in a 50-byte window the one
of least hash (the leftmost on ties) is the window's anchor, so equal windows
have equal anchors, wherever they stand.  The suffixes that start at anchors
are sorted; neighbouring windows of one anchor are one entry.  Only entries
of equal grams are compared, window by window, by all 50 bytes.  Of each
string a batch keeps the windows of its smallest document; the others are
covered, whatever other batches hold.

The entries that are left are dealt to shards by their gram.  A shard keeps
a family of sorted levels: a new batch is merge-scanned with a level of its
size, what has a smaller document is covered and leaves, and the merged level
goes on to the next of its size; at the end the levels are scanned from the
smallest up.  So any two batches meet in exactly one scan and an entry takes
part in logarithmically many.  A passage that a third of all documents share
comes to its shard once per batch, not once per document.

Steps, each written to the shared folder: batches of whole texts, numbered;
per batch the grams that some other batch has too (grams go out as sorted
32-bit hashes, one bit for each comes back; a false alarm costs work, never
a match); the entries of those grams to the shards, covered intervals back;
the batches again, with their intervals.

Defined results: null texts are empty; a null id counts as larger than any
other; rows with the same id never remove each other's bytes (contract:
only a smaller id does), repeated rows get equal results; an empty table
gives an empty result; further columns are ignored.  Ids are integers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids_and_text, written

LONG = 50                # fixed value: bytes of a string that counts as repeated
GRAM = 16                # bytes of an anchor
SPAN = LONG - GRAM + 1   # grams of a window
WORDS = (0, 8, 16, 24, 32, 40, LONG - 8)  # 8-byte words that make up a window
CHUNK = 1 << 19          # windows whose anchors are sought at once
BATCH_BYTES = 8 << 20    # text of a batch
SHARD_BYTES = 64 << 20   # text per shard, at most
SCAN_WINDOWS = 1 << 18   # windows compared at once
NEW_ENTRIES = 1 << 17    # entries a shard gathers before they become a batch
NO_ID = (1 << 63) - 1    # stands for a null id

FIELDS = ("w0", "w1", "doc", "batch", "local", "at", "n", "reps", "alive", "off", "gram")


def _mixed(h, w):
    import numpy as np
    h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _words(buffer, kind: str = "<u8"):
    """The 8 bytes from every place of a byte array as a number."""
    import numpy as np
    return np.ndarray((len(buffer) - 7,), kind, buffer.data, strides=(1,))


def gram_hash(w0, w1):
    import numpy as np
    return _mixed(_mixed(np.zeros(len(w0), np.uint64), w0), w1)


def find_anchors(buffer, starts, sizes):
    """Runs of windows with one anchor in the texts that lie at ``starts`` in
    ``buffer`` (64 spare bytes at its end): (first window, anchor, windows,
    repetitions).  Windows of one byte repeated that follow each other are
    one run of one window with repetitions."""
    import numpy as np
    edge = np.zeros(len(buffer) + 1, np.int8)
    long = sizes >= LONG
    edge[starts[long]] += 1
    edge[(starts + sizes)[long] - LONG + 1] -= 1
    valid = np.cumsum(edge, dtype=np.int8).astype(bool)
    word, low = _words(buffer), np.uint64((1 << 20) - 1)
    found = []
    last = len(buffer) - 64
    for c in range(0, max(0, last), CHUNK):
        m = min(CHUNK, last - c)
        grams = m + SPAN - 1
        h = gram_hash(word[c:c + grams], word[c + 8:c + 8 + grams])
        best = (h & ~low) | np.arange(grams, dtype=np.uint64)
        size = 1
        while 2 * size <= SPAN:  # least of the next 2, 4, ... grams
            best, size = np.minimum(best[:-size], best[size:]), 2 * size
        if size < SPAN:
            best = np.minimum(best[:size - SPAN], best[SPAN - size:])
        anchor = (best & low).astype(np.int64)[:m]
        same = np.r_[0, np.cumsum(buffer[c + 1:c + m + LONG] == buffer[c:c + m + LONG - 1])]
        ok = valid[c:c + m]
        flat = (same[LONG - 1:LONG - 1 + m] - same[:m] == LONG - 1) & ok
        again = flat.copy()
        again[0], again[1:] = False, flat[1:] & flat[:-1]
        at = np.flatnonzero(ok & ~again)
        if not len(at):
            continue
        dropped = np.r_[np.cumsum(again), 0]
        dropped[-1] = dropped[-2]
        reps = 1 + dropped[np.r_[at[1:], m]] - dropped[at]
        a, f = anchor[at], flat[at]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (np.diff(at) != 1) | f[1:] | f[:-1]])
        # repetitions belong to flat windows, which are runs of their own
        found.append((at[first] + c, a[first] + c, np.diff(np.r_[first, len(at)]),
                      np.where(f[first], reps[first], 1)))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))


class Store:
    """Bytes that entries point into; grows."""

    def __init__(self, content=None):
        import numpy as np
        self.bytes = np.zeros(1 << 16, np.uint8) if content is None else content
        self.used = 0 if content is None else len(content)

    def add(self, content) -> int:
        import numpy as np
        at, need = self.used, self.used + len(content) + 64
        if need > len(self.bytes):
            self.bytes = np.r_[self.bytes, np.zeros(max(need, 2 * len(self.bytes)) - len(self.bytes), np.uint8)]
        self.bytes[at:at + len(content)] = content
        self.used += len(content)
        return at


def _take(e: dict, at) -> dict:
    return {k: v[at] for k, v in e.items()}


def _joined(*es: dict) -> dict:
    import numpy as np
    return {k: np.concatenate([e[k] for e in es]) for k in FIELDS}


def suffix_sorted(e: dict) -> dict:
    """Entries in the order of the suffixes at their anchors."""
    import numpy as np
    order = np.argsort(e["w1"])  # the order of equal suffixes does not matter
    return _take(e, order[np.argsort(e["w0"][order], kind="stable")])


def _groups(e: dict):
    """Starts of the groups of equal grams, and their sizes."""
    import numpy as np
    n = len(e["w0"])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = (e["w0"][1:] != e["w0"][:-1]) | (e["w1"][1:] != e["w1"][:-1])
    starts = np.r_[0, np.flatnonzero(new) + 1]
    return starts, np.diff(np.r_[starts, n])


def _covered_windows(e: dict, which, store: Store):
    """Of the entries ``which``: (entry, window) of every live window whose
    string occurs among them in a smaller document."""
    import numpy as np
    n = e["n"][which].astype(np.int64)
    entry = np.repeat(which, n)
    window = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
    live = (e["alive"][entry] >> window.astype(np.uint64)) & np.uint64(1) == 1
    entry, window = entry[live], window[live]
    pos, word = e["off"][entry] + window, _words(store.bytes)
    h = np.zeros(len(pos), np.uint64)
    for k in WORDS:
        h = _mixed(h, word[pos + k])
    order = np.argsort(h)
    s = h[order]
    if not len(s):
        return entry, window

    def split(new):
        first = np.r_[0, np.flatnonzero(new) + 1]
        return first, np.diff(np.r_[first, len(order)])

    first, size = split(s[1:] != s[:-1])
    twice = np.repeat(size > 1, size)
    mine, other = pos[order][twice], pos[order][np.repeat(first, size)][twice]
    if not all(np.array_equal(word[mine + k], word[other + k]) for k in WORDS):  # equal hashes, other bytes
        text = np.ascontiguousarray(store.bytes[pos[:, None] + np.arange(LONG)]).view(f"S{LONG}")[:, 0]
        order = np.argsort(text, kind="stable")
        first, size = split(text[order][1:] != text[order][:-1])
    doc = e["doc"][entry[order]]
    lost = order[doc > np.repeat(np.minimum.reduceat(doc, first), size)]
    return entry[lost], window[lost]


def scan(e: dict, store: Store, side=None) -> tuple[dict, tuple]:
    """Merge-scan of suffix-sorted entries: (entries with a live window left,
    covered intervals).  With ``side`` only grams that both sides have are
    compared: what stood on one side has met before."""
    import numpy as np
    starts, sizes = _groups(e)
    if not len(starts):
        return e, (e["batch"], e["local"], e["at"], e["at"])
    differ = lambda x: np.minimum.reduceat(x, starts) != np.maximum.reduceat(x, starts)
    meet = differ(e["doc"])
    if side is not None:
        meet &= differ(side)
    groups = np.flatnonzero(meet)
    heavy = np.cumsum(np.add.reduceat(e["n"].astype(np.int64), starts)[groups]) // SCAN_WINDOWS
    found = []
    for part in np.split(groups, np.flatnonzero(np.diff(heavy)) + 1) if len(groups) else []:
        which = np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in part]) if len(part) < 64 else \
            np.repeat(starts[part] - (np.cumsum(sizes[part]) - sizes[part]), sizes[part]) + np.arange(sizes[part].sum())
        found.append(_covered_windows(e, which, store))
    if not found:
        return e, (e["batch"][:0], e["local"][:0], e["at"][:0], e["at"][:0])
    entry, window = (np.concatenate(x) for x in zip(*found))
    at = e["at"][entry] + window
    gone = (e["batch"][entry], e["local"][entry], at, at + e["reps"][entry] - 1 + LONG)
    bits = np.zeros(len(e["alive"]), np.uint64)
    np.bitwise_or.at(bits, entry, np.uint64(1) << window.astype(np.uint64))
    e = {**e, "alive": e["alive"] & ~bits}
    return _take(e, np.flatnonzero(e["alive"])), gone


class Family:
    """Sorted levels of geometrically growing sizes over one store."""

    def __init__(self):
        self.store, self.levels, self.new, self.gone = Store(), [], [], []

    def add(self, e: dict, content) -> None:
        """Entries whose ``off`` counts from the start of ``content``."""
        e = {**e, "off": e["off"] + self.store.add(content)}
        self.new.append(e)
        if sum(len(x["w0"]) for x in self.new) >= NEW_ENTRIES:
            self._batch()

    def _batch(self) -> None:
        if self.new:
            # within a batch of several arrivals all pairs are new to each other
            e, gone = scan(suffix_sorted(_joined(*self.new)), self.store)
            self.new = []
            self.gone.append(gone)
            while self.levels and len(self.levels[-1]["w0"]) <= 2 * len(e["w0"]):
                e = self._merged(self.levels.pop(), e)
            self.levels.append(e)

    def _merged(self, a: dict, b: dict) -> dict:
        import numpy as np
        both = {**_joined(a, b), "side": np.repeat(np.array([0, 1], np.int8), [len(a["w0"]), len(b["w0"])])}
        both = suffix_sorted(both)
        side = both.pop("side")
        e, gone = scan(both, self.store, side)
        self.gone.append(gone)
        return e

    def finish(self) -> tuple:
        """(batch, local, start, end) of all covered intervals."""
        import numpy as np
        self._batch()
        while len(self.levels) > 1:
            b = self.levels.pop()
            self.levels.append(self._merged(self.levels.pop(), b))
        if not self.gone:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*self.gone))


def united(keys, starts, ends):
    """Intervals of equal keys united where they touch; sorted."""
    import numpy as np
    if not len(starts):
        return keys, starts, ends
    wide = int(starts.max()) + 1
    order = np.argsort(keys.astype(np.int64) * wide + starts)
    k, s, e = keys[order], starts[order].astype(np.int64), ends[order].astype(np.int64)
    # the running end within a key: keys are dealt far apart for one running maximum
    step = int(e.max()) + 1
    number = np.cumsum(np.r_[0, k[1:] != k[:-1]]) * step
    reach = np.maximum.accumulate(e + number)
    new = np.flatnonzero(np.r_[True, (s + number)[1:] > reach[:-1]])
    return k[new], s[new], (reach - number)[np.r_[new[1:] - 1, len(k) - 1]]


def batch_entries(ids: list, texts: list[bytes], batch: int = 0) -> tuple[dict, Store, tuple]:
    """A batch's scanned suffix array, its store, and what it covers itself."""
    import numpy as np
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    store = Store(np.frombuffer(b"".join(texts) + bytes(64), np.uint8))
    first, anchor, n, reps = find_anchors(store.bytes, starts, sizes)
    # empty texts share their start with the next one: the last of equal starts is meant
    local = np.searchsorted(starts, first, side="right") - 1
    big = _words(store.bytes, ">u8")
    doc = np.array([NO_ID if i is None else i for i in ids], np.int64)
    e = {"w0": big[anchor].astype(np.uint64), "w1": big[anchor + 8].astype(np.uint64),
         "doc": doc[local] if len(local) else np.zeros(0, np.int64),
         "batch": np.full(len(first), batch, np.int64), "local": local.astype(np.int64),
         "at": first - starts[local] if len(local) else first, "n": n.astype(np.uint8), "reps": reps.astype(np.int64),
         "alive": (np.uint64(1) << n.astype(np.uint64)) - np.uint64(1), "off": first,
         "gram": (anchor - first).astype(np.uint8)}
    e, gone = scan(suffix_sorted(e), store)
    return e, store, gone


def _read(payload) -> tuple[list, list]:
    import pyarrow as pa
    t = pa.ipc.open_stream(payload).read_all()
    return t["doc_id"].to_pylist(), t["text"].to_pylist()


def _batches(docs: DataFrame, batch_bytes: int) -> DataFrame:
    """(batch, size, payload): whole texts, gathered and compressed."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        base, number, ids, texts, size = TaskContext.get().partitionId() << 32, 0, [], [], 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")

        def made():
            out = pa.BufferOutputStream()
            rows = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.large_binary())],
                                              ["doc_id", "text"])
            with pa.ipc.new_stream(out, rows.schema, options=options) as w:
                w.write_batch(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + number], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([out.getvalue().to_pybytes()], pa.binary())], ["batch", "size", "payload"])

        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if ids and size + len(t) > batch_bytes:
                    yield made()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield made()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return d.mapInArrow(run, "batch long, size long, payload binary")


def _shard_of(e: dict, shards: int):
    """(shard, 32-bit hash) of every entry's gram."""
    import numpy as np
    h = gram_hash(e["w0"], e["w1"])
    return ((h >> np.uint64(32)) % np.uint64(shards)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype("<u4")


def _by_shard(shard, hashes):
    """For each shard: (shard, its sorted distinct hashes)."""
    import numpy as np
    both = np.unique((shard.astype(np.uint64) << np.uint64(32)) | hashes)
    of, h = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype("<u4")
    edges = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)] if len(of) else []
    return [(int(of[s]), h[s:t]) for s, t in zip(edges, edges[1:])]


def _shared_grams(batches: DataFrame, shards: int) -> DataFrame:
    """(batch, shard, bits): for a batch's hashes in a shard, in order, whether
    some other batch has them too."""

    def out_(rows):
        import pyarrow as pa
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
            ["shard", "batch", "blob"])

    def grams(parts: Iterator) -> Iterator:
        import numpy as np
        import zstandard
        z = zstandard.ZstdCompressor(level=1)
        for b in parts:
            for batch, payload in zip(b.column("batch").to_pylist(), b.column("payload")):
                e, _, _ = batch_entries(*_read(payload.as_buffer()), batch)
                rows = [(s, batch, z.compress(np.diff(h, prepend=h[:1] * 0).astype("<u4").tobytes()))
                        for s, h in _by_shard(*_shard_of(e, shards))]
                if rows:
                    yield out_(rows)

    def meet(parts: Iterator) -> Iterator:
        import numpy as np
        import zstandard
        z = zstandard.ZstdDecompressor()
        held: dict[int, list] = {}
        for b in parts:
            for s, batch, blob in zip(*(c.to_pylist() for c in b.columns)):
                held.setdefault(s, []).append((batch, np.cumsum(np.frombuffer(z.decompress(blob), "<u4"), dtype="<u4")))
        for s, lists in held.items():
            every = np.sort(np.concatenate([h for _, h in lists]))
            twice = np.unique(every[1:][every[1:] == every[:-1]])
            for i in range(0, len(lists), 1000):
                yield out_([(s, batch, np.packbits(np.isin(h, twice, assume_unique=True)).tobytes())
                            for batch, h in lists[i:i + 1000]])

    kinds = "shard int, batch long, blob binary"
    return (batches.select("batch", "payload").mapInArrow(grams, kinds)
            .repartitionById(shards, "shard").mapInArrow(meet, kinds))


def _pack(e: dict, store: Store) -> bytes:
    """Entries of one batch and shard, and the bytes of their live windows."""
    import numpy as np
    import zstandard
    e = _take(e, np.lexsort((e["at"], e["local"])))
    alive = e["alive"]
    # windows before the first and after the last live one stay behind
    first = np.round(np.log2((alive & (~alive + np.uint64(1))).astype(float))).astype(np.int64)
    last = np.floor(np.log2(alive.astype(float))).astype(np.int64)
    n, off = last - first + 1, e["off"] + first
    size = n + LONG - 1
    place = np.repeat(off - (np.cumsum(size) - size), size) + np.arange(size.sum())
    columns = [np.array([len(n)], "<i8"), e["doc"].astype("<i8"), e["local"].astype("<i4"),
               (e["at"] + first).astype("<i4"), e["reps"].astype("<i4"),
               (alive >> first.astype(np.uint64)).astype("<u8"), n.astype("u1"),
               (e["gram"] - first).astype("u1")]
    return zstandard.ZstdCompressor(level=3).compress(
        b"".join(c.tobytes() for c in columns) + store.bytes[place].tobytes())


def _unpack(blob: bytes, batch: int) -> tuple[dict, object]:
    import numpy as np
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    m, at, got = int(raw[:8].view("<i8")[0]), 8, []
    for kind in ("<i8", "<i4", "<i4", "<i4", "<u8", "u1", "u1"):
        size = m * np.dtype(kind).itemsize
        got.append(np.frombuffer(raw[at:at + size].tobytes(), kind))
        at += size
    doc, local, place, reps, alive, n, gram = got
    content = raw[at:]
    size = n.astype(np.int64) + LONG - 1
    off = np.cumsum(size) - size
    big = _words(np.r_[content, np.zeros(8, np.uint8)], ">u8")
    return {"w0": big[off + gram].astype(np.uint64), "w1": big[off + gram + 8].astype(np.uint64), "doc": doc,
            "batch": np.full(m, batch, np.int64), "local": local.astype(np.int64), "at": place.astype(np.int64),
            "n": n, "reps": reps.astype(np.int64), "alive": alive.astype(np.uint64), "off": off,
            "gram": gram}, content


def _interval_rows(gone: tuple) -> list[tuple[int, bytes]]:
    """(batch, packed united intervals) of covered (batch, local, start, end)."""
    import numpy as np
    out = []
    order = np.argsort(gone[0])
    batch, local, s, t = (x[order] for x in gone)
    edges = np.r_[0, np.flatnonzero(np.diff(batch)) + 1, len(batch)] if len(batch) else []
    for x, y in zip(edges, edges[1:]):
        rows = np.column_stack(united(local[x:y], s[x:y], t[x:y]))
        out.append((int(batch[x]), rows.astype("<u4").tobytes()))
    return out


def _intervals(batches: DataFrame, shared: DataFrame, shards: int) -> DataFrame:
    """(batch, blob): covered intervals, from the batches themselves and from
    the shards' families."""

    def entries(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def rows_(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.int64(), pa.binary()))],
                ["shard", "done", "batch", "blob"])

        for b in parts:
            for batch, payload, bits in zip(b.column("batch").to_pylist(), b.column("payload"),
                                            b.column("bits").to_pylist()):
                e, store, gone = batch_entries(*_read(payload.as_buffer()), batch)
                rows = [(batch % shards, True, *r) for r in _interval_rows(gone)]
                if rows:
                    yield rows_(rows)
                shard, hashes = _shard_of(e, shards)
                flags = {x["shard"]: np.unpackbits(np.frombuffer(x["blob"], np.uint8)) for x in bits or []}
                order = np.argsort(shard, kind="stable")
                edges = np.searchsorted(shard[order], np.arange(shards + 1))
                lists, rows = dict(_by_shard(shard, hashes)), []
                for s, flag in flags.items():
                    at = order[edges[s]:edges[s + 1]]
                    at = at[flag[np.searchsorted(lists[s], hashes[at])] == 1]
                    if len(at):
                        rows.append((s, False, batch, _pack(_take(e, at), store)))
                    if sum(len(r[3]) for r in rows) > 2 << 20:
                        yield rows_(rows)
                        rows = []
                if rows:
                    yield rows_(rows)

    def families(parts: Iterator) -> Iterator:
        import pyarrow as pa

        def rows_(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary()))], ["batch", "blob"])

        held: dict[int, Family] = {}  # a task has one shard
        for b in parts:
            done = []
            for s, ready, batch, blob in zip(*(c.to_pylist() for c in b.columns)):
                if ready:
                    done.append((batch, blob))
                else:
                    held.setdefault(s, Family()).add(*_unpack(blob, batch))
            if done:
                yield rows_(done)
        while held:
            rows = _interval_rows(held.popitem()[1].finish())
            for i in range(0, len(rows), 1000):
                yield rows_(rows[i:i + 1000])

    bits = shared.groupBy("batch").agg(F.collect_list(F.struct("shard", "blob")).alias("bits"))
    return (batches.select("batch", "payload").join(bits, "batch", "left")
            .mapInArrow(entries, "shard int, done boolean, batch long, blob binary")
            .repartitionById(shards, "shard").mapInArrow(families, "batch long, blob binary"))


def dedup(docs: DataFrame, batch_bytes: int = BATCH_BYTES, shard_bytes: int = SHARD_BYTES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    spark = docs.sparkSession
    batches = written(_batches(ids_and_text(docs, id_col, text_col), batch_bytes), "suffix-batches")
    size = batches.agg(F.sum("size").alias("size")).first()["size"] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    shared = written(_shared_grams(batches, shards), "suffix-grams")
    gone = written(_intervals(batches, shared, shards), "suffix-intervals")

    def run(parts: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for b in parts:
            for payload, blobs in zip(b.column("payload"), b.column("blobs").to_pylist()):
                ids, texts = _read(payload.as_buffer())
                cut = np.frombuffer(b"".join(blobs or []), "<u4").reshape(-1, 3).astype(np.int64)
                key, s, t = united(cut[:, 0], cut[:, 1], cut[:, 2])
                edges, rows, held = np.searchsorted(key, np.arange(len(ids) + 1)), [], 0
                for i, (doc, text) in enumerate(zip(ids, texts)):
                    own = slice(edges[i], edges[i + 1])
                    kept, at = [], 0
                    for x, y in zip(s[own].tolist(), t[own].tolist()):
                        kept.append(text[at:x])
                        at = y
                    kept.append(text[at:])
                    left = b"".join(kept)
                    rows.append((doc, len(text), len(text) - len(left), int(edges[i + 1] - edges[i]), left))
                    held += len(left)
                    if held > 2 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    blobs = gone.groupBy("batch").agg(F.collect_list("blob").alias("blobs"))
    return (batches.select("batch", "payload").join(blobs, "batch", "left")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
