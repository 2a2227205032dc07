"""Packing by shortest-pack-first over the length histogram.

Every document (its token ids and an end id) is cut into full sequences of
``max_tokens`` and a rest, so each id lies in one piece and the pieces are
known as soon as a document is encoded -- once.  The histogram of piece
lengths (at most ``max_tokens`` numbers, whatever the corpus) is packed on
the driver, longest lengths first, each into the packs with the most room,
updating the counts of packing patterns.  The patterns' slots are then
joined back to the pieces by the piece's rank among those of its length.
Ranks are made from bucket counts, so no task sees all pieces of a length.
``pack`` gives the pieces' places; ``pack_sequences`` carries the ids along
(compressed) and gives the sequences themselves, ids in order.

Defined results: a null or empty text is one piece with the end id;
repeated rows are packed one by one; an empty table gives an empty result;
further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import PRETOKEN, byte_symbols, default_vocabulary, id_coder, vocabulary
from .common import ids_and_text, written

MAX_TOKENS = 1024   # fixed value: tokens of a sequence
END_ID = 0          # fixed value: the id that ends every document
BUCKET_ROWS = 20_000  # pieces ranked together, on average


def library_encoder(state: dict):
    """Text -> ids, by a merge library over the vocabulary file's own tokens,
    merge order, pre-token pattern and special strings (the file's bytes are
    broadcast; built once per worker).  Its pattern engine gives up on a run
    of about a million white-space characters; such a text is encoded by the
    operator's own tables, which give the same ids."""
    if "encoder" not in state:
        import json

        import numpy as np
        import tiktoken
        spec, symbols = json.loads(state["content"]), byte_symbols()
        ranks = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][a + b] for a, b in merges]
        if order != sorted(order):
            raise ValueError("the vocabulary's ids do not follow its merge order")
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        encoding = tiktoken.Encoding("vocabulary", pat_str=PRETOKEN, mergeable_ranks=ranks,
                                     special_tokens=special)

        def encode(text: str):
            try:
                return encoding.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the pattern engine's backtracking stack is full
                return np.frombuffer(b"".join(next(id_coder(state).code([text]))), "<u4")

        state["encoder"] = encode
    return state["encoder"]


def zipped(ids: bytes) -> bytes:
    """Little-endian u32 ids, compressed; ids below 65536 as u16 before."""
    import zlib

    import numpy as np
    u32 = np.frombuffer(ids, "<u4")
    return zlib.compress(u32.astype("<u2").tobytes() if u32.max() < 1 << 16 else ids, 1)


def unzipped(data: bytes, length: int) -> bytes:
    import zlib

    import numpy as np
    data = zlib.decompress(data)
    return np.frombuffer(data, "<u2").astype("<u4").tobytes() if len(data) == 2 * length else data


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, path: str | None = None,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The cut documents: doc_id, start, length, ids_crc32, doc_tokens (and,
    if asked for, the ids as ``zipped`` makes them)."""
    bc = vocabulary(docs.sparkSession, path or default_vocabulary())

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        encode = library_encoder(bc.value)
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                data = encode(text).astype("<u4").tobytes() + end
                n = len(data) // 4
                for s in range(0, n, max_tokens):
                    part = data[4 * s:4 * (s + max_tokens)]
                    rows.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(zipped(part))
            cols = [b.column("doc_id").take(pa.array(rows, pa.int64()))]
            cols += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    d = ids_and_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
                        + (", ids binary" if with_ids else ""))


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (number of packs, [(length, copies in a pack)]).

    Lengths go longest first into the packs with the most room; a group of
    equal packs is split when fewer pieces than packs are left.  When none
    has room, new packs are filled with as many copies as they hold."""
    room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(count: int, pattern: list[tuple[int, int]], left: int) -> None:
        if count:
            room.setdefault(left, []).append((count, pattern))

    for length in sorted(histogram, reverse=True):
        rest = histogram[length]
        while rest:
            left = max(room, default=0)
            if left < length:
                each = min(size // length, rest)
                put(rest // each, [(length, each)], size - length * each)
                rest %= each
                continue
            count, pattern = room[left].pop()
            if not room[left]:
                del room[left]
            # as many copies as go into each of these packs
            each = max(1, min(left // length, rest // count))
            used = min(count, rest // each)
            last = pattern[-1]
            grown = ([*pattern[:-1], (length, last[1] + each)] if last[0] == length
                     else [*pattern, (length, each)])
            put(used, grown, left - length * each)
            put(count - used, pattern, left)
            rest -= used * each
    return [p for group in room.values() for p in group]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, ...]]:
    """(length, first rank, ranks, copies in a pack, first sequence, offset)
    of every run of equal lengths in a pattern.  Their number depends on the
    sequence length only, not on the corpus."""
    out, rank, sequence = [], {}, 0
    for count, pattern in patterns:
        offset = 0
        for length, each in pattern:
            first = rank.get(length, 0)
            out.append((length, first, first + count * each, each, sequence, offset))
            rank[length] = first + count * each
            offset += length * each
        sequence += count
    return out


def ranked(rows: DataFrame, n: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rank`` of every piece among those of its length, from 0.

    Pieces are dealt to buckets by a hash; ranks count within (length,
    bucket) and start after the earlier buckets' counts."""
    buckets = max(1, -(-n // bucket_rows))
    b = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = b.groupBy("length", "bucket").agg(F.count("*").alias("c"))
    before = (Window.partitionBy("length").orderBy("bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("length", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    inner = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (b.withColumn("r", F.row_number().over(inner) - 1)
            .join(first, ["length", "bucket"])
            .withColumn("rank", F.col("first") + F.col("r")).drop("first", "r", "bucket"))


def pack(docs: DataFrame, max_tokens: int = MAX_TOKENS, path: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of
    every piece (and its ids, ``zipped``, if asked for); a sequence's pieces
    lie gapless from offset 0."""
    spark = docs.sparkSession
    rows = written(pieces(docs, max_tokens, path, id_col, text_col, with_ids), "pack-pieces")
    # at most max_tokens rows
    histogram = {r["length"]: r["n"] for r in
                 rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(shortest_pack_first(histogram, max_tokens))
    import pyarrow as pa
    # an Arrow table goes to the JVM as it is; a list of rows would start a
    # second set of Python workers on every executor to be read
    columns = zip(*(table or [(0, 0, 0, 1, 0, 0)]))
    s = spark.createDataFrame(pa.table({name: pa.array(c, pa.int64()) for name, c in zip(
        ("s_length", "s_from", "s_to", "s_each", "s_seq", "s_off"), columns)}))
    r = ranked(rows, sum(histogram.values()))
    at = F.col("rank") - F.col("s_from")
    j = r.join(F.broadcast(s), (F.col("length") == F.col("s_length"))
               & (F.col("rank") >= F.col("s_from")) & (F.col("rank") < F.col("s_to")))
    return j.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("s_seq") + F.floor(at / F.col("s_each"))).cast("long").alias("sequence_id"),
        (F.col("s_off") + F.pmod(at, "s_each") * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []))


def pack_sequences(docs: DataFrame, max_tokens: int = MAX_TOKENS, path: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text", pad_id: int | None = None) -> DataFrame:
    """sequence_id, ids (little-endian u32 as binary, at most ``max_tokens``,
    end ids included; filled up with ``pad_id`` if given), n_tokens (without
    padding), pieces (doc_id, start, length, ids_crc32 of the ids as they lie
    in the sequence, doc_tokens, offset; in order of offset)."""
    rows = pack(docs, max_tokens, path, id_col, text_col, with_ids=True)
    parts = ["offset", "doc_id", "start", "length", "doc_tokens", "ids"]
    grouped = rows.groupBy("sequence_id").agg(F.collect_list(F.struct(*parts)).alias("parts"))

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        for b in batches:
            lists = b.column("parts")
            flat = lists.flatten()
            starts, lengths, offsets = (flat.field(c).to_pylist() for c in ("start", "length", "offset"))
            tokens, data = flat.field("doc_tokens").to_pylist(), flat.field("ids").to_pylist()
            order, bounds, whole, totals, crcs = [], [0], [], [], []
            for n in lists.value_lengths().to_pylist():
                own = sorted(range(bounds[-1], bounds[-1] + n), key=offsets.__getitem__)
                ids = b"".join(unzipped(data[i], lengths[i]) for i in own)
                crcs += [zlib.crc32(ids[4 * offsets[i]:4 * (offsets[i] + lengths[i])]) for i in own]
                totals.append(len(ids) // 4)
                if pad_id is not None:
                    ids += pad_id.to_bytes(4, "little") * (max_tokens - totals[-1])
                whole.append(ids)
                order += own
                bounds.append(bounds[-1] + n)
            take = lambda values: pa.array([values[i] for i in order], pa.int64())
            pieces = pa.StructArray.from_arrays(
                [flat.field("doc_id").take(pa.array(order, pa.int64())), take(starts), take(lengths),
                 pa.array(crcs, pa.int64()), take(tokens), take(offsets)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset"])
            yield pa.RecordBatch.from_arrays(
                [b.column("sequence_id"), pa.array(whole, pa.binary()), pa.array(totals, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pieces)],
                ["sequence_id", "ids", "n_tokens", "pieces"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return grouped.mapInArrow(run, "sequence_id long, ids binary, n_tokens long, pieces array<struct<"
                              f"doc_id:{kind},start:long,length:long,ids_crc32:long,doc_tokens:long,offset:long>>")


def piece_rows(sequences: DataFrame, with_ids: bool = False) -> DataFrame:
    """The columns of ``pack`` from those of ``pack_sequences``; a sequence's
    pieces follow each other, each with its ids (u32 as binary) if asked for."""
    rows = sequences.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    own = F.expr("substring(ids, cast(4 * p.offset + 1 as int), cast(4 * p.length as int))").alias("ids")
    return rows.select(*(F.col(f"p.{c}").alias(c) for c in names), "sequence_id",
                       F.col("p.offset").alias("offset"), *([own] if with_ids else []))
