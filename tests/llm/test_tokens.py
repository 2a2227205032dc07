"""BPE, token counts and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_helpers import clashing, rows_of
from skumix.llm import bpe, packing, prefix_counts

ALPHABET = (list("abcdefgh thenandi'streovml 0123.,!?\n\t  ")
            + ["é", "ß", "中", "文", " ", "🎉", "'s", "'ll", "'ve ", "<|endoftext|>", "   ", " <|", "\x1c", "\x85"])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def state():
    with open(bpe.default_vocabulary(), "rb") as f:
        return {"content": f.read()}


def _texts(n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def _ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


def test_ids_and_round_trip_equal_the_library(library, state):
    tables, coder = bpe.tables_of(state), bpe.id_coder(state)
    buffer, offsets = tables.offsets()
    texts = _texts(1500, 60, 3)
    for text, chunks in zip(texts, coder.code(texts)):
        ids = np.frombuffer(b"".join(chunks), "<u4")
        assert ids.tolist() == _ids(library, text), text
        assert bpe.decode(ids, buffer, offsets).decode("utf-8", "replace") == library.decode(
            ids.tolist(), skip_special_tokens=False)


def test_every_single_token_encodes_as_the_library_does(library, state):
    tables = bpe.tables_of(state)
    for t in tables.tokens[::11]:
        try:
            text = t.decode()
        except UnicodeDecodeError:
            continue
        assert np.frombuffer(tables.packed(text), "<u4").tolist() == _ids(library, text)


def test_prefix_counts_equal_encoding_every_prefix(library, state):
    tables = bpe.tables_of(state)
    for text in _texts(250, 30, 5) + ["中e n1\n\nßn've gé", "a   b", "x 'll", "<|endoftext|>"]:
        want = [len(_ids(library, text[:i])) for i in range(len(text) + 1)]
        got = prefix_counts.prefix_counts(tables, text)
        assert got == want, text
        assert prefix_counts.cut_at(got, 3) == max(i for i, c in enumerate(want) if c <= 3)


def test_encode_and_counts_over_odd_rows(docs, empty, library):
    got = {}
    for r in bpe.encode(clashing(docs, ["ids", "n_tokens", "decoded"])).collect():
        got.setdefault(r.doc_id, []).append((bytes(r.ids), r.n_tokens, r.decoded))
    want = {}
    for r in docs.collect():
        ids = _ids(library, r.text or "")
        want.setdefault(r.doc_id, []).append((np.array(ids, "<u4").tobytes(), len(ids), r.text or ""))
    assert got == want
    counts = rows_of(prefix_counts.token_counts(clashing(docs, ["n_bytes", "n_tokens"])))
    assert counts == sorted(((r.doc_id, len((r.text or "").encode()), len(_ids(library, r.text or "")),
                              len(_ids(library, r.text or "")) > 512) for r in docs.collect()), key=repr)
    assert bpe.encode(empty).count() == 0 and prefix_counts.token_counts(empty).count() == 0
    cut = {r.doc_id: r.cut_chars for r in prefix_counts.prefix_table(docs, budget=4).collect()}
    assert cut[2] == 0 and cut[1] == len("the quick brown fox")


@pytest.mark.parametrize("text", ["a" + " " * 2_000_000 + "b c", "a" + "\n" * 2_000_000 + "b",
                                  " " * 2_000_000, "x<|endoftext|>" + " \r\n" * 700_000 + "<|endoftext|> 中 don't"])
def test_packing_encodes_white_space_runs_of_millions(library, state, text):
    assert packing.library_encoder(state)(text).tolist() == _ids(library, text)


def _check_packing(rows, texts, library, size):
    """Every id in one piece, sequences gapless and within the size."""
    whole = {}
    for doc_id, text in texts:
        whole[repr(doc_id)] = [*_ids(library, text), packing.END_ID]
    seen = {}
    for r in rows:
        ids = whole[repr(r.doc_id)]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
        seen.setdefault(repr(r.doc_id), []).append((r.start, r.length))
    for doc_id, ids in whole.items():
        copies = sum(repr(d) == doc_id for d, _ in texts)
        assert sum(n for _, n in seen[doc_id]) == copies * len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return sequences


def test_packing_is_exact_and_gapless(docs, empty, library):
    rows = packing.pack(clashing(docs, ["length", "rank", "offset"])).collect()
    _check_packing(rows, [(r.doc_id, r.text or "") for r in docs.collect()], library, packing.MAX_TOKENS)
    assert packing.pack(empty).count() == 0


@pytest.mark.parametrize("size,pad", [(16, None), (1024, 7)])
def test_sequences_rebuild_every_document(docs, empty, library, size, pad):
    rows = packing.pack_sequences(clashing(docs, ["ids", "pieces"]), size, pad_id=pad)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    _check_packing(packing.piece_rows(rows).collect(), texts, library, size)
    parts, places = {}, [(r.doc_id, r.sequence_id, r.offset, bytes(r.ids))
                         for r in packing.piece_rows(rows, with_ids=True).collect()]
    sequences = rows.collect()
    assert len({r.sequence_id for r in sequences}) == len(sequences)
    for r in sequences:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert r.n_tokens == sum(p.length for p in r.pieces) <= size
        assert ids[r.n_tokens:] == [pad] * (0 if pad is None else size - r.n_tokens)
        assert [p.offset for p in r.pieces] == sorted(p.offset for p in r.pieces)
        for p in r.pieces:
            own = ids[p.offset:p.offset + p.length]
            parts.setdefault(p.doc_id, []).append((p.start, own))
            assert (p.doc_id, r.sequence_id, p.offset, np.array(own, "<u4").tobytes()) in places
    for doc_id in {d for d, _ in texts}:
        want = [[*_ids(library, t), packing.END_ID] for d, t in texts if d == doc_id]
        got = [i for _, own in sorted(parts[doc_id])[::len(want)] for i in own]
        assert got == want[0] and len(parts[doc_id]) == len(want) * -(-len(want[0]) // size)
    assert packing.pack_sequences(empty).count() == 0


def test_zipped_ids_come_back():
    for ids in ([0], [65535, 1], [65536, 2, 3], list(range(0, 100_000, 97))):
        data = np.array(ids, "<u4").tobytes()
        assert packing.unzipped(packing.zipped(data), len(ids)) == data


def test_pieces_of_the_query_equal_those_of_pack(spark):
    from skumix.llm import queries
    d = "/root/testdata/sf0.001"
    want = packing.pack(spark.read.parquet(f"{d}/documents.parquet"))
    got = queries.op8_packing(spark, d)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_packing_on_the_small_tables_wastes_little(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(d).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r.length)
    totals = [sum(s) for s in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else packing.MAX_TOKENS - n for n in totals)
    assert max(totals) <= packing.MAX_TOKENS and padding < 0.02 * sum(totals)
    assert len({r.doc_id for r in rows}) == d.count()


def test_shortest_pack_first_places_every_length_once():
    rng = random.Random(1)
    for _ in range(50):
        size = rng.choice([8, 64, 1024])
        histogram = {rng.randint(1, size): rng.randint(1, 500) for _ in range(rng.randint(0, 30))}
        packs = packing.shortest_pack_first(histogram, size)
        placed = {}
        for count, pattern in packs:
            assert sum(n * c for n, c in pattern) <= size
            for n, c in pattern:
                placed[n] = placed.get(n, 0) + count * c
        assert placed == histogram
        ends = {}
        for length, first, last, each, _, _ in packing.slots(packs):
            assert ends.get(length, 0) == first and (last - first) % each == 0
            ends[length] = last
        assert ends == histogram


def test_query_digests(spark, library):
    from skumix.llm import queries
    d = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in queries.op7_bpe(spark, d).collect():
        ids = _ids(library, text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
