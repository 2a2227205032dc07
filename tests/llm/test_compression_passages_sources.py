"""Vector codes, repeated passages and source divergence against their
definitions, on small inputs."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_helpers import clashing, rows_of
from pyspark.sql import functions as F

from skumix.llm import divergence, suffix_index, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


# ---- vector codes -----------------------------------------------------------------

def test_hilbert_curve_visits_every_cell_by_single_steps():
    for axes, bits in ((1, 3), (2, 3), (3, 2), (4, 2), (8, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        places = vector_codes.hilbert_places(cells, bits)
        assert sorted(places.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(places)], axis=0)).sum(1)
        assert (steps == 1).all(), (axes, bits)


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(1)
    for _ in range(100):
        rows = rng.integers(-50, 50, (20, 3)) + rng.integers(-200, 200, 3)
        books = rng.integers(-250, 250, (9, 3))
        books[4] = books[2]  # a tie
        keep = vector_codes.shortlists(rows.min(0)[None], rows.max(0)[None], books)[0]
        d = ((rows[:, None] - books) ** 2).sum(2)
        assert keep[d.argmin(1)].all()
        got, dist = vector_codes.nearest(rows, books, np.flatnonzero(keep))
        assert np.array_equal(got, d.argmin(1)) and np.array_equal(dist, d.min(1))


def _codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    x = np.array([[int(np.floor(4096 * float(np.float32(c)))) for c in v] for _, v, _ in kept], object)
    width = x.shape[1] // parts
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, list(x[r])))[:entries]
    books = [[list(x[r][p * width:(p + 1) * width]) for r in order] for p in range(parts)]
    for turn in range(rounds + 1):
        codes, errors = [], [0] * len(kept)
        for p in range(parts):
            own = []
            for r in range(len(kept)):
                d = [sum((a - b) ** 2 for a, b in zip(x[r][p * width:(p + 1) * width], e)) for e in books[p]]
                own.append(d.index(min(d)))
                errors[r] += min(d)
            codes.append(own)
            if turn < rounds:
                for e in range(len(books[p])):
                    member = [x[r][p * width:(p + 1) * width] for r in range(len(kept)) if own[r] == e]
                    if member:
                        books[p][e] = [sum(c) // len(member) for c in zip(*member)]
    out = [(kept[r][0], kept[r][2], "".join(f"{codes[p][r]:02x}" for p in range(parts)), errors[r]) for r in range(len(kept))]
    text = ",".join(str(c) for b in books for e in b for c in e)
    return sorted(out, key=repr), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n, width, block", [(150, 2, 16), (40, 1, 3), (9, 3, 256)])
def test_vector_codes_equal_plain_loops(spark, n, width, block):
    rng = random.Random(n)
    rows = [(i, [rng.choice([-1, 0.25, 1]) * rng.random() for _ in range(8 * width)], rng.choice([1, 2, None]))
            for i in range(n)]
    rows += [(rows[0][0], rows[0][1], 2)] * 5 + [(None, rows[1][1], None), (n + 1, None, 1),
             (n + 2, [float("nan")] * 8 * width, 1), (n + 3, [float("inf")] + [0.0] * (8 * width - 1), 1),
             (n + 4, [None] * 8 * width, 2)] + [(1000 + i, rows[3][1], 1) for i in range(n)]  # a third are copies
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    codes, books = vector_codes.compress(clashing(df, ["row", "v", "part", "error", "code"]), block=block)
    want, digest = _codes(rows)
    assert sorted(map(tuple, codes.select("vec_id", "label", "code", "error").collect()), key=repr) == want
    assert books.sha256() == digest
    totals = Counter()
    for _, lab, _, e in want:
        totals[lab] += e
    for r in vector_codes.with_label_error(codes).collect():
        assert r.label_error == totals[r.label]


def test_vector_codes_of_nothing_and_of_unfit_vectors(spark):
    for df in (spark.createDataFrame([], VECTORS), spark.createDataFrame([(1, None, 1), (2, [None], 1)], VECTORS)):
        codes, books = vector_codes.compress(df)
        assert codes.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
        assert vector_codes.with_label_error(codes).count() == 0
    for bad in ([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 9, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(ValueError):
            vector_codes.compress(spark.createDataFrame(bad, VECTORS))


# ---- repeated passages ----------------------------------------------------------------

def _gone(rows):
    least = {}
    for doc, t in rows:
        doc = suffix_index.NO_ID if doc is None else doc
        for i in range(len(t) - 49):
            least[t[i:i + 50]] = min(least.get(t[i:i + 50], doc), doc)
    for doc, t in rows:
        doc, gone = suffix_index.NO_ID if doc is None else doc, np.zeros(len(t), bool)
        for i in range(len(t) - 49):
            if least[t[i:i + 50]] < doc:
                gone[i:i + 50] = True
        yield gone


def _want(rows):
    out = []
    for (doc, t), gone in zip(rows, _gone(rows)):
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone]) if t else b""
        out.append((doc, len(t), int(gone.sum()), spans, kept))
    return sorted(out, key=repr)


def _corpus(rng, n):
    words = ["".join(rng.choices("abcdefgh\x00\né中", k=rng.randint(1, 6))) for _ in range(25)]
    passages = [" ".join(rng.choices(words, k=40)) for _ in range(4)] + [" " * 200, "=-" * 60, "x" * 300]
    rows = []
    for i in range(n):
        t = ""
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            t += p[a:a + rng.randint(0, 200)] if rng.random() < 0.6 else " ".join(rng.choices(words, k=rng.randint(0, 30)))
        rows.append((rng.choice([None, rng.randint(0, n), i]), t))
    return rows + rows[:3]


@pytest.mark.parametrize("chunk, gathered", [(64, 20), (300, 50), (1 << 19, 1 << 14)])
def test_family_of_suffix_arrays_equals_the_definition(monkeypatch, chunk, gathered):
    monkeypatch.setattr(suffix_index, "CHUNK", chunk)
    monkeypatch.setattr(suffix_index, "NEW_ENTRIES", gathered)
    monkeypatch.setattr(suffix_index, "SCAN_WINDOWS", 500)
    rng = random.Random(chunk)
    for _ in range(12):
        rows = [(d, t.encode()) for d, t in _corpus(rng, rng.randint(2, 40))]
        per, shards = rng.choice([1, 3, 100]), 3
        families, gone = [suffix_index.Family() for _ in range(shards)], []
        for b in range(0, len(rows), per):
            e, store, own = suffix_index.batch_entries(*map(list, zip(*rows[b:b + per])), b)
            gone.append(own)
            shard, _ = suffix_index._shard_of(e, shards)
            for s in range(shards):
                at = np.flatnonzero(shard == s)
                if len(at):
                    families[s].add(*suffix_index._unpack(suffix_index._pack(suffix_index._take(e, at), store), b))
        gone += [f.finish() for f in families]
        got = [np.zeros(len(t), bool) for _, t in rows]
        for b, i, s, t in zip(*(np.concatenate(x).tolist() for x in zip(*gone))):
            got[b + i][s:t] = True
        for a, b in zip(got, _gone(rows)):
            assert np.array_equal(a, b)


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(suffix_index, "_mixed", lambda h, w: h * 0)
    rows = [(1, b"a" * 20 + b"b" * 40), (2, b"a" * 20 + b"b" * 39 + b"c"), (3, b"a" * 20 + b"b" * 40)]
    _, _, gone = suffix_index.batch_entries([r[0] for r in rows], [r[1] for r in rows])
    covered = {(int(i), int(s), int(t)) for _, i, s, t in zip(*gone)}
    assert {(i, *x) for i, *x in covered if i == 2} and all(t <= 59 for i, s, t in covered if i == 1)


def test_levels_grow_geometrically(monkeypatch):
    monkeypatch.setattr(suffix_index, "NEW_ENTRIES", 10)
    family, rng = suffix_index.Family(), random.Random(2)
    for b in range(64):
        t = bytes(rng.choices(range(32, 127), k=600))
        e, store, _ = suffix_index.batch_entries([b], [t], b)
        family.add(*suffix_index._unpack(suffix_index._pack(e, store), b))
    sizes = [len(x["w0"]) for x in family.levels]
    assert len(sizes) <= 7 and all(a > b for a, b in zip(sizes, sizes[1:]))


def test_suffix_dedup_on_spark_equals_the_definition(spark, docs, empty):
    rng = random.Random(9)
    rows = _corpus(rng, 60) + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = _want([(d, (t or "").encode()) for d, t in rows])
    for size in (400, 1 << 20):
        got = suffix_index.dedup(clashing(df, ["batch", "payload", "kept", "n_bytes", "size"]), batch_bytes=size)
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()),
                      key=repr) == want
    odd = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix_index.dedup(docs).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=repr) == _want(
        [(d, (t or "").encode()) for d, t in odd])
    assert suffix_index.dedup(empty).count() == 0


# ---- source divergence -------------------------------------------------------------------

def _audit(rows, min_docs, top=50):
    counts, in_docs, groups = {}, Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts.setdefault((lang, source), Counter()).update(terms)
        in_docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in in_docs.items() if x == lang and n >= min_docs]
        own = {s: Counter({t: c for t, c in counts[(x, s)].items() if t in kept}) for x, s in groups if x == lang}
        whole = sum(own.values(), Counter())
        share = lambda c, t: 1 + 1000000000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in own.items():
            pairs = [(sum(abs(share(c, t) - share(d, t)) for t in kept), o) for o, d in own.items() if o != s]
            terms = [(share(c, t) - share(whole, t), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:limit])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("tree_items, held", [(1, 2), (500_000, 1_000_000)])
def test_divergence_equals_plain_loops(spark, monkeypatch, tree_items, held):
    monkeypatch.setattr(divergence, "TREE_ITEMS", tree_items)
    monkeypatch.setattr(divergence, "HELD_PAIRS", held)
    monkeypatch.setattr(divergence, "HELD_TERMS", 40)
    rng = random.Random(4)
    words = ["Wort", "wort", "LE", "le", "été", "ÉTÉ", "中文", "x1y", "don't", "a_b", "\x00", "of", "the"]
    rows = []
    for i in range(400):
        text = " ".join(rng.choices(words, [1, 2, 5, 9, 1, 1, 2, 3, 4, 1, 1, 20, 30], k=rng.randint(0, 25)))
        rows.append((text, rng.choice(["en", "de", None]), "s%d" % min(rng.randint(0, 9), 5)))
    rows += [(None, "en", "empty"), ("", "fr", "only"), ("le le", "xx", "a"), (None, "xx", "b"), (None, None, None)] + rows[:9]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    df = clashing(df, ["term", "n", "docs", "p", "place", "item"])
    got = divergence.audit(df, min_docs=30, top=3)
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect()), key=repr) == _audit(
        rows, 30, 3)


def test_tree_shares_paths_and_sums_each_pair_once():
    rng = np.random.default_rng(3)
    for _ in range(50):
        rows = sorted({tuple((int(s), int(rng.integers(1, 4)), 1) for s in np.flatnonzero(rng.random(5) < 0.6)) for _ in range(30)} - {()})
        times = rng.integers(1, 5, len(rows))
        flat = np.array([x for r in rows for x in r], np.int64).reshape(-1, 3)
        a, b, v = divergence.tree_corrections(np.array([len(r) for r in rows]), times, *flat.T)
        want = Counter()
        for r, n in zip(rows, times):
            for i, (s, p, p0) in enumerate(r):
                for t, q, q0 in r[i + 1:]:
                    want[(s, t)] += int(n) * (abs(q - p) - abs(q - p0) - abs(q0 - p) + abs(q0 - p0))
        assert {(x, y): s for x, y, s in zip(a.tolist(), b.tolist(), v.tolist())} == dict(want)
        assert len(set(zip(a.tolist(), b.tolist()))) == len(a)


def test_divergence_of_nothing(empty, docs):
    assert divergence.audit(empty).count() == 0
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert rows_of(divergence.audit(docs, min_docs=1).select("lang", "source", "part", "item", "value", "rank")) == _audit(rows, 1)
    # no kept term: pairs are equal, and there are no terms
    got = divergence.audit(docs, min_docs=1000)
    assert got.where((F.col("part") == "term") | (F.col("value") != 0)).count() == 0 and got.count() > 0


def test_a_shard_scans_few_large_batches_and_unites_what_is_covered(monkeypatch):
    """Arrivals of 40,000 entries are one batch, hence one scan."""
    import random
    import numpy as np
    from skumix.llm import suffix_index as X
    rng, scans, plain = random.Random(4), [], X.scan
    common = bytes(rng.choice(b"abcdefghij ") for _ in range(200))
    family = X.Family()
    for batch in range(5):
        text = bytes(rng.choice(b"abcdefghij ") for _ in range(150_000)) + b"%d" % batch + common
        e, store, _ = X.batch_entries([batch], [text], batch)
        family.add(e, store.bytes[:store.used])
    monkeypatch.setattr(X, "scan", lambda *a: scans.append(len(a[0]["w0"])) or plain(*a))
    got = X._interval_rows(family.finish())
    assert len(scans) == 1 and scans[0] > 1 << 15
    assert [(b, np.frombuffer(rows, "<u4").tolist()) for b, rows in got] == [
        (b, [0, 150_001, 150_201]) for b in range(1, 5)]
