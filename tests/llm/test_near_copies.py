"""SimHash and embedding near-duplicates against all pairs, components."""

import random

import numpy as np
import xxhash

from llm_helpers import clashing
from skumix.llm import embed_lsh, simhash
from skumix.llm.components import components


def _groups(n, links):
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def _slow_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_of_random_graphs_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]                   # a path
    edges += [(2000, 2001 + i) for i in range(500)] + [(7, 7), (3, 5), (5, 3)]  # a star, loops, repeats
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    nodes = sorted({x for e in edges for x in e})
    at = {x: i for i, x in enumerate(nodes)}
    roots = _groups(len(nodes), [(at[a], at[b]) for a, b in edges])
    want = {x: nodes[roots[at[x]]] for a, b in edges for x in (a, b) if a != b}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long"), "t").count() == 0


def test_links_equal_all_pairs(spark):
    """Balls of fingerprints around centers, dense and sparse, one large."""
    rng = random.Random(4)
    fps = set()
    for size in (400, 40, 8, 3):
        center = rng.getrandbits(64)
        for _ in range(size):
            f = center
            for b in rng.sample(range(64), rng.randint(0, 4)):
                f ^= 1 << b
            fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(300)} | {0, 1, (1 << 64) - 1, 1 << 63}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    a = np.array(fps, np.uint64)
    pairs = [(i, int(j)) for i in range(len(a)) for j in np.nonzero(np.bitwise_count(a ^ a[i]) <= 4)[0] if j > i]
    want = _groups(len(a), pairs)
    found = [(r.u, r.v) for r in simhash.links(df).collect()]
    at = {x: i for i, x in enumerate(signed)}
    assert all(bin((u ^ v) & (2 ** 64 - 1)).count("1") <= 4 for u, v in found)
    got = _groups(len(a), [(at[u], at[v]) for u, v in found])
    assert got == want


def test_slices_of_a_hot_prefix_give_the_same_links(spark, monkeypatch):
    rng = random.Random(6)
    center = rng.getrandbits(64)
    fps = {center ^ sum(1 << b for b in rng.sample(range(48), rng.randint(0, 4))) for _ in range(300)}
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")

    def groups():
        return {frozenset(g) for g in _by_root(components(simhash.links(df), "t").collect()).values()}

    whole = groups()
    monkeypatch.setattr(simhash, "SLICE_VARIANTS", 20_000)
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 64)
    assert groups() == whole


def _by_root(rows):
    out = {}
    for r in rows:
        out.setdefault(r.root, []).append(r.node)
    return out


def test_simhash_over_odd_rows(spark, docs, empty):
    got = simhash.simhash_components(clashing(docs, ["fp", "h", "root", "component_id"])).collect()
    assert len(got) == docs.count()
    fp = {r.doc_id: r.fingerprint for r in got}
    for r in docs.collect():
        assert fp[r.doc_id] == f"{_slow_fingerprint(r.text or ''):016x}"
    comp = {r.doc_id: r.component_id for r in got}
    assert comp[2] == comp[3] == comp[4] == 2 and comp[5] == 5 and comp[None] is None
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 5, 6]
    assert kept.where("doc_id is null").count() == 1
    assert simhash.keep_first(empty).count() == 0


def test_simhash_query_equals_all_pairs(spark):
    from skumix.llm import queries
    d = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    ids = sorted(text)
    a = np.array([_slow_fingerprint(text[i]) for i in ids], np.uint64)
    pairs = [(i, int(j)) for i in range(len(a)) for j in np.nonzero(np.bitwise_count(a ^ a[i]) <= 4)[0] if j > i]
    roots = _groups(len(a), pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op2_simhash_near_dedup(spark, d).collect()}
    assert got == {x: (f"{int(f):016x}", ids[r]) for x, f, r in zip(ids, a, roots)}


VEC = "vec_id long, embedding array<float>, label int"


def _vectors(seed=1, n=250, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = base[:60] + rng.normal(size=(60, dim)) * 0.12
    dense = base[0] + rng.normal(size=(120, dim)) * 0.05
    rows = [(i, v.astype(np.float32).tolist(), i % 3) for i, v in enumerate(np.vstack([base, near, dense]))]
    return rows


def _brute(rows):
    u = embed_lsh.unit_rows(np.array([r[1] for r in rows], np.float32))
    s = u @ u.T >= embed_lsh.THRESHOLD
    np.fill_diagonal(s, False)
    roots = _groups(len(rows), list(zip(*np.nonzero(s))))
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min(least.get(root, r[0]), r[0])
    return {r[0]: (int(n), least[root]) for r, n, root in zip(rows, s.sum(1), roots)}


def test_embeddings_equal_brute_force_with_odd_rows(spark, monkeypatch):
    rows = _vectors()
    copies = [(5000 + i, rows[3][1], 0) for i in range(90)]   # a large group of exact copies
    odd = [(9000, None, 1), (9001, [0.0] * 24, 1), (9002, [float("nan")] * 24, 1), (9003, [], 1),
           (9004, [float("inf")] + [1.0] * 23, 1), (9005, [None] + [1.0] * 23, 1), (9006, [1.0, 0.0], 1)]
    df = clashing(spark.createDataFrame(rows + copies + odd, VEC).repartition(4), ["n", "node", "codes"])
    want = _brute(rows + copies) | {o[0]: (0, o[0]) for o in odd}
    for block in (2048, 50):  # unsplit, and with split buckets
        monkeypatch.setattr(embed_lsh, "BLOCK", block)
        got = {r.vec_id: (r.n_links, r.component_id) for r in embed_lsh.near_duplicates(df).collect()}
        assert set(got) == set(want)
        links = sum(n for n, _ in want.values())
        assert sum(n for n, _ in got.values()) >= 0.99 * links
        assert all(got[k][0] <= want[k][0] for k in want)
        assert sum(got[k] != want[k] for k in want) <= 0.01 * len(want)
    empty = spark.createDataFrame([], VEC)
    assert embed_lsh.near_duplicates(empty).count() == 0


def test_recall_at_the_threshold_itself():
    """Pairs of cosine exactly 0.95, the hardest to find."""
    rng = np.random.default_rng(3)
    a = embed_lsh.unit_rows(rng.normal(size=(2000, 64)))
    r = rng.normal(size=a.shape)
    r = embed_lsh.unit_rows(r - (r * a).sum(1, keepdims=True) * a)
    b = 0.95 * a + (1 - 0.95 ** 2) ** 0.5 * r
    t, _ = embed_lsh._first_meeting(embed_lsh.codes(a), embed_lsh.codes(b), embed_lsh.TABLES)
    assert (t >= 0).mean() > 0.99


def test_first_meeting_is_in_any_shared_bucket():
    rng = np.random.default_rng(4)
    a = embed_lsh.unit_rows(rng.normal(size=(3000, 64)))
    b = embed_lsh.unit_rows(a + 0.07 * rng.normal(size=a.shape))
    ci, cj = embed_lsh.codes(a), embed_lsh.codes(b)
    for first in (0, 5):  # from all tables, and from the last alone
        x, y = ci[:, first:], cj[:, first:]
        t, at = embed_lsh._first_meeting(x, y, x.shape[1])
        for i in range(len(a)):
            both = [(k, min(set(x[i, k]) & set(y[i, k]))) for k in range(x.shape[1]) if set(x[i, k]) & set(y[i, k])]
            assert (t[i], at[i]) == (both[0] if both else (-1, 0))


def test_links_in_two_dimensions_count_once(spark):
    angles = [0.01 * i for i in range(40)]
    rows = [(i, [float(np.cos(x)), float(np.sin(x))]) for i, x in enumerate(angles)]
    got = {r.vec_id: r.n_links for r in embed_lsh.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = {i: sum(np.cos(x - y) >= 0.95 for y in angles) - 1 for i, x in enumerate(angles)}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.9 * sum(want.values())


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(embed_lsh.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embed_lsh.hadamard(embed_lsh.hadamard(x)), x)
