"""Quality classifier: random-indexing word vectors and a two-layer network.

Random indexing: every word and every word shape has a fixed sparse ternary
index vector; a word's vector is the sum of the index vectors of the words
around it over the whole corpus, a shape's that of the shapes around it
(letters and digits collapsed, symbols kept).  Words are dealt to a fixed
number of buckets by their hash, so what tasks hold and what is broadcast
(TERMS x WIDTH numbers) does not grow with the corpus: words of one bucket
share a vector.  Integer sums make the result independent of partitioning.

A document's input is the mean and spread of its terms' vectors with its
length and share of distinct words.  A two-layer numpy network is fitted
on a bounded labelled sample (``per_class`` rows of each class, a
documented parameter) and its probabilities are calibrated by one
temperature on rows it has not seen.

Defined results: null and empty texts are scored from the zero vector;
repeated rows get equal scores; without labels of both classes every score
is the share of good labels (1.0 without any); an empty table gives an
empty result; further columns are ignored."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, ids_and_text, labelled_sample

WORDS = 8192       # word buckets
SHAPES = 1024      # shape buckets
TERMS = WORDS + SHAPES
WIDTH = 64         # numbers of a word vector
NONZERO = 8        # signs in an index vector
REACH = 2          # neighbours on either side
HIDDEN = 32
PER_CLASS = 4000   # bound of the labelled sample, rows of each class
THRESHOLD = 0.5    # fixed value: predicted = 1 from this score on
MEMO_WORDS = 200_000
CHUNK = 1 << 16    # words whose neighbours are summed at once
SEED = 10

MARKS = frozenset(",.;:!?")  # signs that most often end a word
LOWER, UPPER, DIGIT = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")


def shape(word: str) -> str:
    """Runs of lower-case letters, capitals and digits as one sign each;
    repeated symbols once."""
    if word.isalpha() and word.islower():  # most words
        return "a"
    if word[-1:] in MARKS and word[:-1].isalpha() and word[:-1].islower():
        return "a" + word[-1]
    return _any_shape(word)


def _any_shape(word: str) -> str:
    s = DIGIT.sub("9", UPPER.sub("A", LOWER.sub("a", word)))
    return re.sub(r"(.)\1+", r"\1", s)


def index_vectors(size: int = SHAPES, seed: int = SEED):
    """(size, WIDTH) sparse ternary index vectors, from a fixed seed."""
    import numpy as np
    rng = np.random.default_rng(seed)
    r = np.zeros((size, WIDTH), np.int8)
    for row in r:
        row[rng.choice(WIDTH, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return r


def _add_words(total, ids, start: int, size: int, index) -> None:
    """Add to ``total[t]`` the index vectors of the neighbours of every
    occurrence of word t at ``start`` to ``start + size`` of the row ``ids``
    (-1: a gap between texts)."""
    import numpy as np
    own = index[ids]
    own[ids < 0] = 0
    around = np.zeros_like(own)  # at most 2 * REACH signs: 8 bits hold their sum
    for o in range(1, REACH + 1):
        around[o:] += own[:-o]
        around[:-o] += own[o:]
    ids, around = ids[start:start + size], around[start:start + size]
    order = np.argsort(ids, kind="stable")
    order = order[np.searchsorted(ids[order], 0):]  # gaps have no vector
    if len(order):
        first = np.flatnonzero(np.r_[True, np.diff(ids[order]) > 0])
        total[ids[order[first]]] += np.add.reduceat(around[order], first, axis=0, dtype=np.int64)


class Terms:
    """Word -> (word bucket, shape bucket), remembered up to a bound."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def of(self, text: str):
        import numpy as np
        words = text.split()
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in set(words):
            if w in memo:
                continue
            memo[w] = (zlib.crc32(w.lower().encode()) % WORDS) * SHAPES + zlib.crc32(shape(w).encode()) % SHAPES
        both = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        return both // SHAPES, both % SHAPES


def _terms(state: dict) -> Terms:
    if "terms" not in state:
        state["terms"] = Terms()
    return state["terms"]


def word_vectors(docs: DataFrame):
    """(TERMS, WIDTH) integer context vectors summed over all texts."""
    import numpy as np
    bc = docs.sparkSession.sparkContext.broadcast({})
    names = [f"v{i}" for i in range(WIDTH)]

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        terms = _terms(bc.value)
        words, shapes = index_vectors(WORDS, SEED + 1), index_vectors()
        total = np.zeros((TERMS, WIDTH), np.int64)
        seen = np.zeros((SHAPES, SHAPES), np.int64)  # neighbours of every shape
        gap = np.full(REACH, -1)  # between texts: no neighbours across

        def tally(texts):
            # texts side by side; the gap's index vector is zero
            w = np.concatenate([x for a, _ in texts for x in (a, gap)])
            s = np.concatenate([x for _, b in texts for x in (b, gap)])
            for at in range(0, len(w), CHUNK):  # each occurrence once, its neighbours beside it
                lo, hi = max(0, at - REACH), min(len(w), at + CHUNK + REACH)
                _add_words(total, w[lo:hi], at - lo, min(CHUNK, len(w) - at), words)
            for o in range(1, REACH + 1):
                a, b = s[o:], s[:-o]
                both = (a >= 0) & (b >= 0)
                pairs = np.bincount(a[both] * SHAPES + b[both], minlength=SHAPES * SHAPES).reshape(SHAPES, SHAPES)
                seen[:] += pairs + pairs.T

        for b in batches:
            texts, held = [], 0
            for text in b.column("text").to_pylist():
                texts.append(terms.of(text))
                held += len(texts[-1][0])
                if held > 4 * CHUNK:
                    tally(texts)
                    texts, held = [], 0
            if texts:
                tally(texts)
        total[WORDS:] = seen @ shapes.astype(np.int64)
        used = np.nonzero(total.any(axis=1))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(np.ascontiguousarray(total[used, i])) for i in range(WIDTH))],
            ["term", *names])

    sums = (docs.select("text").mapInArrow(count, "term int, " + ", ".join(f"{n} long" for n in names))
            .groupBy("term").agg(*(F.sum(n).alias(n) for n in names)))
    out = np.zeros((TERMS, WIDTH))
    for r in sums.collect():  # at most TERMS rows
        out[r["term"]] = r[1:]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(length > 0, length, 1)).astype(np.float32)


def document_inputs(terms: Terms, vectors, text: str):
    """Mean and spread of the term vectors, log length, share of distinct words."""
    import numpy as np
    w, s = terms.of(text)
    out = np.zeros(4 * WIDTH + 2)
    if not len(w):
        return out
    for k, ids in enumerate((w, WORDS + s)):
        if k:  # few shapes: their counts times their vectors
            counts = np.bincount(s, minlength=SHAPES)
            own = np.nonzero(counts)[0]
            v, n = vectors[WORDS + own].astype(np.float64), counts[own]
            mean, square = n @ v / len(w), n @ (v * v) / len(w)
        else:
            mean, square = np.zeros(WIDTH), np.zeros(WIDTH)
            for i in range(0, len(w), 4096):  # bounded memory for long texts
                v = vectors[ids[i:i + 4096]]
                mean += v.sum(axis=0)
                square += (v * v).sum(axis=0)
            mean, square = mean / len(w), square / len(w)
        out[2 * k * WIDTH:(2 * k + 1) * WIDTH] = mean
        out[(2 * k + 1) * WIDTH:(2 * k + 2) * WIDTH] = np.sqrt(np.maximum(square - mean ** 2, 0))
    out[-2], out[-1] = np.log1p(len(w)), len(set(text.split())) / len(w)
    return out


def forward(net: dict, x):
    """Logits of input rows."""
    import numpy as np
    h = np.tanh(((x - net["center"]) / net["scale"]) @ net["w1"] + net["b1"])
    return h @ net["w2"] + net["b2"]


def fit_network(x, y, weight, hidden: int = HIDDEN, steps: int = 1500, rate: float = 3e-3,
                decay: float = 1e-4, seed: int = SEED) -> dict:
    """Two-layer network by Adam on the weighted log loss (bounded rows)."""
    import numpy as np
    rng = np.random.default_rng(seed)
    net = {"center": x.mean(0), "scale": np.maximum(x.std(0), 1e-3)}
    p = {"w1": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), "b1": np.zeros(hidden),
         "w2": rng.normal(0, hidden ** -0.5, hidden), "b2": np.zeros(())}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    z = (x - net["center"]) / net["scale"]
    for step in range(1, steps + 1):
        rows = rng.choice(len(z), min(256, len(z)), replace=False)
        a, t, w = z[rows], y[rows], weight[rows]
        h = np.tanh(a @ p["w1"] + p["b1"])
        e = w * (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -30, 30))) - t) / w.sum()
        back = np.outer(e, p["w2"]) * (1 - h ** 2)
        g = {"w1": a.T @ back + decay * p["w1"], "b1": back.sum(0), "w2": h.T @ e + decay * p["w2"], "b2": e.sum()}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    return net | p


def fit_temperature(logits, y, weight) -> float:
    """The temperature with the least weighted log loss."""
    import numpy as np

    def loss(t: float) -> float:
        z = logits / t
        return float((weight * (np.logaddexp(0, z) - y * z)).sum())

    return min(np.geomspace(0.25, 16, 121).tolist(), key=loss)


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """Plain data of the fitted model, to be broadcast."""
    import numpy as np
    d = ids_and_text(docs)
    sample, totals = labelled_sample(docs, labels, "quality", per_class, "quality-sample")
    if not all(totals):
        return {"constant": totals[1] / sum(totals) if sum(totals) else 1.0}
    vectors = word_vectors(d)
    bc = docs.sparkSession.sparkContext.broadcast({"vectors": vectors})

    def inputs(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            f = [document_inputs(_terms(bc.value), bc.value["vectors"], t).tolist()
                 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("y"), b.column("calib"), pa.array(f, pa.list_(pa.float64()))], ["y", "calib", "f"])

    # at most 2 * per_class rows; sorted, so that the fit does not depend on partitioning
    rows = sorted(((r["calib"], r["y"], r["f"]) for r in sample.select("y", "calib", "text").mapInArrow(
        inputs, "y int, calib boolean, f array<double>").collect()))
    x = np.array([r[2] for r in rows])
    y, calib = np.array([r[1] for r in rows], float), np.array([r[0] for r in rows], bool)
    if len(set(y[~calib])) < 2:
        return {"constant": totals[1] / sum(totals)}
    share = np.where(y == 1, totals[1] / max(1, y.sum()), totals[0] / max(1, (1 - y).sum()))
    net = fit_network(x[~calib], y[~calib], share[~calib])
    held = calib if calib.any() else ~calib
    net["temperature"] = fit_temperature(forward(net, x[held]), y[held], share[held])
    return {"net": net, "vectors": vectors}


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    bc = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, per_class))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        m = bc.value
        for b in batches:
            texts = b.column("text").to_pylist()
            if "constant" in m:
                p = np.full(len(texts), float(m["constant"]))
            else:
                x = np.array([document_inputs(_terms(m), m["vectors"], t) for t in texts])
                z = forward(m["net"], x.reshape(len(texts), -1)) / m["net"]["temperature"] if texts else np.zeros(0)
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    d = ids_and_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()
    out = d.mapInArrow(run, f"doc_id {kind}, score double")
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
