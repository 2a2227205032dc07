"""Hidden Markov language model: Baum-Welch training, forward scoring.

A state emits a word class (a hash of the word's first bytes, a fixed
number of them), the class its words by their corpus counts, so the model
of a state is bounded while the vocabulary grows with the corpus.  An
unseen word is one extra word of its class; every text's probabilities,
end of text included, sum to one.

1. Texts are encoded once, in rows of about ``ROW_TOKENS`` tokens with a
   word list of their own; the rows are written to the shared folder.
2. Word counts: each row asks for its words by hash bucket.  A bucket sums
   the training counts of its words and answers every row; a very common
   word is one entry per row, never one per token.
3. Baum-Welch: scaled forward-backward over the training texts of every
   row, expected counts summed across partitions, a few numbers per class.
4. Scoring: the scaled forward recursion over every text, joined with the
   answers of step 2.

Defined results: null and empty texts are the end alone; repeated rows are
repeated training texts and get equal scores; an empty table gives an
empty result; without training texts N is 0 and every token unseen;
further columns are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import crc_mod, ids_and_text, written

STATES = 8
CLASSES = 8192       # word classes; class 0 is the end
PREFIX_BYTES = 4     # leading bytes of a word that decide its class
ROUNDS = 3           # Baum-Welch rounds after the start
ROW_TOKENS = 1_000_000
GROUP_TOKENS = 250_000  # tokens in one recursion
SMOOTH = 50.0        # pseudo-count of the corpus' class shares in a state
STICKY = 0.98        # first chance to stay in a state
FOLDS, HELD = 7, 2   # fixed values: held out when crc32(doc_id) mod 7 is 2


def word_class(word: bytes, classes: int = CLASSES) -> int:
    return zlib.crc32(word[:PREFIX_BYTES]) % (classes - 1) + 1


def _encode(buckets: int, kind: str):
    """Texts -> encoded rows (kind 0) and requests for word counts (kind 1)."""

    def pack(part, ids, held, lengths, tokens, local):
        import numpy as np
        words = list(local)
        bucket = np.array([zlib.crc32(w) % buckets for w in words], np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words), dtype=np.int32)
        seq = place[np.array(tokens, np.int32)] if tokens else np.zeros(0, np.int32)
        train = np.repeat(~np.array(held, bool), lengths)
        n = np.bincount(seq[train], minlength=len(words)).astype("<i4")
        classes = np.array([word_class(words[i]) for i in order], "<u2")
        ends = np.r_[np.nonzero(np.diff(bucket[order]))[0] + 1, len(words)] if words else np.zeros(0, int)
        rows = [{"kind": 0, "part": part, "doc_ids": ids, "held": held, "lengths": lengths,
                 "ids": seq.astype("<i4").tobytes(), "classes": classes.tobytes(),
                 "bucket": None, "base": None, "words": None, "n": None}]
        start = 0
        for end in ends.tolist():
            rows.append({"kind": 1, "part": part, "doc_ids": None, "held": None, "lengths": None,
                         "ids": None, "classes": None, "bucket": int(bucket[order[start]]), "base": start,
                         "words": [words[i] for i in order[start:end]], "n": n[start:end].tobytes()})
            start = end
        return rows

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        schema = pa.schema([
            ("kind", pa.int32()), ("part", pa.int64()), ("doc_ids", pa.list_(kind)),
            ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()),
            ("classes", pa.binary()), ("bucket", pa.int32()), ("base", pa.int32()),
            ("words", pa.list_(pa.binary())), ("n", pa.binary())])
        first = TaskContext.get().partitionId() << 32
        ids, held, lengths, tokens, local, made = [], [], [], [], {}, 0
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for i in range(b.num_rows):
                words = texts[i].as_py().lower().split()
                for w in words:
                    if w not in local:
                        local[w] = len(local)
                tokens += map(local.__getitem__, words)
                ids.append(b.column("doc_id")[i].as_py())
                held.append(b.column("held")[i].as_py())
                lengths.append(len(words))
                if len(tokens) >= ROW_TOKENS:
                    yield pa.RecordBatch.from_pylist(pack(first + made, ids, held, lengths, tokens, local), schema)
                    ids, held, lengths, tokens, local = [], [], [], [], {}
                    made += 1
        if ids:
            yield pa.RecordBatch.from_pylist(pack(first + made, ids, held, lengths, tokens, local), schema)

    return run


def _answer(batches: Iterator) -> Iterator:
    """Requests in order of bucket -> answers (kind 0) and class sums (kind 1)."""
    import numpy as np
    import pyarrow as pa
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int64()), ("base", pa.int32()),
                        ("c", pa.binary()), ("cls", pa.int32()), ("s", pa.int64()), ("d", pa.int64())])

    def bucket(rows):
        total: dict[bytes, int] = {}
        for r in rows:
            for w, n in zip(r["words"], np.frombuffer(r["n"], "<i4").tolist()):
                total[w] = total.get(w, 0) + n
        for r in rows:
            c = np.fromiter((total[w] for w in r["words"]), "<i8", len(r["words"]))
            yield {"kind": 0, "part": r["part"], "base": r["base"], "c": c.tobytes()}
        sums: dict[int, list[int]] = {}
        for w, n in total.items():
            if n:
                x = sums.setdefault(word_class(w), [0, 0])
                x[0] += n
                x[1] += 1
        for k, (s, d) in sums.items():
            yield {"kind": 1, "cls": k, "s": s, "d": d}

    now, rows = None, []
    for b in batches:
        for r in b.to_pylist():
            if r["bucket"] != now and rows:
                yield pa.RecordBatch.from_pylist(list(bucket(rows)), schema)
                rows = []
            now = r["bucket"]
            rows.append(r)
    if rows:
        yield pa.RecordBatch.from_pylist(list(bucket(rows)), schema)


def groups(lengths, tokens_per_group: int = GROUP_TOKENS):
    """Indices of texts of similar length, longest first, in groups."""
    import numpy as np
    order = np.argsort(-lengths, kind="stable")
    size = np.cumsum(lengths[order])
    start = 0
    while start < len(order):
        end = int(np.searchsorted(size, (size[start - 1] if start else 0) + tokens_per_group, "right"))
        end = max(end, start + 1)
        yield order[start:end]
        start = end


def by_time(starts, lengths):
    """For texts (longest first): where each time step's tokens are in the
    flat input, the steps' offsets, and the place of each text at a step."""
    import numpy as np
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than t
    offsets = np.r_[0, np.cumsum(active)]
    t = np.repeat(np.arange(steps), active)
    d = np.arange(offsets[-1]) - offsets[t]
    return starts[d] + t, offsets, t, d


def forward(model, classes, starts, lengths):
    """Scaled forward recursion: (alpha and scale by time, log10 likelihoods)."""
    import numpy as np
    start, trans, emit = model
    where, offsets, _, d = by_time(starts, lengths)
    obs = emit.T[classes[where]]
    alpha, scale = np.empty_like(obs), np.empty(len(obs))
    for t in range(len(offsets) - 1):
        a, b = offsets[t], offsets[t + 1]
        x = obs[a:b] * (start if t == 0 else alpha[offsets[t - 1]:offsets[t - 1] + b - a] @ trans)
        s = x.sum(axis=1)
        scale[a:b] = s
        np.divide(x, s[:, None], out=alpha[a:b])
    return alpha, scale, obs, where, offsets, np.bincount(d, np.log10(scale), len(starts))


def expected(model, classes, starts, lengths, counts) -> None:
    """Adds a group's expected start, transition and emission counts."""
    import numpy as np
    start, trans, emit = model
    alpha, scale, obs, where, offsets, _ = forward(model, classes, starts, lengths)
    beta = np.ones_like(alpha)
    weighed = obs / scale[:, None]
    for t in range(len(offsets) - 2, 0, -1):
        a, b = offsets[t], offsets[t + 1]
        weighed[a:b] *= beta[a:b]
        p = offsets[t - 1]
        np.matmul(weighed[a:b], trans.T, out=beta[p:p + b - a])
    gamma = alpha * beta
    counts[0] += gamma[:offsets[1]].sum(axis=0)
    if len(offsets) > 2:
        # the token before the one at offset[t] + d lies at offset[t - 1] + d
        now = np.arange(offsets[1], offsets[-1])
        t = np.repeat(np.arange(1, len(offsets) - 1), np.diff(offsets)[1:])
        before = now - offsets[t] + offsets[t - 1]
        counts[1] += trans * (alpha[before].T @ weighed[now])
    for k in range(len(start)):
        counts[2][k] += np.bincount(classes[where], gamma[:, k], emit.shape[1])


def _sequences(row):
    """Class of every token with the ends put in, starts and lengths of the texts."""
    import numpy as np
    n = np.array(row["lengths"], np.int64)
    cls = np.frombuffer(row["classes"], "<u2")[np.frombuffer(row["ids"], "<i4")].astype(np.int64)
    lengths = n + 1
    starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    out = np.zeros(int(lengths.sum()), np.int64)
    keep = np.ones(len(out), bool)
    keep[starts + n] = False
    out[keep] = cls
    return out, starts, lengths


def _rows(batches: Iterator) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _sum_counts(state):
    """Encoded rows -> this task's expected counts, one row per class.  Without
    a model each text lies in one state, by its most frequent class."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        model = state.value.get("model")
        counts = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES))]
        for row in _rows(batches):
            classes, starts, lengths = _sequences(row)
            train = np.nonzero(~np.array(row["held"], bool))[0]
            if model is None:
                for i in train.tolist():
                    c = classes[starts[i]:starts[i] + lengths[i]]
                    words = np.bincount(c, minlength=CLASSES)
                    k = int(words[1:].argmax()) % STATES if lengths[i] > 1 else 0
                    counts[0][k] += 1
                    counts[2][k] += words
            else:
                for g in groups(lengths[train]):
                    g = train[g]
                    expected(model, classes, starts[g], lengths[g], counts)
        table = np.concatenate([counts[0][:, None], counts[1], counts[2]], axis=1)
        used = np.nonzero(table.any(axis=0))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array(table[k, used]) for k in range(STATES))],
            ["col", *(f"k{k}" for k in range(STATES))])

    return run


def train(tokens: DataFrame, shares, rounds: int = ROUNDS):
    """(start, transitions, emissions) by Baum-Welch over the encoded rows."""
    import numpy as np
    sc = tokens.sparkSession.sparkContext
    names = [f"k{k}" for k in range(STATES)]
    model = None
    for _ in range(rounds + 1):
        bc = sc.broadcast({"model": model})
        sums = (tokens.select("held", "lengths", "ids", "classes")
                .mapInArrow(_sum_counts(bc), "col int, " + ", ".join(f"{n} double" for n in names))
                .groupBy("col").agg(*(F.sum(n).alias(n) for n in names)))
        table = np.zeros((STATES, 1 + STATES + CLASSES))
        for r in sums.collect():  # one row per class and state at most
            table[:, r["col"]] = r[1:]
        start = (table[:, 0] + 1) / (table[:, 0].sum() + STATES)
        if model is None:
            trans = np.full((STATES, STATES), (1 - STICKY) / (STATES - 1))
            np.fill_diagonal(trans, STICKY)
        else:
            moves = table[:, 1:1 + STATES] + 0.1
            trans = moves / moves.sum(axis=1, keepdims=True)
        emit = table[:, 1 + STATES:] + SMOOTH * shares
        model = (start, trans, emit / emit.sum(axis=1, keepdims=True))
    return model


def score(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    import numpy as np
    import pyarrow as pa
    spark = docs.sparkSession
    d = ids_and_text(docs, id_col, text_col)
    d = d.select("doc_id", "text", F.coalesce(crc_mod(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held"))
    kind = d.schema["doc_id"].dataType.simpleString()
    arrow = to_arrow_type(d.schema["doc_id"].dataType)
    buckets = max(32, 2 * d.rdd.getNumPartitions())
    rows = written(d.mapInArrow(
        _encode(buckets, arrow), f"kind int, part long, doc_ids array<{kind}>, held array<boolean>, "
        "lengths array<int>, ids binary, classes binary, bucket int, base int, words array<binary>, n binary"),
        "hmm-rows")
    tokens = rows.where("kind = 0").select("part", "doc_ids", "held", "lengths", "ids", "classes")
    asked = rows.where("kind = 1").select("bucket", "part", "base", "words", "n")
    answers = written(asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _answer, "kind int, part long, base int, c binary, cls int, s long, d long"), "hmm-answers")
    per_class = (answers.where("kind = 1").groupBy("cls")
                 .agg(F.sum("s").alias("s"), F.sum("d").alias("d")).collect())  # CLASSES rows at most
    n_train = tokens.select(F.explode("held").alias("h")).where("not h").count()
    s, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in per_class:
        s[r["cls"]], distinct[r["cls"]] = r["s"], r["d"]
    s[0], distinct[0] = n_train, int(n_train > 0)
    total, vocabulary = int(s.sum()), int(distinct.sum())
    model = train(tokens, (s + 1) / (total + CLASSES), rounds)
    state = spark.sparkContext.broadcast({
        "model": model, "total": total, "all": total + vocabulary + 1, "n_end": n_train,
        # log10 of a class's words and its unseen word; the end is alone in its class
        "inside": np.log10(np.where(np.arange(CLASSES) == 0, s + 1, s + distinct + 1))})

    def run(batches: Iterator) -> Iterator:
        x = state.value
        base_of = np.log10(x["all"])
        for row in _rows(batches):
            classes, starts, lengths = _sequences(row)
            c = np.zeros(len(row["classes"]) // 2, np.int64)
            for a in row["answers"] or ():
                got = np.frombuffer(a["c"], "<i8")
                c[a["base"]:a["base"] + len(got)] = got
            of_token = np.full(len(classes), x["n_end"], np.int64)
            inner = np.ones(len(classes), bool)
            inner[starts + lengths - 1] = False
            of_token[inner] = c[np.frombuffer(row["ids"], "<i4")]
            log_count = np.log10(of_token + 1)
            base = np.add.reduceat(log_count - base_of, starts)
            known = np.add.reduceat((of_token > 0).astype(np.int64), starts)
            inside = np.add.reduceat(log_count - x["inside"][classes], starts)
            path = np.zeros(len(starts))
            for g in groups(lengths):
                path[g] = forward(x["model"], classes, starts[g], lengths[g])[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], arrow), pa.array(row["held"]), pa.array(lengths), pa.array(known),
                 pa.array(np.full(len(starts), x["total"], np.int64)), pa.array(base), pa.array(path + inside)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    # a row asks at most once per bucket: the list is no longer than its words
    given = (answers.where("kind = 0").groupBy("part")
             .agg(F.collect_list(F.struct("base", "c")).alias("answers")))
    joined = tokens.join(given, "part", "left").drop("part")
    return joined.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
                             "train_tokens long, base_score double, score double")
