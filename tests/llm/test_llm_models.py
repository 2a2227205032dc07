"""Quality rules, HMM, toxicity and quality classifier."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_helpers import LONG, clashing, rows_of
from skumix.llm import common, hmm, quality_net, quality_rules, toxicity

SF = "/root/testdata/sf0.01"


def _brute_metrics(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_quality_metrics_equal_brute_force(spark, docs, empty):
    rng = random.Random(8)
    rows = [(100 + i, "".join(rng.choice(["a ", "b ", "c\n", "# ", "é ", "\t", "\v", " ", "a b c d e f g h "])
                              for _ in range(rng.randint(0, 80))), "en", "a", 0) for i in range(60)]
    d = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    q = quality_rules.quality_metrics(clashing(d, ["n_words", "m", "kept", "__w"]))
    got = rows_of(q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert got == sorted(((r.doc_id, *_brute_metrics(r.text or "")) for r in d.collect()), key=repr)
    assert quality_rules.quality_metrics(empty).count() == 0


def test_quality_rules_decide_and_keep_columns(spark, empty):
    good = " ".join(["the house of the man is on the hill and it was old"] + [f"word{i} and" for i in range(20)])
    rows = [(1, good, "en", "a", 1), (2, "short text", "en", "a", 1), (3, None, None, None, None),
            (4, " ".join(f"w{i}### the" for i in range(40)), "en", "a", 1),
            (5, " ".join(["same words again and again in the line"] * 12), "en", "a", 1),
            (6, good.upper() + "!!" * 60, "en", "a", 1), (7, " ".join(f"zz{i}" for i in range(60)), "en", "a", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, quality_metrics long")
    got = {r.doc_id: r for r in quality_rules.quality_metrics(d).collect()}
    assert got[1].kept and not any(got[i].kept for i in (2, 3, 4, 5, 6, 7))
    assert got[2].base_failed and got[3].base_failed and got[5].base_failed and not got[4].base_failed
    assert "symbols" in got[4].failed_rules and "stop_words" in got[7].failed_rules
    kept = quality_rules.keep_good(d)
    assert kept.columns == d.columns and rows_of(kept) == [rows[0]]
    assert quality_rules.keep_good(empty).count() == 0


def test_quality_plan_has_no_python_and_no_shuffle(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    for q in (quality_rules.quality_metrics(d), quality_rules.keep_good(d)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def _random_model(rng, states, classes):
    def rows(*shape):
        x = rng.random(shape) + 0.05
        return x / x.sum(axis=-1, keepdims=True)
    return rows(states), rows(states, states), rows(states, classes)


def test_forward_and_expected_counts_equal_all_paths():
    rng = np.random.default_rng(0)
    model = _random_model(rng, 3, 5)
    lengths = np.array([4, 4, 3, 1])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    classes = rng.integers(0, 5, lengths.sum())
    out = hmm.forward(model, classes, starts, lengths)[-1]
    counts = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    hmm.expected(model, classes, starts, lengths, counts)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    for i, (s, n) in enumerate(zip(starts, lengths)):
        seq, total, each = classes[s:s + n], 0.0, []
        for path in itertools.product(range(3), repeat=int(n)):
            p = model[0][path[0]] * model[2][path[0], seq[0]]
            for t in range(1, n):
                p *= model[1][path[t - 1], path[t]] * model[2][path[t], seq[t]]
            total += p
            each.append((path, p))
        assert out[i] == pytest.approx(math.log10(total))
        for path, p in each:
            want[0][path[0]] += p / total
            for t in range(n):
                want[2][path[t], seq[t]] += p / total
                if t:
                    want[1][path[t - 1], path[t]] += p / total
    for a, b in zip(counts, want):
        assert np.allclose(a, b)


def test_baum_welch_rounds_do_not_lower_the_likelihood(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    held = []
    for rounds in (0, 1, 3):
        r = hmm.score(d, rounds=rounds).where("not held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
        held.append(r.s)
        assert r.s > r.b
    assert held[0] < held[1] < held[2]


def test_hmm_columns_over_odd_rows(spark, docs, empty):
    d = docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet").limit(60))
    got = hmm.score(clashing(d, ["held", "n_tokens", "score", "part"])).collect()
    rows = d.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 if r.doc_id is not None else False for r in rows}
    words = [(r.doc_id, (r.text or "").encode().lower().split()) for r in rows]
    c = Counter()
    for i, w in words:
        if not held[i]:
            c.update(w)
            c["<end>"] += 1
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), held[i], len(w) + 1, sum(c.get(x, 0) > 0 for x in [*w, "<end>"]), n,
                   round(sum(math.log10((c.get(x, 0) + 1) / (n + v + 1)) for x in [*w, "<end>"]), 4)) for i, w in words)
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                  for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert hmm.score(empty).count() == 0


def test_hmm_probabilities_sum_to_one(spark, monkeypatch):
    """Of a trained model: all first tokens, all second tokens after a first
    one, and all words of a class with the unseen one."""
    models, train = [], hmm.train

    def kept(*a):
        models.append((a[1], train(*a)))
        return models[-1][1]

    monkeypatch.setattr(hmm, "train", kept)
    words = ["alpha", "beta", "gamma", "delta", "alphabet", "a"]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(60)]
    # each word alone, an unseen word of alpha's class (the same first bytes), and the empty text
    asked = [w for w in words] + ["alphorn", ""]
    held = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 7 == 2][:len(asked)]
    d = spark.createDataFrame(rows + list(zip(held, asked)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in hmm.score(d).collect()}
    shares, (start, trans, emit) = models[0]
    assert start.sum() == pytest.approx(1) and np.allclose(trans.sum(1), 1) and np.allclose(emit.sum(1), 1)
    assert shares.sum() == pytest.approx(1)
    every = np.arange(hmm.CLASSES)
    one = hmm.forward((start, trans, emit), every, every, np.ones(len(every), np.int64))[-1]
    assert (10 ** one).sum() == pytest.approx(1)
    first = hmm.word_class(b"alpha")
    pairs = np.column_stack([np.full(len(every), first), every]).reshape(-1)
    two = hmm.forward((start, trans, emit), pairs, 2 * every, np.full(len(every), 2))[-1]
    assert (10 ** two).sum() == pytest.approx(10 ** one[first])
    # alpha, alphabet and the unseen alphorn share a class: their texts have its probability
    assert hmm.word_class(b"alphabet") == hmm.word_class(b"alphorn") == first
    score = dict(zip(asked, (got[i] for i in held)))
    both = sum(10 ** score[w] for w in ("alpha", "alphabet", "alphorn"))
    assert both == pytest.approx(10 ** two[0]) and 10 ** score[""] == pytest.approx(10 ** one[0])


def test_toxicity_finds_planted_words_and_spares_clean_texts(spark, empty, labels):
    rng = random.Random(5)
    common_words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    rows, lab = [], []
    for i in range(900):
        w = [rng.choice(common_words) for _ in range(rng.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["zorgon", "zorgons", "vexbag"])
        rows.append((i, " ".join(w), "en", "a", 0))
        lab.append((i, 1, int(toxic)))
    d = spark.createDataFrame([*rows, (5000, None, None, None, None), (5001, LONG, "de", "a", 1), (5001, LONG, "de", "a", 1)],
                              "doc_id long, text string, lang string, source string, n_chars long")
    labelled = spark.createDataFrame([*lab, (None, 1, 1), (7, None, None), (8, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(clashing(d, ["score", "y", "calib"]), labelled).collect()
    assert len(got) == d.count()
    truth = {i: t for i, _, t in lab}
    tested = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 and (r.predicted == 1) == (r.score >= 0.7) for r in got)
    assert all(r.predicted == 0 for r in got if r.doc_id in (5000, 5001))
    kept = toxicity.keep_ordinary(d, labelled)
    assert kept.columns == d.columns
    assert {r.doc_id for r in got if not r.predicted} == {r.doc_id for r in kept.collect()}
    assert toxicity.score_toxicity(empty, labelled).count() == 0
    assert {r.score for r in toxicity.score_toxicity(d, labels).collect()} == {0.0}


@pytest.mark.parametrize("calib", [True, False])
def test_toxicity_learns_when_all_toxic_rows_are_on_one_side(spark, calib):
    from pyspark.sql import functions as F
    ids = [r.id for r in spark.range(3000).where(common.crc_mod(F.col("id"), 3) != 1).where(
        (F.pmod(F.xxhash64("id"), F.lit(5)) == 0) == F.lit(calib)).limit(6).collect()]
    plain = [r.id for r in spark.range(5000, 5060).where(common.crc_mod(F.col("id"), 3) != 1).collect()]
    rows = [(i, "grumzak vortlez blurgh grumzak") for i in ids] + [(i, "the house on the hill is green") for i in plain]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i in ids)) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(d, labels).collect()}
    assert min(got[i] for i in ids) > 0.5 > max(got[i] for i in plain)


def test_kneser_ney_tables_are_distributions():
    rows = [(g, n, m) for g, (n, m) in {"\x02a": (5, 1), "\x02b": (2, 4), "\x02ab": (3, 1), "\x02aa": (2, 0),
                                        "ab\x03": (3, 0), "\x02ab\x03": (3, 1)}.items()]
    events = toxicity.build_table(rows)
    assert events["\x02b"] > 0 > events["\x02aa"]
    got = toxicity.lookup(*toxicity.packed(events), toxicity.hashed([*events, "zzz"]))
    assert np.allclose(got, [*events.values(), 0.0], atol=1e-6)
    assert toxicity.grams("ab") == ["\x02a", "\x02ab", "\x02ab\x03"]


def test_kneser_ney_probabilities_of_every_context_sum_to_one():
    """By plain sums over the alphabet, with one sign for all other characters."""
    rng = random.Random(8)
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 8)))
        for g in toxicity.grams(word):
            n = counts.setdefault(g, [0, 0])
            n[rng.random() < 0.3] += rng.randint(1, 3)
    model = toxicity.KneserNey([(g, *n) for g, n in counts.items()])
    signs = sorted({g[-1] for g in counts}) + ["?"]
    contexts = {g[:-1] for g in counts} | {"", "zz", "a", "\x02b"}
    for ctx in contexts:
        assert sum(model.shared(ctx + c) for c in signs) == pytest.approx(1), ctx
        for y in (0, 1):
            total = 0.0
            for c in signs:
                n = counts.get(ctx + c, [0, 0])
                total += model.probability(y, ctx + c, n[y]) if ctx else model.shared(c)
            assert total == pytest.approx(1), (ctx, y)
    backoffs = model.backoffs()
    for ctx in contexts - {""}:  # an unseen event's difference is that of its probabilities
        want = np.log(model.probability(1, ctx + "?", 0) / model.probability(0, ctx + "?", 0))
        assert backoffs.get(ctx, 0.0) == pytest.approx(want, abs=1e-12)


def test_full_backoff_is_a_choice(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    a = {r.doc_id: r.score for r in toxicity.score_toxicity(d, lab).collect()}
    b = {r.doc_id: r.score for r in toxicity.score_toxicity(d, lab, full_backoff=True).collect()}
    assert a.keys() == b.keys() and a != b and all(0 <= x <= 1 for x in b.values())


def test_labels_of_the_held_out_fold_are_not_read(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F
    fold = common.crc_mod(F.col("doc_id"), 3) == 1
    flipped = lab.select("doc_id", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality"),
                         F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    a = rows_of(toxicity.score_toxicity(d, lab))
    b = rows_of(toxicity.score_toxicity(d, flipped))
    assert [r[0] for r in a] == [r[0] for r in b]
    assert all(x[2] == pytest.approx(y[2], abs=1e-9) for x, y in zip(a, b))


def test_quality_labels_of_the_held_out_fold_are_not_read(spark):
    from pyspark.sql import functions as F
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    fold = common.crc_mod(F.col("doc_id"), 3) == 1
    flipped = lab.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (rows_of(quality_net.score_quality(d, x)) for x in (lab, flipped))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    assert all(x[2] == pytest.approx(y[2], abs=1e-9) for x, y in zip(a, b))


def test_word_vectors_equal_plain_loops(spark, docs, monkeypatch):
    monkeypatch.setattr(quality_net, "CHUNK", 7)  # borders inside and between texts
    texts = ["the cat saw The dog", "a", "", "dog dog dog cat!! 77", "one two three four five six seven eight nine ten"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").repartition(4)
    got = quality_net.word_vectors(d)
    words, shapes = quality_net.index_vectors(quality_net.WORDS, quality_net.SEED + 1), quality_net.index_vectors()
    want = np.zeros((quality_net.TERMS, quality_net.WIDTH))
    for t in texts * 3:
        w, s = quality_net.Terms().of(t)
        for i in range(len(w)):
            for j in range(max(0, i - quality_net.REACH), min(len(w), i + quality_net.REACH + 1)):
                if i != j:
                    want[w[i]] += words[w[j]]
                    want[quality_net.WORDS + s[i]] += shapes[s[j]]
    length = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(got, want / np.where(length > 0, length, 1), atol=1e-6)
    assert np.linalg.norm(got[quality_net.Terms().of("cat")[0][0]]) == pytest.approx(1)


def test_quality_network_held_out_accuracy(spark, docs, empty, labels):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality_net.score_quality(d, lab, per_class=400).where("held_out").join(lab, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.97
    assert np.mean([r.predicted == 1 for r in got if r.quality == 1]) > 0.98


def test_quality_scores_over_odd_rows(spark, docs, empty, labels):
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    d = docs.select("doc_id", "text").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    got = quality_net.score_quality(clashing(d, ["score", "f", "term", "v0"]), lab).collect()
    assert len(got) == d.count() and all(0 <= r.score <= 1 for r in got)
    assert all((r.predicted == 1) == (r.score >= 0.5) for r in got)
    assert quality_net.score_quality(empty, lab).count() == 0
    assert {r.score for r in quality_net.score_quality(d, labels).collect()} == {1.0}


def test_word_shapes():
    assert quality_net.shape("Hello!!!") == "Aa!" and quality_net.shape("ntea***") == "a*"
    assert quality_net.shape("AKIA1234x") == "A9a" and quality_net.shape("éß") == "a"


def test_temperature_softens_overconfident_logits():
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert quality_net.fit_temperature(4 * z, y, np.ones(4000)) == pytest.approx(4, rel=0.2)


def test_short_cuts_to_shapes_change_none():
    rng = random.Random(6)
    signs = "abzAZéÉß中ʰǅ١9_-,.;:!?*'ﬁ "
    for _ in range(20_000):
        w = "".join(rng.choices(signs, k=rng.randint(0, 5)))
        assert quality_net.shape(w) == quality_net._any_shape(w), repr(w)


def test_the_query_scores_unseen_expressions_by_their_backoff(spark):
    """op9 by the whole method: all n-grams counted, unseen ones by their class's backoff."""
    from skumix.llm import queries
    d = spark.read.parquet(f"{SF}/documents.parquet")
    lab = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r.score for r in queries.op9_toxicity(spark, SF).collect()}
    whole = {r.doc_id: r.score for r in toxicity.score_toxicity(d, lab, full_backoff=True).collect()}
    assert got.keys() == whole.keys()
    assert all(got[i] == pytest.approx(whole[i], abs=1e-9) for i in got)
