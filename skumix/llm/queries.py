"""The registered queries of the operators, and SQL for those it can express.

Each query applies an operator with production parameters to its whole
table and derives the contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, divergence, embed_lsh, hmm, packing, prefix_counts, quality_net, quality_rules, secrets,
               simhash, suffix_index, toxicity, vector_codes)
from .common import table, written


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets.scan(table(spark, sf_dir, "documents"))
    return s.select("doc_id", "n_assign", "n_access", "n_hex",
                    F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"),
                    "spans", "n_layers", "oversized_layers")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules.quality_metrics(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "kept")


def op5_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_lsh.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = bpe.encode(table(spark, sf_dir, "documents"))
    return e.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_rows(packing.pack_sequences(table(spark, sf_dir, "documents")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                   full_backoff=True)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    codes = vector_codes.with_label_error(written(codes, "vector-codes"))
    return codes.select("vec_id", "code", "error", "label_error",
                        F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_index.dedup(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_simhash_near_dedup, op3_token_counts, op4_quality_rules,
    op5_hmm_scoring, op6_embedding_near_dedup, op7_bpe, op8_packing, op9_toxicity,
    op10_quality_classifier, op11_vector_codes, op12_suffix_dedup, op13_source_divergence)}


def _vector_codes_sql(rounds: int = 6) -> str:
    """One chain of CTEs: assignment and floor means, round by round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, p, min(d * 16 + e) % 16 AS e, min(d) AS d
  FROM (SELECT c.vec_id, c.p, b.e, sum((c.x - b.m)::HUGEINT * (c.x - b.m)) AS d
        FROM c JOIN b{r} b ON c.p = b.p AND c.j = b.j GROUP BY c.vec_id, c.p, b.e)
  GROUP BY vec_id, p)""")
        if r < rounds:
            steps.append(f"""
b{r + 1} AS MATERIALIZED (
  SELECT b.e, b.p, b.j, coalesce((s - ((s % n) + n) % n) // n, m) AS m
  FROM b{r} b LEFT JOIN (
    SELECT a.e, c.p, c.j, sum(c.x) AS s, count(*) AS n
    FROM c JOIN a{r} a ON a.vec_id = c.vec_id AND a.p = c.p GROUP BY a.e, c.p, c.j) t
  ON t.e = b.e AND t.p = b.p AND t.j = b.j)""")
    return """
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS MATERIALIZED (
  SELECT vec_id, i // (len(v) // 8) AS p, i % (len(v) // 8) AS j, v[i + 1] AS x
  FROM (SELECT *, unnest(range(len(v))) AS i FROM k)),
b0 AS MATERIALIZED (
  SELECT e, p, j, x AS m FROM c JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k ORDER BY vec_id LIMIT 16) f
  ON c.vec_id = f.vec_id),""" + ",".join(steps) + f""",
r AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(e AS INT)), '' ORDER BY p) AS code, sum(d) AS error
  FROM a{rounds} GROUP BY vec_id)
SELECT k.vec_id, code, CAST(error AS BIGINT) AS error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha256((SELECT string_agg(CAST(m AS VARCHAR), ',' ORDER BY p, e, j) FROM b{rounds})) AS codebooks_sha256
FROM r JOIN k ON k.vec_id = r.vec_id"""


# Values are written out here, apart from the rules' table in quality_rules.
ORACLE = {"op4_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
starts AS (
  SELECT rid, i, list_aggregate(w[i:i+7], 'string_agg', chr(10)) AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (
  SELECT rid, i FROM starts
  QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
covered AS (
  SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
         len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) AS n_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         len(regexp_extract_all(text, '!')) AS n_exclaim,
         len(regexp_extract_all(text, '\p{Lu}')) AS n_upper,
         len(list_filter(w, lambda x: lower(x) IN (
           'the','of','and','to','in','is','that','for','it','as','was','with','be','by','on','not','he','his','but','at','are','this','have','from','or','had',
           'a','la','le','les','de','des','du','et','en','un','une','que','qui','dans','pour','sur','pas','par','au','ne','se','ce','il','plus','est','sont','avec',
           'el','los','las','y','del','con','su','para','al','lo','como','más','o','es',
           'der','die','das','und','ist','von','zu','den','mit','sich','auf','für','im','dem','ein','eine','als','auch','nicht','aus','wird'))) AS n_stop
  FROM d LEFT JOIN covered c ON d.rid = c.rid),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed
         AND word_chars >= 2.0 * n_words AND word_chars <= 15.0 * n_words
         AND n_symbols / word_chars <= 0.05 AND n_exclaim / word_chars <= 0.1
         AND n_upper / word_chars <= 0.4 AND n_stop / n_words >= 0.02
         AND n_dup_lines / n_lines <= 0.5 AS kept
FROM b""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
x AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, lang_n,
         count(*) OVER (PARTITION BY g.lang, g.source) AS v,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total,
         sum(lang_n) OVER (PARTITION BY g.lang, g.source) AS lang_total
  FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v)::HUGEINT AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v)::HUGEINT AS q
  FROM x),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rk FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rk AS INT) AS rank
FROM s WHERE part = 'pair' OR rk <= 50""",
    "op12_suffix_dedup": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS raw,
         lower(hex(encode(coalesce(text, '')))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS MATERIALIZED (
  SELECT rid, doc_id, i, md5_number(substring(x, 2 * i + 1, 100)) AS s
  FROM (SELECT rid, doc_id, x, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
g AS (SELECT w.rid, w.i FROM w JOIN f ON w.s = f.s WHERE f.least < w.doc_id),
e AS (
  SELECT rid, i, coalesce(i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 50, true)::INT AS new FROM g),
r AS (
  SELECT rid, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM e) GROUP BY rid, k),
k AS (  -- what is left: from the end of a run to the start of the next
  SELECT d.rid, x, n, a AS upto, coalesce(lag(b) OVER (PARTITION BY d.rid ORDER BY a), 0) AS start FROM d JOIN r ON d.rid = r.rid
  UNION ALL
  SELECT d.rid, x, n, n, coalesce(b, 0) FROM d LEFT JOIN (SELECT rid, max(b) AS b FROM r GROUP BY rid) t ON d.rid = t.rid),
j AS (
  SELECT rid, string_agg(substring(x, 2 * start + 1, 2 * (upto - start)), '' ORDER BY start) AS kept FROM k GROUP BY rid),
c AS (SELECT rid, count(*) AS spans, sum(b - a) AS removed FROM r GROUP BY rid)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN j ON j.rid = d.rid LEFT JOIN c ON c.rid = d.rid""",
    "op11_vector_codes": _vector_codes_sql()}
