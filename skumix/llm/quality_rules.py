"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is an expression over one row (no shuffle, no user function):
lengths, symbol, stop-word, upper-case and line ratios, and the words that
lie in repeated windows.  ``RULES`` names a metric and its allowed range;
``compile_rules`` turns the table into one array column of failed rules.

Defined results: null or empty text has no word and fails the base rule;
repeated rows are judged one by one; an empty table gives an empty result;
further columns of the input are ignored (``quality_metrics``) or returned
unchanged (``keep_good``), whatever their names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name, ids_and_text

WINDOW = 8           # fixed value: words of a repeated window
MIN_WORDS = 20       # fixed value: base rule
MAX_REPEAT_PERCENT = 30  # fixed value: base rule

# Function words of the languages in the corpus (a parameter of quality_metrics).
STOP_WORDS = tuple("""
the of and to in is that for it as was with be by on not he his but at are this have from or had
a la le les de des du et en un une que qui dans pour sur pas par au ne se ce il plus est sont avec
el los las y del con su para al lo como más o es
der die das und ist von zu den mit sich auf für im dem ein eine als auch nicht aus wird
""".split())


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= metric <= high`` (None: no bound)."""
    name: str
    metric: str
    low: float | None = None
    high: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("too_few_words", "n_words", low=MIN_WORDS),
    Rule("word_length", "mean_word_chars", low=2.0, high=15.0),
    Rule("symbols", "symbol_ratio", high=0.05),
    Rule("exclamations", "exclamation_ratio", high=0.1),
    Rule("upper_case", "upper_ratio", high=0.4),
    Rule("stop_words", "stop_ratio", low=0.02),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
    Rule("repeated_words", "repeat_ratio", high=MAX_REPEAT_PERCENT / 100),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _window_hashes(words: Column, n: Column) -> Column:
    """64-bit hash of every WINDOW consecutive words; null below one window."""
    return F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW))))


def _repeated_starts(s: Column) -> Column:
    """Start positions of windows that occur more than once, ascending.
    ``s``: (hash, position) structs in order, equal hashes side by side."""
    same = F.transform(s, lambda x, i: F.when(
        F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["p"]))
    return F.sort_array(F.array_compact(same))


def _covered(p: Column) -> Column:
    """Words under windows that start at the ascending positions ``p``."""
    steps = F.transform(p, lambda x, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def _with_metrics(df: DataFrame, carry: Sequence[str], text: str, out: str,
                  stop_words: Sequence[str]) -> DataFrame:
    """``carry`` columns and a struct ``out`` of all metrics of ``text``.

    Staged projections: each expensive array is computed once, and only
    rows that do repeat a window sort their windows.  The carried columns
    travel as one struct, so their names cannot meet the stages' own.  The
    metrics leave through a generator: the optimiser moves no condition on
    them below it, where every use would repeat the stages."""
    row = [F.struct(*(F.col(f"`{c}`") for c in carry)).alias("__row")]
    keep = [F.col("__row")]
    blank = F.lit(WORD)
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    d = df.select(*row, t.alias("__t"), F.regexp_extract_all(t, blank, F.lit(0)).alias("__w"))
    w = F.col("__w")
    lines = F.filter(F.split(F.col("__t"), "\n", -1), lambda x: x.rlike(WORD))
    d = d.select(
        *keep, F.size(w).alias("__n"),
        F.length(F.array_join(w, "")).alias("__c"),
        F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).alias("__s"),
        F.regexp_count("__t", F.lit("!")).alias("__x"),
        F.regexp_count("__t", F.lit(r"\p{Lu}")).alias("__u"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*stop_words))).alias("__st"),
        lines.alias("__l"),
        _window_hashes(w, F.size(w)).alias("__h"))
    h = F.col("__h")
    base = ["__n", "__c", "__s", "__x", "__u", "__st"]
    d = d.select(
        *keep, *base, F.size("__l").alias("__nl"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).alias("__dl"),
        F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(
            h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).alias("__sorted"))
    base += ["__nl", "__dl"]
    d = d.select(*keep, *base, F.when(F.col("__sorted").isNotNull(),
                                      _repeated_starts(F.col("__sorted"))).alias("__p"))
    d = d.select(*keep, *base, F.coalesce(_covered(F.col("__p")), F.lit(0)).alias("__r"))
    n, c = F.col("__n").cast("long"), F.col("__c").cast("long")
    d = d.select(*keep, F.explode(F.array(F.struct(
        n.alias("n_words"), c.alias("word_chars"),
        F.col("__s").cast("long").alias("n_symbols"),
        F.col("__dl").cast("long").alias("n_dup_lines"),
        F.col("__r").cast("long").alias("n_repeat_words"),
        _ratio(c, n).alias("mean_word_chars"),
        _ratio(F.col("__s"), c).alias("symbol_ratio"),
        _ratio(F.col("__x"), c).alias("exclamation_ratio"),
        _ratio(F.col("__u"), c).alias("upper_ratio"),
        _ratio(F.col("__st"), n).alias("stop_ratio"),
        _ratio(F.col("__dl"), F.col("__nl")).alias("dup_line_ratio"),
        _ratio(F.col("__r"), n).alias("repeat_ratio")))).alias(out))
    return d.select("__row.*", out)


def compile_rules(metrics: str, rules: Sequence[Rule] = RULES) -> Column:
    """The threshold table as one expression: the names of the failed rules."""
    failed = []
    for r in rules:
        m, bad = F.col(f"{metrics}.{r.metric}"), F.lit(False)
        if r.low is not None:
            bad = bad | (m < r.low)
        if r.high is not None:
            bad = bad | (m > r.high)
        failed.append(F.when(bad, F.lit(r.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def base_failed(metrics: str) -> Column:
    m = F.col(f"{metrics}.n_words")
    return (m < MIN_WORDS) | (100 * F.col(f"{metrics}.n_repeat_words") > MAX_REPEAT_PERCENT * m)


def quality_metrics(docs: DataFrame, rules: Sequence[Rule] = RULES,
                    stop_words: Sequence[str] = STOP_WORDS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, every metric, failed_rules, base_failed, kept.

    Repeated windows are compared by 64-bit hash within one document."""
    m = _with_metrics(ids_and_text(docs, id_col, text_col), ["doc_id"], "text", "m", stop_words)
    m = m.withColumn("failed_rules", compile_rules("m", rules))
    return m.select("doc_id", "m.*", "failed_rules", base_failed("m").alias("base_failed"),
                    (~base_failed("m") & (F.size("failed_rules") == 0)).alias("kept"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES,
              stop_words: Sequence[str] = STOP_WORDS, text_col: str = "text") -> DataFrame:
    """The rows that pass, with the columns of ``docs`` unchanged."""
    out = free_name(docs, "quality_metrics")
    m = _with_metrics(docs, docs.columns, text_col, out, stop_words)
    ok = ~base_failed(out) & (F.size(compile_rules(out, rules)) == 0)
    return m.where(ok).drop(out)
