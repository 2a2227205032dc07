"""Source divergence audit: how far apart the sources of a language write.

Every (lang, source) group gives each kept term a smoothed integer share
``p``; two groups differ by the sum of ``|p - q|`` over all kept terms.  Most
counts are zero, where ``p`` is the group's floor ``p0``.  So a pair's sum is

    V |p0_g - p0_h|                        both counts zero everywhere
    + sum over g's terms of |p_g - p0_h| - |p0_g - p0_h|     (and g, h swapped)
    + sum over terms of both of the pair correction
      |p_g - p_h| - |p_g - p0_h| - |p0_g - p_h| + |p0_g - p0_h|

The second line follows from each group's histogram of shares.  The third
comes from a frequent-pattern tree: a term is a row of its nonzero (source,
share) items, the most frequent sources first; rows are sorted, so that rows
with a common beginning follow each other and share the nodes of a path.  A
node knows how many terms run through it, and its corrections with all its
ancestors are computed once, times that number.  The tree is built for some
thousand rows at a time, level by level: a row opens a node at every depth
from its first difference to the row before.  All arithmetic is on integers.

A row is as long as its term has sources and the answer itself has a row for
every ordered pair of a language's sources, so the tree grows no faster than
the answer.  Counts are pre-aggregated in the tasks that read the texts: a
hot source or term arrives once per task.

Defined results: null text, lang and source count as ''; a group without
terms keeps its place with count 0 everywhere; with no kept term in a
language its pairs have value 0; repeated rows are documents of their own;
an empty table gives an empty result; further columns are ignored."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, written

# Fixed value: a term is a run of ASCII letters and of anything beyond ASCII
# (on UTF-8 bytes, where every byte of such a character is 0x80 or more).
TERM = rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30            # fixed value: documents of the language a kept term is in
SMOOTHING = 5            # fixed value: added to every count
SCALE = 1_000_000_000    # fixed value: shares are counted in parts of this
TOP_TERMS = 50           # fixed value: ranks of part `term`

HELD_TERMS = 900_000     # terms a task counts before it passes them on
TREE_ITEMS = 500_000     # items of rows a task makes into a tree at once
HELD_PAIRS = 1_000_000   # node-ancestor pairs computed at once
SALTS = 16               # parts a language's groups are dealt to in the join by language


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source",
                text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term.
    One row with a null term stands for each group itself."""
    kinds = "lang string, source string, term binary, n long, docs long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        find = re.compile(TERM).findall
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed_on():
            for (lang, source), (n, d) in held.items():  # both have their terms in one order
                size = len(n) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                     pa.array([None, *n], pa.binary()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *d.values()], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
            held.clear()

        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                terms = find(text.lower())  # of bytes: A-Z alone
                n.update(terms)
                d.update(dict.fromkeys(terms).keys())
            if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                yield from passed_on()
        yield from passed_on()

    blank = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    d = in_batches(docs).select(blank(lang_col).alias("lang"), blank(source_col).alias("source"),
                                blank(text_col).cast("binary").alias("text"))
    return (d.mapInArrow(run, kinds).groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * terms)), exact;
    null without terms."""
    wide = "decimal(25,0)"
    over = (F.lit(SCALE).cast("decimal(10,0)") * (n + SMOOTHING).cast("decimal(20,0)"))
    under = (total + SMOOTHING * terms).cast(wide)
    return F.when(terms > 0, F.call_function("div", over, under) + 1).cast("long")


def _between(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def tree_corrections(sizes, times, place, p, p0):
    """Summed corrections of the tree of some sorted rows: (place of the
    ancestor, place of the node, sum) arrays, each pair of places once.

    ``sizes``: items of each row; ``times``: its multiplicity; the others are
    the rows' items, one row after the other."""
    import numpy as np
    at = np.cumsum(sizes) - sizes
    # items that a row has in common with the row before
    common, same = np.zeros(len(sizes), np.int64), np.ones(len(sizes), bool)
    same[:1] = False
    through = np.r_[0, np.cumsum(times)]
    row, depth, number = [], [], []
    for d in range(int(sizes.max(initial=0))):
        r = np.flatnonzero(same)
        r = r[(sizes[r] > d) & (sizes[r - 1] > d)]
        r = r[(place[at[r] + d] == place[at[r - 1] + d]) & (p[at[r] + d] == p[at[r - 1] + d])]
        same[:] = False
        same[r] = True
        common[r] += 1
        opens = np.flatnonzero(common <= d)  # the rows up to the next of these share the node
        n = through[np.r_[opens[1:], len(sizes)]] - through[opens]
        real = sizes[opens] > d
        row.append(opens[real])
        depth.append(np.full(int(real.sum()), d))
        number.append(n[real])
    if not row:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    row, depth, number = (np.concatenate(x) for x in (row, depth, number))
    wide = int(place.max(initial=0)) + 1
    keys, sums = [], []
    parts = np.cumsum(depth) // HELD_PAIRS
    for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(parts)) + 1):
        d = depth[part]
        node = np.repeat(at[row[part]] + d, d)
        above = np.arange(len(node)) - np.repeat(np.cumsum(d) - d, d) + np.repeat(at[row[part]], d)
        fix = (np.abs(p[node] - p[above]) - np.abs(p[node] - p0[above])
               - np.abs(p0[node] - p[above]) + np.abs(p0[node] - p0[above])) * np.repeat(number[part], d)
        k, s = _summed(place[above] * wide + place[node], fix)
        keys.append(k)
        sums.append(s)
    k, s = _summed(np.concatenate(keys), np.concatenate(sums))
    return k // wide, k % wide, s


def _summed(keys, values):
    import numpy as np
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(keys) else values


def _corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, fix): pair corrections by places, a before b."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        lang, held = None, []

        def made():
            if held:
                a, b, fix = tree_corrections(*(np.concatenate(x) for x in zip(*held)))
                held.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(fix)],
                    ["lang", "a", "b", "fix"])

        for b in batches:
            of = np.array(b.column("lang").to_pylist(), object)
            edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)] if len(of) else []
            for s, e in zip(edges, edges[1:]):
                if of[s] != lang:
                    yield from made()
                    lang = of[s]
                path = b.column("path").slice(s, e - s)
                items = path.flatten()
                held.append((np.diff(path.offsets.to_numpy()).astype(np.int64),
                             b.column("times").slice(s, e - s).to_numpy(),
                             *(items.field(c).to_numpy() for c in ("place", "p", "p0"))))
            if sum(len(x[2]) for x in held) > TREE_ITEMS:
                yield from made()
        yield from made()

    return (paths.mapInArrow(run, "lang string, a long, b long, fix long")
            .groupBy("lang", "a", "b").agg(F.sum("fix").alias("fix")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, lang_col: str = "lang",
               source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs, terms), both unranked: (lang, source, other, value) for every
    ordered pair of a language's sources, and (lang, source, term, value) for
    every kept term that a source uses more than its language does."""
    counts = written(term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    used = counts.where("term IS NOT NULL")
    kept = (used.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
            .where(F.col("docs") >= min_docs).drop("docs"))
    items = written(used.drop("docs").join(kept, ["lang", "term"]), "divergence-items")
    langs = items.groupBy("lang").agg(F.countDistinct("term").alias("terms"), F.sum("n").alias("lang_total"))
    totals = items.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own_terms"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = (counts.where("term IS NULL").select("lang", "source")
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", zero("total"), zero("own_terms"), zero("terms"), zero("lang_total"))
              # place in the language's order, sources of many terms first
              .withColumn("place", F.row_number().over(
                  Window.partitionBy("lang").orderBy(F.desc("own_terms"), "source")).cast("long"))
              .withColumn("p0", F.coalesce(share(F.lit(0).cast("long"), F.col("total"), F.col("terms")),
                                           F.lit(0).cast("long"))))
    groups = written(groups.drop("own_terms"), "divergence-groups")

    rows = items.join(groups, ["lang", "source"]).withColumn("p", share(
        F.col("n"), F.col("total"), F.col("terms")))
    paths = (rows.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("place", "p", "p0"))).alias("path"))
             .groupBy("lang", "path").agg(F.count("*").alias("times")))
    # ranges of beginnings; rows that begin alike are split by their hash
    near = paths.repartitionByRange("lang", F.slice("path", 1, 3), F.xxhash64("path"))
    both = _corrections(near.sortWithinPartitions("lang", "path").select("lang", "path", "times"))

    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    other = groups.select("lang", F.col("place").alias("b"), F.col("source").alias("other"),
                          F.col("p0").alias("q0"), salts)
    salted = lambda *c: F.pmod(F.xxhash64(*c), F.lit(SALTS)).cast("int").alias("salt")
    # own terms of a against the floor of every other group b
    shares = rows.groupBy("lang", F.col("place").alias("a"), "p0", "p").agg(F.count("*").alias("times"))
    single = (shares.select("*", salted("a", "p")).join(other, ["lang", "salt"]).where("a <> b")
              .groupBy("lang", "a", "b").agg(F.sum(F.col("times") * (
                  _between(F.col("p"), F.col("q0")) - _between(F.col("p0"), F.col("q0")))).alias("fix")))
    # a correction holds both ways: turned in the row, so no branch is planned twice
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("way")
    fixes = (single.unionByName(both).select("lang", ways, "fix")
             .groupBy("lang", F.col("way.a").alias("a"), F.col("way.b").alias("b")).agg(F.sum("fix").alias("fix")))
    pairs = (groups.select("lang", "source", F.col("place").alias("a"), "p0", "terms", salted("source"))
             .join(other, ["lang", "salt"]).where("a <> b")
             .join(fixes, ["lang", "a", "b"], "left")
             .select("lang", "source", "other", (
                 F.col("terms") * _between(F.col("p0"), F.col("q0"))
                 + F.coalesce(F.col("fix"), F.lit(0))).cast("long").alias("value")))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    terms = (rows.withColumn("q", q).where("p > q")
             .select("lang", "source", "term", (F.col("p") - F.col("q")).alias("value")))
    return pairs, terms


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, **columns) -> DataFrame:
    """lang, source, part (`pair`, `term`), item, value, rank: all other
    sources and the ``top`` terms of every group, the farthest first."""
    pairs, terms = divergence(docs, min_docs, **columns)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda d, part, item: d.select(
        "lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value").withColumn(
        "rank", F.row_number().over(order))
    return ranked(pairs, "pair", "other").unionByName(ranked(terms, "term", "term").where(F.col("rank") <= top))
