"""Token counts by prefix dynamic programming.

For every byte of a pre-token the last token of its prefix's encoding is
found from earlier places: of the vocabulary tokens that end there, the
one compatible with the last token of the prefix before it.  Its count is
that prefix's count plus one.  Summed over pre-tokens this gives the exact
token count of every prefix of a text, so truncation and budget questions
are lookups, not encodings.

Defined results: null and empty texts have zero tokens; repeated rows get
equal results; an empty table gives an empty result; further columns are
ignored."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ChunkCoder, Tables, default_vocabulary, tables_of, vocabulary
from .common import ids_and_text

LIMIT = 512  # fixed value: over_limit is n_tokens > LIMIT


def piece_counts(tables: Tables, piece: bytes) -> list[int]:
    """Token count of every prefix of a pre-token (index: bytes)."""
    n = len(piece)
    last, counts, lengths = [-1] * (n + 1), [0] * (n + 1), tables.lengths
    known = tables.pairs.get
    for end, t in tables.automaton.iter(piece.decode("latin-1")):  # ends ascend
        i = end + 1
        if last[i] < 0:
            start = i - lengths[t]
            if start:
                fits = known((last[start], t))
                if not (tables.compatible(last[start], t) if fits is None else fits):
                    continue
            last[i], counts[i] = t, counts[start] + 1
    return counts


def prefix_counts(tables: Tables, text: str) -> list[int]:
    """Exact token count of ``text[:i]`` for every i from 0 to its length."""
    out, at = [0], 0
    marks = tables.specials.finditer(text) if tables.specials else ()
    for m in [*marks, None]:
        out += _plain(tables, text[at:m.start() if m else len(text)], out[-1])
        if m:  # inside a special string its characters are ordinary text
            inner = _plain(tables, text[at:m.end()], out[len(out) - 1 - (m.start() - at)])
            out += inner[m.start() - at:-1] + [out[-1] + 1]
            at = m.end()
    return out


def _plain(tables: Tables, text: str, base: int) -> list[int]:
    """Counts of the non-empty prefixes of a text without special strings."""
    out: list[int] = []
    before = base          # tokens before the current piece
    previous, start_of_previous = "", base
    for piece in tables.pretoken.findall(text):
        counts, at, part = piece_counts(tables, piece.encode("utf-8")), 0, []
        for ch in piece:
            at += len(ch.encode("utf-8"))
            part.append(before + counts[at])
        if tables.blank.fullmatch(previous) and tables.blank.match(piece):
            # "  x": until x comes, its space belongs to the white space before
            run = (previous + piece[0]).encode("utf-8")
            part[0] = start_of_previous + piece_counts(tables, run)[-1]
        if len(piece) == 3 and piece[0] == "'" and piece[1:].isalpha():
            part[1] = before + 2  # "'l" of "'ll" is a quote and a letter
        out += part
        start_of_previous, previous = before, piece
        before += counts[-1]
    return out


def cut_at(counts: list[int], budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    return max(i for i, c in enumerate(counts) if c <= budget)


def total_coder(state: dict) -> ChunkCoder:
    """Token counts of whole texts from remembered chunk counts."""
    if "total_coder" not in state:
        t = tables_of(state)
        state["total_coder"] = ChunkCoder(t, lambda p: piece_counts(t, p)[-1], sum, lambda _: 1)
    return state["total_coder"]


def token_counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""
    bc = vocabulary(docs.sparkSession, path or default_vocabulary())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        coder = total_coder(bc.value)
        for b in batches:
            n = [sum(v) for v in coder.code(b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    d = ids_and_text(docs, id_col, text_col)
    d = d.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return (d.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def prefix_table(docs: DataFrame, budget: int = LIMIT, path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts of all prefixes (array, index = characters), and the
    characters of the longest prefix within ``budget`` tokens."""
    bc = vocabulary(docs.sparkSession, path or default_vocabulary())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        t = tables_of(bc.value)
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                counts = [prefix_counts(t, x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts, pa.list_(pa.int32())),
                     pa.array([cut_at(c, budget) for c in counts], pa.int64())],
                    ["doc_id", "prefix_tokens", "cut_chars"])

    d = ids_and_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, prefix_tokens array<int>, cut_chars long")
