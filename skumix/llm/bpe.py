"""Byte-pair encoding by backtracking over longest matches, and decoding.

An Aho-Corasick automaton finds every vocabulary token in a pre-token; the
encoder goes left to right with the longest token at each place.  A token
is accepted when it is compatible with the one before it, that is, when
merging the two in rank order leaves their border alone (a remembered
pair-compatibility table).  If none fits, it steps back and tries the next
shorter token; every place is given up at most once, so the work is linear
in the text and the result is exactly that of the merges.  Decoding joins
slices of one byte buffer through an offset table.

Texts are cut at single spaces between visible characters, where no
pre-token can reach across.  Values of these chunks are remembered, and below
them those of pre-tokens ("word," and "word." share "word"), in bounded memos
of two generations, so common words are encoded once per worker.

The vocabulary file's path is a parameter; its bytes are broadcast (a
fixed size).  Defined results: null and empty texts have no tokens;
repeated rows get equal results; an empty table gives an empty result;
further columns are ignored."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from .common import ids_and_text

# Fixed value: the pattern that cuts texts into pre-tokens.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMO_CHUNKS = 300_000   # chunks a worker remembers, and as many of the time before
MEMO_PIECES = 200_000   # pre-tokens, likewise
MEMO_PAIRS = 300_000    # token pairs
STRIDE = 1_000_000      # characters encoded at once


def default_vocabulary() -> str:
    """Path of the byte-level vocabulary the queries use."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """Symbol of byte-level vocabularies -> byte: visible bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tables:
    """Vocabulary tables of a byte-level BPE file (tokenizers' JSON)."""

    def __init__(self, content: bytes):
        import ahocorasick
        import regex
        spec = json.loads(content)
        model, to_byte = spec["model"], byte_symbols()
        raw = lambda s: bytes(to_byte[c] for c in s)
        vocab = {raw(t): i for t, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        singles = sorted((t for t in vocab if len(t) == 1), key=vocab.get)
        # rank: single bytes first, then the merged tokens in order of merging
        self.tokens: list[bytes] = list(singles)
        rank = {t: r for r, t in enumerate(singles)}
        self.halves: list[tuple[int, int]] = [(r, r) for r in range(len(singles))]
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            a, b = raw(a), raw(b)
            if a + b not in rank:
                rank[a + b] = len(self.tokens)
                self.tokens.append(a + b)
                self.halves.append((rank[a], rank[b]))
            self.merged.setdefault((rank[a], rank[b]), rank[a + b])
        self.ids = [vocab[t] for t in self.tokens]
        self.id_bytes = [i.to_bytes(4, "little") for i in self.ids]
        self.lengths = [len(t) for t in self.tokens]
        self.shorter = [self._prefix(t, rank) for t in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for r, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.pretoken = regex.compile(PRETOKEN)
        self.blank = regex.compile(r"\s+")
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.safe_space = regex.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")
        self.pairs: dict[tuple[int, int], bool] = {}

    @staticmethod
    def _prefix(t: bytes, rank: dict[bytes, int]) -> int:
        for n in range(len(t) - 1, 0, -1):
            if t[:n] in rank:
                return rank[t[:n]]
        return -1

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave the border between tokens a and b alone."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[(a, b)] = self._border_stays(a, b)
        return known

    def _border_stays(self, a: int, b: int) -> bool:
        # Undo the two tokens' merges, latest first.  Before each undone merge
        # the parts at the border existed side by side; had they a merge of an
        # earlier rank than the one undone last, it would have come first.
        limit = len(self.tokens)
        while True:
            m = self.merged.get((a, b))
            if m is not None and m < limit:
                return False
            if a > b:
                limit, a_next = a, self.halves[a][1]
                if a_next == a:   # a is a single byte: only b can be undone
                    return True
                a = a_next
            else:
                b_next = self.halves[b][0]
                if b_next == b:
                    a_next = self.halves[a][1]
                    if a_next == a:
                        return True
                    limit, a = a, a_next
                else:
                    limit, b = b + 1, b_next

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of one pre-token's tokens."""
        n = len(piece)
        longest = [0] * n
        lengths, known = self.lengths, self.pairs.get
        for end, t in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[t]] = t  # ends ascend: the longest comes last
        out: list[int] = []
        given_up = bytearray(n + 1)
        pos, t, before = 0, longest[0], -1
        while pos < n:
            while t >= 0:
                end = pos + lengths[t]
                if not given_up[end]:
                    if before < 0:
                        break
                    fits = known((before, t))
                    if fits or fits is None and self.compatible(before, t):
                        break
                t = self.shorter[t]
            if t >= 0:
                out.append(t)
                pos, before = end, t
                if pos < n:
                    t = longest[pos]
            else:  # nothing fits here: never come back to this place
                given_up[pos] = 1
                t = out.pop()
                pos -= lengths[t]
                before = out[-1] if out else -1
        return out

    def pieces(self, text: str) -> list[bytes]:
        return [p.encode("utf-8") for p in self.pretoken.findall(text)]

    def packed_piece(self, piece: bytes) -> bytes:
        """Ids of one pre-token, as little-endian u32."""
        return b"".join([self.id_bytes[r] for r in self.encode_piece(piece)])

    def packed(self, text: str) -> bytes:
        """Ids of a text without special strings, likewise."""
        return b"".join(map(self.packed_piece, self.pieces(text)))

    def offsets(self):
        """(byte buffer of all tokens by id, offset table) for decoding."""
        import numpy as np
        by_id = {i: t for i, t in zip(self.ids, self.tokens)}
        by_id |= {i: s.encode("utf-8") for s, i in self.special.items()}
        size = max(by_id) + 1
        lengths = np.array([len(by_id.get(i, b"")) for i in range(size)], np.int64)
        buffer = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), np.uint8)
        return buffer, np.r_[0, np.cumsum(lengths)]


class Memo:
    """Remembered values in two generations: when the newer is full it
    becomes the older, and what is asked for again moves to the newer."""

    def __init__(self, limit: int):
        self.new: dict = {}
        self.old: dict = {}
        self.limit = limit

    def turn(self) -> None:
        if len(self.new) > self.limit:
            self.old, self.new = self.new, {}

    def unknown(self, keys) -> list:
        """The keys that are not remembered; all others are in ``new`` then."""
        new, old, out = self.new, self.old, []
        for k in keys:
            if k not in new:
                if k in old:
                    new[k] = old[k]
                else:
                    out.append(k)
        return out


class ChunkCoder:
    """Values of texts, made from remembered values of their chunks, which
    are made from remembered values of their pre-tokens.

    ``value`` maps a pre-token (bytes) to its value, ``joined`` a list of
    values to one; ``special`` gives the value of a special string's id."""

    def __init__(self, tables: Tables, value: Callable[[bytes], object], joined: Callable[[list], object],
                 special: Callable[[int], object], limit: int = MEMO_CHUNKS, pieces: int = MEMO_PIECES):
        self.tables, self.value, self.joined = tables, value, joined
        self.whole = whole_text(tables, self.of, special)
        self.specials = tuple(tables.special)
        self.later = Memo(limit)    # chunks after a space
        self.first = Memo(limit)    # chunks at the start of a text
        self.pieces = Memo(pieces)

    def _values(self, pieces: list[str]) -> Callable[[str], object]:
        """A lookup of pre-tokens, after all of ``pieces`` are learnt."""
        self.pieces.turn()
        memo, value = self.pieces.new, self.value
        for p in self.pieces.unknown(set(pieces)):
            memo[p] = value(p.encode("utf-8"))
        return memo.__getitem__

    def of(self, text: str):
        """Value of a text without special strings."""
        pieces = self.tables.pretoken.findall(text)
        return self.joined(list(map(self._values(pieces), pieces)))

    def _plain(self, chunks: list[str], memo: dict) -> list[str]:
        """Chunks that can be coded apart; the others' value is None."""
        out = []
        for c in chunks:
            if not c or c[0].isspace() or c[-1].isspace() or any(s in c for s in self.specials):
                memo[c] = None
            else:
                out.append(c)
        return out

    def _learn(self, chunks: list[str]) -> None:
        """Chunks after a space, all at once: a piece that starts with a space
        starts a chunk, for there is no other space in them."""
        chunks = self._plain(chunks, self.later.new)
        if not chunks:
            return
        pieces = self.tables.pretoken.findall(" " + " ".join(chunks))
        get, parts = self._values(pieces), []
        for p in pieces:
            if p[0] == " ":
                parts.append([get(p)])
            else:
                parts[-1].append(get(p))
        joined = self.joined
        self.later.new.update(zip(chunks, [x[0] if len(x) == 1 else joined(x) for x in parts], strict=True))

    def code(self, texts: list[str]) -> Iterator[list]:
        """For every text its chunks' values, in order."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and size < STRIDE:
                size += len(texts[end])
                end += 1
            yield from self._some(texts[at:end])
            at = end

    def _some(self, texts: list[str]) -> Iterator[list]:
        split = [t.split(" ") for t in texts]
        self.later.turn()
        self.first.turn()
        new: set[str] = set()
        for parts in split:
            new.update(parts[1:])
        self._learn(self.later.unknown(new))
        first = self.first.new
        for c in self._plain(self.first.unknown({p[0] for p in split}), first):
            first[c] = self.of(c)
        get = self.later.new.__getitem__
        for text, parts in zip(texts, split):
            if text == "":
                yield []
                continue
            got = [first[parts[0]], *map(get, parts[1:])]
            yield self.whole(text) if None in got else got


def whole_text(tables: Tables, of: Callable[[str], object], special: Callable[[int], object]):
    """Values of a text with white-space runs or special strings."""

    def run(text: str) -> list:
        out, at = [], 0
        marks = tables.specials.finditer(text) if tables.specials else ()
        for m in [*marks, None]:
            end = m.start() if m else len(text)
            if end > at:
                parts = tables.safe_space.split(text[at:end])
                out.append(of(parts[0]))
                out += [of(" " + p) for p in parts[1:]]
            if m:
                out.append(special(tables.special[m.group()]))
                at = m.end()
        return out

    return run


def vocabulary(spark: SparkSession, path: str):
    """Broadcast state with the vocabulary file's bytes (read on the driver)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast({"content": f.read()})


def tables_of(state: dict) -> Tables:
    """The tables of a broadcast state, built once per worker."""
    if "tables" not in state:
        state["tables"] = Tables(state["content"])
    return state["tables"]


def id_coder(state: dict) -> ChunkCoder:
    if "id_coder" not in state:
        t = tables_of(state)
        state["id_coder"] = ChunkCoder(t, t.packed_piece, b"".join, lambda i: i.to_bytes(4, "little"))
    return state["id_coder"]


def decode(ids, buffer, offsets) -> bytes:
    """Bytes of a u32 id array: slices of the buffer, found by offset."""
    import numpy as np
    if not len(ids):
        return b""
    starts = offsets[ids]
    lengths = offsets[ids.astype(np.int64) + 1] - starts
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
    return buffer[at].tobytes()


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian u32 as binary), n_tokens, text decoded again."""
    bc = vocabulary(docs.sparkSession, path or default_vocabulary())

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        coder = id_coder(bc.value)
        if "offsets" not in bc.value:
            bc.value["offsets"] = tables_of(bc.value).offsets()
        buffer, offsets = bc.value["offsets"]
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = [b"".join(v) for v in coder.code(part.column("text").to_pylist())]
                back = [decode(np.frombuffer(x, "<u4"), buffer, offsets).decode("utf-8", "replace")
                        for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.binary()),
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(back, pa.string())],
                    ["doc_id", "ids", "n_tokens", "decoded"])

    d = ids_and_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens long, decoded string")
