r"""Secret scans with a recursive decoding worklist.

Every text is scanned as it stands (the base spans).  Then its encoded
layers are unwrapped: percent escapes, Unicode and hex escapes, base64
runs, and gzip/zlib/bzip2/xz streams inside them.  Every layer carries a
map from its characters to spans of the original text; it is scanned again
and searched for further layers until nothing new appears.  A base64 run is
decoded at its four phases, as text may be glued in front of the code.  All
patterns are ASCII, so decoded bytes are read as Latin-1 whatever they are,
and once more without the NULs where wide (UTF-16, UTF-32) text shows; the
patterns alone decide what is a secret.  A run goes on over single line
breaks.  Compressed streams are found anywhere in the bytes of a run, of an
unpacked stream, or of percent and other escapes with the characters between
them; the members of a concatenated stream are unpacked as one.  ``n_layers`` counts the layers that
read as text or hold a secret.  A layer whose
content was already seen at the same place is not taken up again, so
cyclic encodings (a stream that unpacks to itself) end.

Rows are independent: no shuffle, memory bounded by one batch and by
``max_layer_bytes`` of a layer.  What unpacks to more is scanned in windows of
that size, overlapping by 64 KiB, and counted in ``oversized_layers``; the
streams inside it are unpacked piece by piece through all levels above them,
so no window border cuts one.  ``redact`` replaces its whole run.

An escape of an escape's own sign (``%2525...41``, ``\x5cx5c...``) costs two
to four characters a level, so a text can hold as many levels as characters.
After ``LEVELS`` levels, whatever the text's size, the escapes that stand for
a sign are therefore resolved to their fixpoint in one pass with their spans
mapped, and what they leave (text, streams) is unwrapped for as many levels
again; then all escapes are.  The time stays linear in the text and its
unpacked size.

Defined results: null and empty texts have no spans; repeated rows get
equal results; an empty table gives an empty result; further columns are
ignored (``scan``) or returned unchanged (``redact``)."""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame

from .common import ids_and_text, in_batches

KINDS = ("assign", "access", "hex")  # fixed order of equal starts

# Fixed patterns: (kind, pattern, tested group, least length of that group).
PATTERNS = (
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),  # same runs as [0-9a-f]+ with 24 or more
)
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}"
                    r"|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
# As a repr or a form writes bytes: further escapes, a plus for a space.
BYTES = re.compile(ESCAPE.pattern[:-2] + r"""|\\[abfnrtv0\\'"])+""")
FORM = re.compile(r"(?:%[0-9A-Fa-f]{2}|\+)+")
SHORT = dict(zip("abfnrtv0\\'\"", "\a\b\f\n\r\t\v\0\\'\""))
BASE64 = re.compile(r"[A-Za-z0-9+/_\r\n-]{16,}")
LINES = re.compile(r"[A-Za-z0-9+/_-]+(?:(?:\r\n|\n|\r)[A-Za-z0-9+/_-]+)*")  # runs inside such a match
LINE = re.compile(r"[^\r\n]+")
LEAST_RUN = 16
# gzip, bzip2, xz, zlib (each window size and level)
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|" + b"|".join(
    re.escape(bytes([c, f + -(c << 8 | f) % 31])) for c in range(0x08, 0x79, 0x10) for f in (0, 64, 128, 192)), re.S)
MAX_LAYER_BYTES = 64 << 20
# Bytes without any of these hold no secret and no further layer.
WIDE = r"(?:[\x20-\x7e]\x00{1,3}){6}"  # UTF-16 or UTF-32 of six ASCII characters, either byte order
HINT = re.compile((r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{24}|%[0-9A-Fa-f]{2}|\\[uUx]|&#"
                   r"|[A-Za-z0-9+/_-]{16}|" + WIDE).encode())
WIDE = re.compile(WIDE)
SIGN = 16             # bytes of the longest sign of a stream, and some
MAX_LEVELS = 32       # streams in streams of an oversized layer
OVERLAP = 1 << 16     # bytes of an oversized layer that are read again with the next ones
LEVELS = 8            # levels of escapes that are unwrapped one by one in any text
SIGNS = "%\\&"         # the characters that escapes begin with
LEAST_LAYER = 12      # characters of the shortest text that can hold a secret: "token=abcdef"


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the leftmost non-overlapping matches per kind."""
    out = []
    for kind, pattern, group, least in PATTERNS:
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), m.end(), kind))
    return out


def joined(spans) -> str:
    """kind:start:end by start, then kind as listed, then end; comma-joined."""
    order = sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in order)


class Layer:
    """A decoded text and how its characters map to spans of the original:
    ``step`` maps (a, b) to the parent, or to the original if there is none;
    the original itself has no step.  ``whole`` is the span of all of it."""

    __slots__ = ("text", "step", "parent", "whole", "levels")

    def __init__(self, text: str, step=None, parent=None, whole=None, levels=0):
        self.text, self.step, self.parent = text, step, parent
        self.whole = whole or (0, len(text))
        self.levels = levels  # of escapes, one above the other

    def span(self, a: int, b: int) -> tuple[int, int]:
        at = self
        while at is not None and at.step:
            a, b = at.step(a, b)
            at = at.parent
        return a, b


def _spliced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The whole layer with every decodable match replaced by its decoding."""
    pieces, at, size = [], 0, 0
    # segments: first character, its start in the parent, its end (0: characters as they stand)
    marks, starts, ends = array("q"), array("q"), array("q")

    def add(text: str, a: int, b: int) -> None:
        nonlocal size
        pieces.append(text)
        marks.append(size)
        starts.append(a)
        ends.append(b)
        size += len(text)

    for m in pattern.finditer(layer.text):
        decoded = decode(m.group())  # [(character, start, end)] inside the match
        if not decoded:
            continue
        if at < m.start():
            add(layer.text[at:m.start()], at, 0)
        for ch, a, b in decoded:
            add(ch, m.start() + a, m.start() + b)
        at = m.end()
    if not marks:
        return None
    if at < len(layer.text):
        add(layer.text[at:], at, 0)

    def step(a: int, b: int) -> tuple[int, int]:
        i, j = bisect_right(marks, a) - 1, bisect_right(marks, max(a, b - 1)) - 1
        return starts[i] + (0 if ends[i] else a - marks[i]), ends[j] or starts[j] + b - marks[j]

    return Layer("".join(pieces), step, layer, layer.whole, layer.levels + 1)


HEX = frozenset("0123456789abcdefABCDEF")
# Escapes by their last character: how many characters they may have.
CLOSED = ((3, re.compile(r"%([0-9A-Fa-f]{2})")), (4, re.compile(r"\\x([0-9A-Fa-f]{2})")),
          (6, re.compile(r"\\u([0-9A-Fa-f]{4})")), (10, re.compile(r"\\U([0-9A-Fa-f]{8})")))
BRACED = re.compile(r"&#(?:([0-9]{1,7})|[xX]([0-9A-Fa-f]{1,6}));|\\u\{([0-9A-Fa-f]{1,6})\}")
SIGNED = 1 << 20    # levels of a layer without escapes of signs
RESOLVED = 1 << 30  # levels of a layer without escapes


def _last_escape(out: list[str]) -> tuple[int, str] | None:
    """(length, character) of the escape that the characters end with."""
    c = out[-1]
    if c in HEX:
        for n, pattern in CLOSED:
            if len(out) >= n and out[-n] in "%\\" and (m := pattern.fullmatch("".join(out[-n:]))):
                return (n, chr(code)) if (code := int(m.group(1), 16)) < 0x110000 else None
    elif c in ";}":
        tail = "".join(out[-11:])
        at = max(tail.rfind("&#"), tail.rfind("\\u{"))
        if at >= 0 and (m := BRACED.fullmatch(tail, at)):
            code = int(m.group(1)) if m.group(1) else int(m.group(2) or m.group(3), 16)
            return (len(tail) - at, chr(code)) if code < 0x110000 else None
    return None


def _resolved(layer: Layer, only: str = "") -> Layer | None:
    """The layer with all escapes (or those of ``only`` these characters)
    replaced until none is left.  Each character that completes an escape
    closes it at once, and what it stands for may close the next: every step
    takes characters away, so the time is linear."""
    out: list[str] = []
    starts, ends = array("q"), array("q")
    for i, c in enumerate(layer.text):
        out.append(c)
        starts.append(i)
        ends.append(i + 1)
        while (c in HEX or c in ";}") and (found := _last_escape(out)):
            n, c = found
            if only and c not in only:
                break
            del out[-n:], starts[1 - n:], ends[-n:]  # the first start stays
            if "\ud800" <= c < "\ue000":
                c = "\ufffd"
            out.append(c)
            ends.append(i + 1)
    if len(out) == len(layer.text):
        return None
    return Layer("".join(out), lambda a, b: (starts[a], ends[max(a, b - 1)]), layer, layer.whole,
                 SIGNED if only else RESOLVED)


def _percent(run: str) -> list[tuple[str, int, int]]:
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return [(chr(c), 3 * i, 3 * i + 3) for i, c in enumerate(raw)]
    out, at = [], 0
    for ch in text:
        n = 3 * len(ch.encode("utf-8"))
        out.append((ch, at, at + n))
        at += n
    return out


ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[uUx]([0-9A-Fa-f]+)|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);")


def _escapes(run: str) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    at = 0
    while at < len(run):
        width = {"\\x": 4, "\\U": 10}.get(run[at:at + 2])
        if width is None:
            width = 6 if run[at:at + 2] == "\\u" and run[at + 2] != "{" else None
        end = at + width if width else run.index("}" if run[at] == "\\" else ";", at) + 1
        m = ONE_ESCAPE.fullmatch(run[at:end])
        hexed = m.group(1) or m.group(2) or m.group(4)
        code = int(hexed, 16) if hexed else int(m.group(3))
        if out and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, a, _ = out.pop()  # a surrogate pair is one character
            out.append((chr(0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00), a, end))
        elif code < 0x110000:
            out.append((chr(code), at, end))
        at = end
    return out


def _byte_escapes(run: str) -> list[tuple[str, int, int]]:
    out, at = [], 0
    for m in SHORT_ESCAPE.finditer(run):
        out += [(c, at + a, at + b) for c, a, b in _escapes(run[at:m.start()])]
        if m.group(1):
            out.append((SHORT[m.group(1)], m.start(), m.end()))
        at = m.end()
    return out


SHORT_ESCAPE = re.compile(r"""\\([abfnrtv0\\'"])|$""")


def _form(run: str) -> list[tuple[str, int, int]]:
    return [(" " if m.group() == "+" else chr(int(m.group()[1:], 16)), *m.span())
            for m in re.finditer(r"\+|%..", run)]


def _percent_bytes(run: str) -> list[tuple[str, int, int]]:
    return [(chr(c), 3 * i, 3 * i + 3) for i, c in enumerate(bytes.fromhex(run.replace("%", "")))]


def _chunks(raw: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(start of the stream, bytes read so far, content) of the compressed
    streams in ``raw``, piece by piece.  Members that follow each other are
    one stream.  What a damaged or cut stream gives before its end counts."""
    import bz2
    import lzma
    import zlib
    at, start, last = 0, 0, -1
    while m := MAGIC.search(raw, at):
        fed = m.start()
        if last < 0 or raw[last:fed].strip(b"\0"):  # xz and gzip files may be padded with zeros
            start = fed
        reader = {b"BZ": bz2.BZ2Decompressor, b"\xfd7": lzma.LZMADecompressor}.get(
            raw[fed:fed + 2], lambda: zlib.decompressobj(wbits=47))()
        data, size = b"", 256  # few bytes first: most signs of a stream are chance
        try:
            while not reader.eof:
                if not data and getattr(reader, "needs_input", True):
                    data = raw[fed:fed + size]
                    fed += len(data)
                    size = step
                out = reader.decompress(data, 16 * step)
                if out:
                    yield start, fed, out
                elif not data:
                    break
                data = getattr(reader, "unconsumed_tail", b"")
        except (zlib.error, lzma.LZMAError, OSError, EOFError):
            pass
        if reader.eof:
            at = last = fed - len(reader.unused_data)
            yield start, at, b""
        else:
            at = m.start() + 2


def _unpacked(raw: bytes, limit: int) -> tuple[bytes | None, bool]:
    """(content of the compressed streams or None, whether it exceeds the limit)."""
    parts, size, last = [], 0, None
    for start, _, out in _chunks(raw):
        if last not in (None, start):
            parts.append(b"\n")
        last = start
        size += len(out)
        if size > limit:
            return None, True
        parts.append(out)
    return b"".join(parts) or None, False


def _contents(pieces: Iterator[bytes], step: int = 1 << 16) -> Iterator[bytes]:
    """The content of the compressed streams in bytes that come piece by
    piece, a line break between streams; nothing is held but a few pieces, so
    no border cuts a stream.  A sign of a stream that gives nothing is chance:
    the search goes on behind it."""
    import bz2
    import lzma
    import zlib
    buffer, pieces, given = b"", iter(pieces), False

    def more() -> bool:
        nonlocal buffer
        piece = next(pieces, None)
        buffer += piece or b""
        return piece is not None

    while True:
        m = MAGIC.search(buffer)
        if not m or m.start() > len(buffer) - SIGN and not m.start() == 0:
            buffer = buffer[m.start() if m else max(0, len(buffer) - SIGN):]
            if not more():
                if not m:
                    return
                buffer += bytes(SIGN)  # the end: what is there is all there is
            continue
        start, at, found = m.start(), m.start(), False
        reader = {b"BZ": bz2.BZ2Decompressor, b"\xfd7": lzma.LZMADecompressor}.get(
            buffer[at:at + 2], lambda: zlib.decompressobj(wbits=47))()
        data = b""
        try:
            while not reader.eof:
                if not data and getattr(reader, "needs_input", True):
                    if at >= len(buffer):
                        if found:  # what was read is behind us
                            buffer, start, at = b"", 0, 0
                        if not more():
                            break
                        continue
                    data = buffer[at:at + (step if found else 256)]
                    at += len(data)
                out = reader.decompress(data, 16 * step)
                if out:
                    if not found and given:
                        yield b"\n"
                    found = given = True
                    yield out
                data = getattr(reader, "unconsumed_tail", b"")
        except (zlib.error, lzma.LZMAError, OSError, EOFError):
            pass
        if reader.eof:
            buffer = buffer[at - len(reader.unused_data):]
        else:
            buffer = buffer[at if found else start + 2:]


def _windows(pieces: Iterator[bytes], limit: int) -> Iterator[bytes]:
    """Bytes that come piece by piece, at most ``limit`` at once, each time
    with the end of the bytes before."""
    buffer, again = bytearray(), min(OVERLAP, limit // 2)
    for out in pieces:
        buffer += out
        while len(buffer) >= limit:
            yield bytes(buffer[:limit])
            del buffer[:limit - again]
    if buffer:
        yield bytes(buffer)


def _levels(raw: bytes, limit: int) -> Iterator[bytes]:
    """The unpacked bytes of an oversized layer in windows, then those of the
    streams inside it, and so on: each level is unpacked anew through the
    levels above it, piece by piece."""
    depth = 1
    while True:
        pieces: Iterator[bytes] = iter((raw,))
        for _ in range(depth):
            pieces = _contents(pieces)
        empty = True
        for window in _windows(pieces, limit):
            empty = False
            yield window
        if empty or depth >= MAX_LEVELS:
            return
        depth += 1


def _readable(raw: bytes) -> bool:
    """Whether bytes read as UTF-8 text."""
    if len(raw) < LEAST_LAYER:
        return False
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return False
    bad = 0 if text.isprintable() else sum(not (c.isprintable() or c in "\t\r\n") for c in text)
    return bad <= len(text) // 16


def _wide_layers(layer: Layer) -> list[Layer]:
    """UTF-16 text of either byte order in a decoded layer (UTF-32: twice)."""
    if layer.step is None or not WIDE.search(layer.text):
        return []
    out, n = [], len(layer.text)
    for at in (0, 1):
        low, high = layer.text[at::2], layer.text[at + 1::2] + "\0"
        text = "".join([c if h == "\0" else "\xff" for c, h in zip(low, high)])
        out.append(Layer(text, lambda a, b, at=at: (at + 2 * a, min(n, at + 2 * b)), layer, layer.whole))
    return out


def _byte_layers(raw: bytes, a: int, b: int, seen: set, limit: int, told: dict, step=None) -> Iterator[Layer]:
    """Layers of bytes at (a, b): themselves (mapped by ``step``) and what is
    compressed in them at any depth.  ``told`` counts readable layers without
    a hint and lists the spans of oversized ones."""
    work = [(iter((raw,)), True)]
    while work:
        source, unpack = work[-1]
        raw = next(source, None)
        if raw is None:
            work.pop()
            continue
        key = (a, b, hashlib.sha256(raw).digest())
        if key in seen:  # also what unpacks to itself
            continue
        seen.add(key)
        if HINT.search(raw):
            yield Layer(raw.decode("latin-1"), step or (lambda i, j: (a, b)), None, (a, b))
        else:
            told["plain"] += _readable(raw)
        step = None
        if not unpack:  # windows: the streams inside come as levels of their own
            continue
        inner, big = _unpacked(raw, limit)
        if inner is not None:
            work.append((iter((inner,)), True))
        elif big:
            told["oversized"].append((a, b))
            work.append((_levels(raw, limit), False))


def _base64_layers(layer: Layer) -> Iterator[tuple]:
    """(bytes, a, b, step) of the base64 runs, at every phase."""
    import binascii
    for whole in BASE64.finditer(layer.text):
        for m in LINES.finditer(whole.group()):
            first, code = whole.start() + m.start(), m.group()
            if len(code) < LEAST_RUN:
                continue
            marks, starts = array("q", [0]), array("q", [first])
            if "\n" in code or "\r" in code:
                lines, size = list(LINE.finditer(code)), 0
                marks, starts = array("q"), array("q")
                for line in lines:
                    marks.append(size)
                    starts.append(first + line.start())
                    size += len(line.group())
                code = "".join([line.group() for line in lines])
                if size < LEAST_RUN:
                    continue
            if "-" in code or "_" in code:
                code = code.replace("-", "+").replace("_", "/")
            end = first + len(m.group())
            end += len(PADDING.match(layer.text, end).group())
            a, b = layer.span(first, end)

            def place(i: int, marks=marks, starts=starts) -> int:
                k = bisect_right(marks, i) - 1
                return starts[k] + i - marks[k]

            for phase in range(4):
                run = code[phase:len(code) - ((len(code) - phase) % 4 == 1)]
                raw = binascii.a2b_base64(run + "=" * (-len(run) % 4))
                # a byte of the original's runs covers the groups of four that hold it
                yield raw, a, b, None if layer.step else (lambda i, j, phase=phase, place=place: (
                    place(phase + i * 4 // 3), place(phase + -(-j * 4 // 3) - 1) + 1))


PADDING = re.compile("={0,2}")


def _escaped_streams(layer: Layer) -> Iterator[tuple]:
    """(bytes, a, b, None) of compressed streams written with escapes."""
    for sign, pattern, decode in (("%", PERCENT, _percent_bytes), ("%", FORM, _form), ("\\", BYTES, _byte_escapes),
                                  ("&#", BYTES, _byte_escapes)):
        if sign not in layer.text or pattern is FORM and "+" not in layer.text:
            continue
        child = _spliced(layer, pattern, decode)
        raw = child.text.encode("latin-1", "replace") if child else b""
        ends: dict[int, int] = {}
        for start, end, _ in _chunks(raw):
            ends[start] = end
        for start, end in ends.items():
            yield raw[start:end], *child.span(start, end), None


def _children(layer: Layer, seen: set, limit: int, told: dict) -> Iterator[Layer]:
    found = [*_wide_layers(layer)]
    if layer.levels % SIGNED >= LEVELS:
        signed = _resolved(layer, SIGNS) if layer.levels < SIGNED else None
        found.append(signed or _resolved(layer))
    elif layer.levels < RESOLVED:
        if "%" in layer.text:
            found.append(_spliced(layer, PERCENT, _percent))
        if "\\" in layer.text or "&#" in layer.text:
            found.append(_spliced(layer, ESCAPE, _escapes))
    yield from filter(None, found)
    for raw, a, b, step in chain(_base64_layers(layer), _escaped_streams(layer)):
        yield from _byte_layers(raw, a, b, seen, limit, told, step)
    layer.text = ""  # spans are all that is needed of it from here


def _scan(text: str, limit: int):
    """(base spans, all spans, layers unwrapped, spans of oversized layers)."""
    base = find(text)
    spans, seen, layers, told = set(base), set(), 0, {"plain": 0, "oversized": []}
    work = [_children(Layer(text), seen, limit, told)]
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
            continue
        key = (hashlib.sha256(child.text.encode("utf-8", "surrogatepass")).digest(), child.whole)
        if key in seen:
            continue
        seen.add(key)
        hits = find(child.text)
        layers += bool(hits) or child.parent is not None or _readable(child.text.encode("latin-1"))
        for a, b, kind in hits:
            spans.add((*child.span(a, b), kind))
        work.append(_children(child, seen, limit, told))
    return base, spans, layers + told["plain"], told["oversized"]


def scan_text(text: str, limit: int = MAX_LAYER_BYTES):
    """(base spans, all spans, layers unwrapped, oversized layers)."""
    base, spans, layers, oversized = _scan(text, limit)
    return base, spans, layers, len(oversized)


def _merged(spans) -> list[list]:
    out: list[list] = []
    for a, b, k in sorted(spans, key=lambda s: (s[0], (*KINDS, "oversized").index(s[2]), s[1])):
        if out and a < out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b, k])
    return out


def redact_text(text: str, limit: int = MAX_LAYER_BYTES) -> str:
    """The text with every span, merged where they overlap, replaced; so are
    the runs of oversized layers."""
    _, spans, _, oversized = _scan(text, limit)
    if not spans and not oversized:
        return text
    pieces, at = [], 0
    for a, b, kind in _merged(spans | {(a, b, "oversized") for a, b in oversized}):
        pieces += [text[at:a], f"[{kind} removed]"]
        at = b
    return "".join(pieces) + text[at:]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """Per row: id, base counts by kind, the base and all spans as text, the
    spans as an array of structs, and how many layers were unwrapped."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans", "span_list",
                 "n_layers", "oversized_layers"]
        for b in batches:
            cols: list[list] = [[] for _ in names[1:]]
            for t in b.column("text").to_pylist():
                base, spans, layers, big = scan_text(t, max_layer_bytes)
                order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
                row = [*(sum(s[2] == k for s in base) for k in KINDS), joined(base), joined(spans),
                       [{"kind": k, "start": a, "stop": e} for a, e, k in order], layers, big]
                for c, v in zip(cols, row):
                    c.append(v)
            span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.string(), span, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    d = ids_and_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, "
                        "base_spans string, spans string, "
                        "span_list array<struct<kind:string,start:bigint,stop:bigint>>, "
                        "n_layers long, oversized_layers long")


def redact(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars",
           max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """``docs`` with every secret's span replaced; ``count_col`` (if present)
    is set to the new length.  A null text stays null."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            old = b.column(text_col).to_pylist()
            new = [None if t is None else redact_text(t, max_layer_bytes) for t in old]
            b = b.set_column(b.schema.get_field_index(text_col), b.schema.field(text_col),
                             pa.array(new, b.schema.field(text_col).type))
            if count_col and count_col in b.schema.names:
                f = b.schema.field(count_col)
                counts = [c if n is o or n == o else len(n) for o, n, c in
                          zip(old, new, b.column(count_col).to_pylist())]
                b = b.set_column(b.schema.get_field_index(count_col), f, pa.array(counts, f.type))
            yield b

    return in_batches(docs).mapInArrow(run, docs.schema)
