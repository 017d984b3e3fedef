"""Secrets in texts and in what is encoded within them."""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.llm.shared import only_holder

# The kinds in their order, their patterns, and the least length of what counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_CHARS = 12
# The runs are maximal, so these find what the open runs find and the length check keeps.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

URL_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPES = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|%u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})+"
    r"|&#(?:[0-9]{1,7}|x[0-9A-Fa-f]{1,6});"
)
# Runs of an address or a form, in which a plus may stand for a blank.
FORM_RUNS = re.compile(r"[A-Za-z0-9_.~*%+&=:;,@/?-]{4,}")
FORM_ESCAPES = re.compile(r"\+|(?:%[0-9A-Fa-f]{2})+")
# Compressed bytes of which only those are escaped that are no plain characters. They begin as
# gzip, zlib, bz2 and xz streams do.
PACKED_IN_URL = re.compile(
    r"(?:%1[fF]%8[bB]|(?:x|%78)%(?:01|5[eE]|9[cC]|[dD][aA])|BZh[1-9]1AY(?:%26|&)SY|%[fF][dD]7zXZ%00)"
    r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~!*'()+/-])*"
)
PACKED_IN_ESCAPES = re.compile(
    r"(?:\\x1[fF]\\x8[bB]|(?:x|\\x78)\\x(?:01|5[eE]|9[cC]|[dD][aA])|BZh[1-9]1AY&SY|\\x[fF][dD]7zXZ\\x00)"
    r"(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0'\"\\]|[\x20-\x5b\x5d-\x7e])*"
)
PACKED_BYTES = re.compile(r"%[0-9A-Fa-f]{2}|\\x[0-9A-Fa-f]{2}|\\.|.")
# Bytes that a backslash and a letter stand for.
LETTER_ESCAPES = {"a": 7, "b": 8, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11, "0": 0}
# Runs, and the lines of runs that follow one another.
BASE64_RUNS = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}(?:\r?\n[\t\x20]*[A-Za-z0-9+/_-]+={0,2})*")
BASE64_LINES = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
BASE64_CHARS = 16
# Of so many bytes or more, one in five may be unreadable.
LOSSY_BYTES = 24
ODD_CHARS = re.compile(r"[^\t\n\r\x20-\x7e\x85\xa0-퟿-�\U00010000-\U0010ffff]")

# A compressed layer may grow to so many bytes; a larger one is counted, and scanned in windows.
LAYER_BYTES = 64_000_000
# Windows have so many characters or more, up to where no secret or encoded part can go on. Where
# there is no such place for LAYER_BYTES, they overlap.
WINDOW_CHARS, OVERLAP_CHARS = 1_000_000, 65_536
# A word between blanks before another word, or a character that is in no pattern.
BORDER = re.compile(r"\x20[a-z]{1,12}(?=\x20[a-z])|[,()\[\]{}<>|!?*~^$@]|[^\x00-\x7f]")
LONG_BLANKS = re.compile(r"\x20{65,}")

Span = tuple[str, int, int]


@dataclass
class Layer:
    """A text made from its parent by decoding some parts of it.

    ``pieces`` holds (start here, start there, end there, same length) of each
    part, in order, so that a span here is mapped to the text it came from.
    """

    text: str
    parent: Layer | None = None
    pieces: list[tuple[int, int, int, bool]] = field(default_factory=list)

    def origin(self, start: int, end: int) -> tuple[int, int]:
        layer = self
        while layer.parent is not None:
            first = layer._piece(start)
            last = layer._piece(end - 1)
            start = first[1] + (start - first[0] if first[3] else 0)
            end = last[1] + (end - last[0]) if last[3] else last[2]
            layer = layer.parent
        return start, end

    def _piece(self, at: int) -> tuple[int, int, int, bool]:
        return self.pieces[bisect_right(self.pieces, (at, float("inf"))) - 1]


def scan(text: str) -> list[Span]:
    """Spans of each kind, leftmost and not overlapping, by start and then kind."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_CHARS
    ]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if not text or ODD_CHARS.search(text) else text


def _mostly_readable(raw: bytes) -> str | None:
    """The text of these bytes, those that are none replaced, if most are readable."""
    if len(raw) < LOSSY_BYTES:
        return _readable(raw)
    text = raw.decode("utf-8", "replace")
    odd = sum(map(len, ODD_CHARS.findall(text))) + text.count("\ufffd")
    return text if 5 * odd <= len(text) else None


class TooLarge(Exception):
    """A compressed layer beyond ``LAYER_BYTES``; the argument is what to unwrap."""


# Memory that an xz stream may ask for: more than the largest usual setting does.
XZ_BYTES = 128_000_000
# Fixed value: what stands before a deflate stream in gzip.
GZIP_HEADER = b"\x1f\x8b\x08\0\0\0\0\0\0\x03"
# What decompressors raise on bytes that are no such stream.
BROKEN = (zlib.error, lzma.LZMAError, OSError, EOFError, ValueError)


class _Held:
    """A bz2 or xz decompressor; input that it has not taken yet is ``unconsumed_tail``, as with zlib."""

    def __init__(self, stream):
        self._stream, self.unconsumed_tail = stream, b""

    eof = property(lambda self: self._stream.eof)
    unused_data = property(lambda self: self._stream.unused_data)

    @property
    def pending(self) -> bool:
        """Whether there is more to come without further input."""
        return not self._stream.eof and not self._stream.needs_input

    def decompress(self, raw: bytes, most: int) -> bytes:
        if self.pending:
            self.unconsumed_tail = raw
            return self._stream.decompress(b"", most)
        self.unconsumed_tail = b""
        return self._stream.decompress(raw, most)


def _wraps(raw: bytes) -> bool:
    """Whether bytes begin as a gzip, zlib, bz2 or xz stream does."""
    return raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78" or raw[:3] == b"BZh" or raw[:6] == b"\xfd7zXZ\x00"


def _stream(raw: bytes):
    """A decompressor of what bytes begin with."""
    if raw[:3] == b"BZh":
        return _Held(bz2.BZ2Decompressor())
    if raw[:1] == b"\xfd":
        return _Held(lzma.LZMADecompressor(lzma.FORMAT_XZ, memlimit=XZ_BYTES))
    return zlib.decompressobj(31 if raw[:1] == b"\x1f" else 15)


def _inflated(raw: bytes) -> bytes:
    """What gzip, zlib, bz2 or xz members in a row hold, down through streams within streams; else ``raw``.

    What follows the last member is kept if it is text; of one cut short what is there.
    """
    seen = set()
    while raw not in seen:
        seen.add(raw)
        out, size, rest = [], 0, raw
        while _wraps(rest):
            stream = _stream(rest)
            try:
                member = stream.decompress(rest, LAYER_BYTES + 1 - size)
            except BROKEN:
                break
            size += len(member)
            if size > LAYER_BYTES:
                raise TooLarge(raw)
            if member or stream.eof:
                out.append(member)
            rest = stream.unused_data.lstrip(b"\0")
            if not stream.eof:
                break
        if not out:
            break
        raw = b"".join([*out, rest if _readable(rest) else b""])
    return raw


def _pieces(chunks: Iterator[bytes], seen: frozenset[bytes] = frozenset()) -> Iterator[bytes]:
    """What ``_inflated`` gives, in pieces, however large; of a broken stream what comes before the break."""
    head = next(chunks, b"")
    while len(head) < 6 and (more := next(chunks, b"")):
        head += more
    if not _wraps(head) or head in seen:
        yield from chain([head], chunks)
        return
    inner = _stream_pieces(_stream(head), chain([head], chunks))
    try:
        first = next(inner, b"")
    except BROKEN:
        yield from chain([head], chunks)
        return
    yield from _pieces(chain([first], _until_broken(inner)), seen | {head})


def _stream_pieces(stream, chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The members in a row, and what follows the last one."""
    rest, fresh = b"", False
    for chunk in chunks:
        rest += chunk
        while rest or getattr(stream, "pending", False):
            if stream.eof:
                rest = rest.lstrip(b"\0")
                if len(rest) < 6 and (more := next(chunks, b"")):
                    rest += more
                    continue
                if not _wraps(rest):
                    yield from chain([rest], chunks)
                    return
                stream, fresh = _stream(rest), True
            try:
                out = stream.decompress(rest, WINDOW_CHARS)
            except BROKEN:
                # What only begins like another member is text.
                if fresh:
                    yield from chain([rest], chunks)
                    return
                raise
            fresh = False
            rest = stream.unused_data if stream.eof else stream.unconsumed_tail
            if out:
                yield out
    while not stream.eof and (out := stream.decompress(b"", WINDOW_CHARS)):
        yield out


def _until_broken(pieces: Iterator[bytes]) -> Iterator[bytes]:
    try:
        yield from pieces
    except BROKEN:
        return


def _windows(raw: bytes) -> Iterator[str]:
    """The text of a compressed layer of any size, cut where no secret or encoded part goes on."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    text, wanted = "", min(WINDOW_CHARS, LAYER_BYTES)
    for piece in _pieces(iter([raw])):
        # The number of blanks in a row tells nothing apart.
        text = LONG_BLANKS.sub(" " * 64, text + decoder.decode(piece))
        while len(text) >= wanted:
            window = text[:wanted]
            borders = [m.end() for m in BORDER.finditer(window, max(0, wanted - 4096))]
            borders = borders or [m.end() for m in BORDER.finditer(window)]
            if borders:
                cut = next_start = borders[-1]
            elif wanted < LAYER_BYTES:
                wanted = min(2 * wanted, LAYER_BYTES)
                continue
            else:
                cut, next_start = wanted, wanted - min(OVERLAP_CHARS, wanted // 2)
            yield text[:cut]
            text, wanted = text[next_start:], min(WINDOW_CHARS, LAYER_BYTES)
    yield text + decoder.decode(b"", True)


def _kinds_within(raw: bytes) -> set[str]:
    """The kinds of secrets in a compressed layer of any size, and in what is encoded within it."""
    kinds: set[str] = set()
    for window in _windows(raw):
        kinds |= {k for k, _, _ in find_secrets(window)[1]}
        if len(kinds) == len(KINDS):
            break
    return kinds


def _text_of(raw: bytes) -> str | TooLarge | None:
    """The text that escaped bytes stand for, compressed ones inflated."""
    if _wraps(raw):
        try:
            if (inflated := _inflated(raw)) != raw:
                return _mostly_readable(inflated)
        except TooLarge as found:
            return found
    text = _utf16(raw) or raw.decode("utf-8", "replace")
    return None if not text.strip("\ufffd") else text


def _utf16(raw: bytes) -> str | None:
    """The text of UTF-16 bytes, most of which are characters of one byte and a zero."""
    if len(raw) < 8:
        return None
    marked = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}.get(raw[:2])
    even, odd = raw[::2].count(0), raw[1::2].count(0)
    order = marked or ("utf-16-le" if odd > even else "utf-16-be")
    if not marked and 5 * max(even, odd) < 2 * len(raw):
        return None
    body = raw[2:] if marked else raw
    return _readable(body[: len(body) // 2 * 2].decode(order, "replace").encode("utf-8", "replace"))


def _deflated(raw: bytes) -> str | TooLarge | None:
    """The text of a deflate stream without a header, which ends where the bytes do."""
    stream = zlib.decompressobj(-15)
    try:
        out = stream.decompress(raw, LAYER_BYTES + 1)
    except zlib.error:
        return None
    if len(out) > LAYER_BYTES:
        return TooLarge(GZIP_HEADER + raw)
    return _readable(out) if stream.eof and not stream.unused_data else None


def _url(escapes: str) -> str | TooLarge | None:
    return _text_of(bytes.fromhex(escapes.replace("%", "")))


def _form_parts(run: str) -> Iterator[Part]:
    """Escapes and pluses of a run that has both, as they are in forms."""
    if "+" in run and "%" in run:
        for m in FORM_ESCAPES.finditer(run):
            text = " " if m.group() == "+" else _url(m.group())
            if text is not None:
                yield *m.span(), text


def _packed_parts(run: str) -> Iterator[Part]:
    """The text of compressed bytes, up to where their stream ends."""
    raw, pluses, ends = bytearray(), [], []
    for m in PACKED_BYTES.finditer(run):
        token = m.group()
        if len(token) > 2:
            raw.append(int(token[-2:], 16))
        elif len(token) == 2:
            raw.append(LETTER_ESCAPES.get(token[1], ord(token[1])))
        else:
            if token == "+":
                pluses.append(len(raw))
            raw.append(ord(token))
        ends.append(m.end())
    # In a form, a plus is the byte of a blank.
    blanked = bytearray(raw)
    for at in pluses:
        blanked[at] = 0x20
    for some in dict.fromkeys((bytes(raw), bytes(blanked))):
        try:
            stream = _stream(some)
            out = stream.decompress(some, LAYER_BYTES + 1)
        except BROKEN:
            continue
        used = len(some) - len(stream.unused_data) if stream.eof else len(some)
        if not out or not used:
            continue
        try:
            text = _mostly_readable(_inflated(some[:used]))
        except TooLarge as found:
            text = found
        if text is not None:
            yield 0, ends[used - 1], text
            return


def _unicode(escapes: str) -> str | TooLarge | None:
    if escapes[0] == "&":
        digits = escapes[2:-1]
        code = int(digits[1:], 16) if digits[0] == "x" else int(digits)
        return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    codes = [int(x, 16) for x in re.findall(r"[\\%][uxU]\{?([0-9A-Fa-f]+)", escapes)]
    if max(codes) < 256 and _wraps(raw := bytes(codes)):
        return _text_of(raw)
    if max(codes) > 0x10FFFF:
        return None
    units = (chr(c).encode("utf-16-le", "surrogatepass") for c in codes)
    text = b"".join(units).decode("utf-16-le", "replace")
    return None if not text.strip("\ufffd") else text


Part = tuple[int, int, str | TooLarge]


def _whole(decode: Callable[[str], str | TooLarge | None]) -> Callable[[str], Iterator[Part]]:
    """A decoder of a run as one part."""

    def parts(run: str) -> Iterator[Part]:
        text = decode(run)
        if text is not None:
            yield 0, len(run), text

    return parts


def _plain(run: str) -> str:
    return run.rstrip("=").translate({0x2D: "+", 0x5F: "/"})


def _bytes_of(body: str) -> bytes:
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body + "=" * (-len(body) % 4))


def _base64(body: str, read: Callable[[bytes], str | None], begins: bool = False) -> str | TooLarge | None:
    """What base64 stands for; if ``begins``, only if its first bytes are text or a stream already.

    What is no text in UTF-8 may be one in UTF-16, or deflated without a header.
    """
    if begins and not _wraps(head := _bytes_of(body[:64])) and _mostly_readable(head) is None:
        return None
    try:
        raw = _inflated(_bytes_of(body))
    except TooLarge as found:
        return found
    text = _utf16(raw) or read(raw)
    return text if text is not None or begins else _deflated(raw)


def _words_of_run(body: str) -> Iterator[Part]:
    for m in re.finditer(r"[A-Za-z0-9+]{16,}", body):
        text = _base64(m.group(), _readable)
        if text is not None:
            yield m.start(), m.end(), text


def _run_parts(run: str) -> Iterator[Part]:
    """What a run holds: all of it, what follows a character that also parts words, or another phase."""
    body = _plain(run)
    text = _base64(body, _readable)
    if text is not None:
        yield 0, len(run), text
        return
    starts = [m.end() for m in re.finditer(r"[/_-]", run)]
    for at, begins in [*((x, True) for x in starts), (0, False), (1, False), (2, False), (3, False)]:
        if len(body) - at < BASE64_CHARS:
            continue
        text = _base64(body[at:], _mostly_readable, begins)
        if text is not None:
            if at > BASE64_CHARS:
                yield from _words_of_run(run[: at - 1])
            yield at, len(run), text
            return
    if starts:
        yield from _words_of_run(run.rstrip("="))


def _base64_parts(block: str) -> Iterator[Part]:
    """The readable base64 in lines of runs.

    A line and those after it of one length, and a shorter one after these,
    are read as one text; lines that are no such text are read one by one.
    """
    lines = [m.span() for m in BASE64_LINES.finditer(block)]
    width = [e - s for s, e in lines]
    ended = [block[e - 1] == "=" for _, e in lines]
    last = list(range(len(lines)))  # of the lines of one length
    for i in range(len(lines) - 2, -1, -1):
        if width[i] == width[i + 1] and not ended[i]:
            last[i] = last[i + 1]
    i = 0
    while i < len(lines):
        ends = []
        if not ended[i] and i + 1 < len(lines):
            end = last[i + 1]
            longer = end + 1 < len(lines) and width[end + 1] < width[end] and not ended[end]
            ends = [end + 1, end] if longer else [end]
        inside = i > 0 and width[i] == width[i - 1]
        for end in ends:
            head = "".join(block[s:e] for s, e in lines[i : min(end + 1, i + 64)])[:64]
            if inside and not _wraps(_bytes_of(_plain(head))) and _mostly_readable(_bytes_of(_plain(head))) is None:
                continue
            body = _plain("".join(block[s:e] for s, e in lines[i : end + 1]))
            # A line of another length may be none of the block, so it has to fit whole.
            alike = width[i] == width[i + 1] or end == i + 1 and width[end] < width[i]
            read = _mostly_readable if alike else _readable
            text = _base64(body, read) if len(body) >= BASE64_CHARS else None
            if text is not None:
                yield lines[i][0], lines[end][1], text
                i = end + 1
                break
        else:
            s, e = lines[i]
            if e - s >= BASE64_CHARS:
                for start, end, text in _run_parts(block[s:e]):
                    yield s + start, s + end, text
            i += 1


DECODERS: tuple[tuple[str | None, re.Pattern, Callable[[str], Iterator[Part]]], ...] = (
    ("%", URL_ESCAPES, _whole(_url)),
    ("%", FORM_RUNS, _form_parts),
    ("%", PACKED_IN_URL, _packed_parts),
    ("\\x", PACKED_IN_ESCAPES, _packed_parts),
    (None, UNICODE_ESCAPES, _whole(_unicode)),
    (None, BASE64_RUNS, _base64_parts),
)


def _decoded(
    layer: Layer, pattern: re.Pattern, decode: Callable[[str], Iterator[Part]]
) -> tuple[Layer | None, list[tuple[int, int, bytes]]]:
    """The layer with every part decoded that the decoder can read, and the parts too large."""
    text, out, pieces, at, size, large = layer.text, [], [], 0, 0, []
    for m in pattern.finditer(text):
        for start, end, new in decode(m.group()):
            start, end = m.start() + start, m.start() + end
            if isinstance(new, TooLarge):
                large.append((start, end, new.args[0]))
                continue
            if new == text[start:end]:
                continue
            if start > at:
                pieces.append((size, at, start, True))
                out.append(text[at:start])
                size += start - at
            pieces.append((size, start, end, False))
            out.append(new)
            size += len(new)
            at = end
    if not pieces:
        return None, large
    if at < len(text):
        pieces.append((size, at, len(text), True))
        out.append(text[at:])
    return Layer("".join(out), layer, [p for p in pieces if p[2] > p[1]]), large


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def find_secrets(text: str) -> tuple[list[Span], list[Span], int, int]:
    """Base spans, all spans, layers read, and parts too large to unwrap at once.

    Layers wait in a list. Each is scanned once, its spans mapped to the
    original text, and each decoder makes at most one new layer of it. A layer
    whose text was seen before is not taken up again, so layers that decode to
    each other end; a text without encoded parts ends at once. What is found
    in a part too large to unwrap at once is mapped to the whole part.
    """
    base = scan(text)
    spans = {(s, KINDS.index(k), e) for k, s, e in base}
    waiting, seen, n_layers, large = [Layer(text)], {_digest(text)}, 1, 0
    streamed: set[tuple[tuple[int, int], bytes]] = set()
    while waiting:
        layer = waiting.pop()
        for mark, pattern, decode in DECODERS:
            if mark is not None and mark not in layer.text:
                continue
            child, refused = _decoded(layer, pattern, decode)
            for start, end, raw in refused:
                if (key := (layer.origin(start, end), hashlib.blake2b(raw).digest())) in streamed:
                    continue
                streamed.add(key)
                large += 1
                spans |= {(key[0][0], KINDS.index(k), key[0][1]) for k in _kinds_within(raw)}
            if child is None or (key := _digest(child.text)) in seen:
                continue
            seen.add(key)
            n_layers += 1
            for kind, start, end in scan(child.text):
                start, end = child.origin(start, end)
                spans.add((start, KINDS.index(kind), end))
            waiting.append(child)
    return base, [(KINDS[k], s, e) for s, k, e in sorted(spans)], n_layers, large


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


RESULT = {
    "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string",
    "spans": "string", "n_layers": "bigint", "n_too_large": "bigint",
}


def _results(texts: list[str | None]) -> dict[str, list]:
    rows = {name: [] for name in RESULT}
    for text in texts:
        base, spans, layers, large = find_secrets(text or "")
        kinds = [k for k, _, _ in base]
        for name, kind in zip(("n_assign", "n_access", "n_hex"), KINDS):
            rows[name].append(kinds.count(kind))
        rows["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
        rows["spans"].append(joined(spans))
        rows["n_layers"].append(layers)
        rows["n_too_large"].append(large)
    return rows


def _schema_with(docs: DataFrame, added: dict[str, str]) -> T.StructType:
    fields = [f for f in docs.schema.fields if f.name not in added]
    new = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added.items()))
    return T.StructType(fields + new.fields)


def scan_documents(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the counts and digest of base spans and ``spans``, all spans found.

    Columns so named are replaced. A null text is an empty one and has no
    spans. Spans are code points of the original text, the end left out; a
    span found in a decoded layer covers the encoded parts it came from. Rows
    are scanned one by one, so repeated rows have equal results and an empty
    table gives none. ``n_too_large`` counts compressed parts that grow beyond
    ``LAYER_BYTES``: these are scanned in windows, and what is found in one
    covers the whole part.
    """
    kept = [c for c in docs.columns if c not in RESULT and (keep_text or c != text)]
    schema = _schema_with(docs.select(*kept), RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_holder("secrets", lambda: None)
        types = {"bigint": pa.int64(), "string": pa.string()}
        for batch in batches:
            rows = _results(batch.column(batch.schema.get_field_index(text)).to_pylist())
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            columns += [pa.array(rows[n], types[t]) for n, t in RESULT.items()]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *RESULT])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, schema)


@F.pandas_udf(T.StringType())
def redact(texts: pd.Series) -> pd.Series:
    """Texts without their secrets; a text without any stays as it is, a null or empty one too.

    Texts are read whole, however long; repeated texts give equal ones.
    """
    only_holder("secrets", lambda: None)
    return texts.map(lambda t: t if t is None else redacted(t, find_secrets(t)[1]))
