import base64
import bz2
import gzip
import lzma
import random
import re
import urllib.parse
import zlib
from itertools import product

import pytest

from daymill.llm import secrets

SECRET = "password = hunter2hunter2hunter2"


def deflate(raw):
    packer = zlib.compressobj(wbits=-15)
    return packer.compress(raw) + packer.flush()


PACKERS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress}
ESCAPED_BYTES = {
    "all in URL": lambda raw: "".join(f"%{b:02x}" for b in raw),
    "some in URL": lambda raw: urllib.parse.quote(raw, safe=""),
    "form": lambda raw: urllib.parse.quote_plus(raw),
    "all escaped": lambda raw: "".join(f"\\x{b:02x}" for b in raw),
    "as Python writes bytes": lambda raw: repr(raw)[2:-1],
    "base64": lambda raw: base64.b64encode(raw).decode(),
}
TEXTS = {
    "percent u": lambda t: "".join(f"%u{ord(c):04X}" for c in t),
    "long escapes": lambda t: "".join(f"\\U{ord(c):08x}" for c in t),
    "braces": lambda t: "".join(f"\\u{{{ord(c):x}}}" for c in t),
    "escapes": lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
    "form": urllib.parse.quote_plus,
    "UTF-16": lambda t: base64.b64encode(t.encode("utf-16")).decode(),
    "UTF-16 without mark": lambda t: base64.b64encode(t.encode("utf-16-be")).decode(),
    "deflate": lambda t: base64.b64encode(deflate(t.encode())).decode(),
    "base64": lambda t: base64.b64encode(t.encode()).decode(),
    "URL": lambda t: "".join(f"%{b:02X}" for b in t.encode()),
}


def kinds_in(part, before="é see ", after=" and so on"):
    """Kinds found in the part, whose spans all lie in it."""
    text = f"{before}{part}{after}"
    base, spans, _, _ = secrets.find_secrets(text)
    assert set(base) <= set(spans)
    assert all(len(before) <= s < e <= len(before) + len(part) for _, s, e in spans)
    clean = secrets.redacted(text, spans)
    assert clean.startswith(before) and clean.endswith(after)
    return {k for k, _, _ in spans}


@pytest.mark.parametrize("packer,escaped", list(product(PACKERS, ESCAPED_BYTES)))
def test_compressed_bytes_however_written(packer, escaped):
    rng = random.Random(1)
    filler = " ".join(f"w{rng.randrange(10_000)}" for _ in range(40))
    for body in (SECRET, f"{filler} {SECRET} {filler}", f"{filler} {base64.b64encode(SECRET.encode()).decode()}"):
        assert kinds_in(ESCAPED_BYTES[escaped](PACKERS[packer](body.encode()))) == {"assign"}


@pytest.mark.parametrize("outer,inner", list(product(TEXTS, TEXTS)))
def test_all_nestings_of_text(outer, inner):
    assert kinds_in(TEXTS[outer](f"so {TEXTS[inner](f'it is {SECRET} here')} then")) == {"assign"}


def test_a_plus_is_a_blank_in_forms_only():
    text = "POST q=the+password+%3D+hunter2hunter2hunter2&x=1 now"
    (span,) = [s for s in secrets.find_secrets(text)[1] if s[0] == "assign"]
    assert text[span[1] : span[2]].startswith("password+%3D+hunter2")
    assert secrets.find_secrets("a+password+=+hunter2hunter2hunter2")[1] == []


@pytest.mark.parametrize("packer", PACKERS)
def test_streams_too_large_at_once(monkeypatch, packer):
    monkeypatch.setattr(secrets, "LAYER_BYTES", 3_000)
    rng = random.Random(2)
    filler = " ".join(f"w{rng.randrange(10_000)}" for _ in range(2_000))
    for body in (f"{SECRET} {filler}", f"{filler} {SECRET}"):
        part = base64.b64encode(PACKERS[packer](body.encode())).decode()
        base, spans, _, large = secrets.find_secrets(f"see {part} end")
        assert large == 1 and ("assign", 4, 4 + len(part)) in spans
    raw = PACKERS[packer](b"first ") + PACKERS[packer](filler.encode()) + PACKERS[packer](SECRET.encode())
    assert ("assign", 0, len(base64.b64encode(raw))) in secrets.find_secrets(base64.b64encode(raw).decode())[1]


def test_what_is_no_stream_is_left_alone():
    rng = random.Random(4)
    for _ in range(300):
        noise = base64.b64encode(rng.randbytes(rng.randrange(12, 80))).decode()
        assert secrets.find_secrets(f"x {noise} y")[1] == secrets.scan(f"x {noise} y")
    for text in ("%1f%8b", "x%9c", "\\x1f\\x8b", "BZh91AY&SY", "%uD800%u", "\\u{110000}", "\\UFFFFFFFF", "+%+%zz", "%FD7zXZ%00+"):
        assert secrets.find_secrets(f"a {text} b")[1] == []


def plain_base_spans(text):
    """The base spans by a walk over the text, kind by kind."""
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    found = []

    def run(at, allowed):
        while at < len(text) and text[at] in allowed:
            at += 1
        return at

    at = 0
    while at < len(text):
        word = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if text[at : at + len(w)].lower() == w and text[at : at + len(w)].isascii()), None)
        if word is not None:
            i = at + len(word)
            i += text[i : i + 1] in ('"', "'")
            i = run(i, " ")
            if text[i : i + 1] in (":", "="):
                i = run(i + 1, " ")
                i += text[i : i + 1] in ('"', "'")
                end = run(i, letters + "+/_.=-")
                if end > i:
                    if end - i >= 12:
                        found.append((at, 0, end))
                    at = end
                    continue
        at += 1
    for number, (mark, allowed, least) in enumerate((("AKIA", letters[26:], 18), ("", "0123456789abcdef", 16)), 1):
        at = 0
        while at < len(text):
            if text.startswith(mark, at) and (end := run(at + len(mark), allowed)) > at + len(mark):
                if end - at >= least:
                    found.append((at, number, end))
                at = end
            else:
                at += 1
    return [(secrets.KINDS[k], s, e) for s, k, e in sorted(found)]


def test_base_spans_of_documents_equal_a_plain_walk(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = 0
    for text in texts:
        spans = secrets.scan(text)
        assert spans == plain_base_spans(text)
        found += len(spans)
    assert found > 5


def test_each_pattern_takes_time_in_proportion():
    import time

    for piece in ("a+", "%41", "\\x41", "A" * 20 + "/", "x%9c", "BZh91AY&SY", "%u0041", "&#65;", "\\u{41}", "=" * 3 + "a"):
        text = piece * (400_000 // len(piece))
        began = time.perf_counter()
        secrets.find_secrets(text)
        assert time.perf_counter() - began < 20, piece
    assert re.fullmatch(secrets.UNICODE_ESCAPES, "\\u{1F600}")
