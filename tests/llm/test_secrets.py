import base64
import bz2
import gzip
import hashlib
import json
import lzma
import re
import zlib
from urllib.parse import quote, unquote

import pytest
import regex
import zstandard

from llm import registry, secrets
from tests.conftest import SF_DIR
from tests.llm.common import MESSY, documents

KEY = "AKIA" + "Q7" * 8
LINE = f"password = hunter2hunter2 and {KEY}."
PERCENT = "".join(f"%{b:02X}" for b in LINE.encode())


def b64(data, pad=True, safe=False):
    out = (base64.urlsafe_b64encode if safe else base64.b64encode)(data if isinstance(data, bytes) else data.encode()).decode()
    return out if pad else out.rstrip("=")


def base(text):
    """Base matching once more, by another library and without hints."""
    out = []
    for m in regex.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, regex.ASCII):
        if len(m.group(2)) >= 8:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in regex.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [("hex", *m.span()) for m in regex.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return out


def order(spans):
    return sorted(spans, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))


def kinds_of(text):
    return [(k, text[a:b], way) for k, a, b, way in secrets.scan_text(text)]


@pytest.mark.parametrize("wrap", [
    lambda x: b64(x), lambda x: b64(x, pad=False), lambda x: b64(x, safe=True), lambda x: b64(b64(x)), lambda x: b64(b64(b64(x))),
    lambda x: b64(gzip.compress(x.encode())), lambda x: b64(zlib.compress(x.encode())), lambda x: b64(bz2.compress(x.encode())),
    lambda x: b64(lzma.compress(x.encode())), lambda x: b64(zstandard.compress(x.encode())), lambda x: b64(gzip.compress(b64(gzip.compress(x.encode())).encode())),
    lambda x: b64(gzip.compress(b"first member. ") + gzip.compress(x.encode())), lambda x: b64(x.encode("utf-16-le")), lambda x: b64(x.encode("utf-16-be")),
    lambda x: base64.encodebytes((x + " " + "tail of more text " * 9).encode()).decode(), lambda x: b64(b"\x00\x01\xff\xfe" + x.encode() + b"\xff"),
    lambda x: "".join(f"%{b:02x}" for b in x.encode()), lambda x: quote(quote(quote(x))), lambda x: "".join(f"\\u{ord(c):04x}" for c in x), lambda x: "".join(f"\\x{ord(c):02x}" for c in x),
    lambda x: "".join(f"&#{ord(c)};" for c in x), lambda x: "".join(f"\\u{{{ord(c):x}}}" for c in x), lambda x: "".join(f"\\U{ord(c):08x}" for c in x),
    lambda x: "".join(f"%{b:02x}" for b in b64(x).encode()), lambda x: b64(json.dumps("é" + "".join(f"\\u{ord(c):04x}" for c in x))), lambda x: quote(b64(gzip.compress(quote(x).encode())), safe=""),
    lambda x: "path/" + b64(x),
])
def test_wrapped_secrets_are_found_within_their_code(wrap):
    code = wrap(LINE)
    text = f"été 東 \U0001f600: {code}\nand more"
    first = text.index(code)
    found = [(k, a, b) for k, a, b, _ in secrets.scan_text(text)]
    assert {k for k, _, _ in found} >= {"assign", "access"}
    assert all(first <= a < b <= first + len(code) for _, a, b in found)


def test_spans_point_at_the_letters_that_hold_the_secret():
    code = "".join(f"%{b:02X}" for b in "x: é ".encode())
    text = "ü " + code + quote(KEY[:4], safe="") + "%51" + KEY[5:] + " end"
    (found,) = secrets.scan_text(text)
    assert text[found[1] : found[2]] == KEY[:4] + "%51" + KEY[5:] and found[0] == "access" and found[3] == "url"
    plain = "not here; " + KEY + " there"
    text = "see " + b64(plain)
    (found,) = secrets.scan_text(text)
    assert found[1] == 4 + 8 * 10 // 6 and found[2] == 4 + (8 * (10 + len(KEY)) - 1) // 6 + 1
    text = "token%3A" + "a1B2" + "%2Fc3D4 rest"
    assert kinds_of(text) == [("assign", "token%3Aa1B2%2Fc3D4", "url")]


def test_a_cut_value_keeps_its_base_span_and_gains_a_longer_one():
    text = "secret=abcdefgh%2Fijkl"
    assert [(a, b, way) for _, a, b, way in secrets.scan_text(text)] == [(0, 15, ""), (0, len(text), "url")]


def test_cycles_and_plain_texts_end():
    assert secrets.scan_text("%25" * 300 + " %2525252541 \\u005cu005c &#38;#38;") == []
    assert secrets.scan_text("internationalization " * 200 + "f" * 31 + " AKIA12345 token=short%zz \\uD800 &#99999999; %") == []
    assert secrets.scan_text("\u017fecret=abcdefghij to\u212aen=abcdefghij") == [] == secrets.scan_text(None) == secrets.scan_text("")


def test_bombs_are_read_in_windows():
    body = b"x " * 3_000_000 + LINE.encode() + b" y" * 3_000_000
    text = b64(zlib.compress(body))
    assert {k for k, *_ in secrets.scan_text(text, most_bytes=1 << 17)} == {"assign", "access"}


def brute_force(text):
    """Depth-first, one character after the other, with a list of spans per layer."""
    found, seen = {(k, a, b) for k, a, b in base(text)}, set()

    def enter(chars, spans):
        if (chars, spans[:1], spans[-1:]) in seen:
            return
        seen.add((chars, spans[:1], spans[-1:]))
        found.update((k, min(s for s, _ in spans[a:b]), max(e for _, e in spans[a:b])) for k, a, b in base(chars))
        place = 0
        for line in chars.split("\n"):
            own = spans[place : place + len(line)]
            place += len(line) + 1
            for pattern, decode in ((r"%[0-9A-Fa-f]{2}", lambda m: unquote(m)), (r"\\u[0-9A-Fa-f]{4}", lambda m: chr(int(m[2:], 16)))):
                pieces, at = [], 0
                for m in re.finditer(pattern, line):
                    pieces += list(zip(line[at : m.start()], own[at : m.start()])) + [(decode(m[0]), (own[m.start()][0], own[m.end() - 1][1]))]
                    at = m.end()
                pieces += list(zip(line[at:], own[at:]))
                if at and "".join(c for c, _ in pieces) != line:
                    enter("".join(c for c, _ in pieces), tuple(s for _, s in pieces))
        for m in re.finditer(r"[A-Za-z0-9+/_-]{19,}", chars):
            whole = m[0][: len(m[0]) - (len(m[0]) % 4 == 1)].replace("-", "+").replace("_", "/")
            data = base64.b64decode(whole + "=" * (-len(whole) % 4))
            here = spans[m.start() : m.end()]
            if data[:2] == b"\x1f\x8b":
                inner = gzip.decompress(data).decode()
                enter(inner, ((here[0][0], here[len(whole) - 1][1]),) * len(inner))
            elif data.isascii() and not any(b < 9 for b in data):
                enter(data.decode(), tuple((here[8 * j // 6][0], here[(8 * j + 7) // 6][1]) for j in range(len(data))))

    enter(text, tuple((i, i + 1) for i in range(len(text))))
    return order(found)


PLANTED = [
    (101, LINE), (102, PERCENT), (103, "x " + b64(LINE)), (104, b64(b64(LINE))), (105, b64(gzip.compress(LINE.encode(), mtime=0))), (106, quote(b64(quote(LINE)), safe="")),
    (107, "a\\u0050assword\\u003dabcdefghijk\nAPI_KEY:'zzzzzzzz' apikey=\"12345678 passwd=1234567"), (108, "deadbeef" * 5 + "g" + "0" * 31 + "token : = x"), (109, f"{KEY}{KEY} é {LINE} " * 3),
    (110, "%54oken%3Dabcdefgh tail\n%AKIA"), (110, "%54oken%3Dabcdefgh tail\n%AKIA"), (111, "word " * 30_000 + LINE + "\n" + b64("more " + LINE)),
]


def test_query_equals_brute_force(spark):
    files = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = files + PLANTED + [r[:2] for r in MESSY]
    found = secrets.digests(secrets.scan(documents(spark, rows, clashing=True))).collect()
    got = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in found), key=repr)
    expected = []
    for doc_id, text in rows:
        own, every = order(base(text or "")), brute_force(text or "")
        join = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(k == kind for k, *_ in own) for kind in secrets.KINDS]
        expected.append((doc_id, *counts, hashlib.sha256(join(own).encode()).hexdigest(), join(every)))
    assert got == sorted(expected, key=repr)
    assert sum(n > 0 for _, n, *_ in got) >= 4 and sum(len(x[5].split(",")) > sum(x[1:4]) > 0 for x in got) >= 1
    query = registry.queries()["op13_secrets"](spark, SF_DIR).collect()
    assert sorted(map(tuple, query), key=repr) == sorted(expected[: len(files)], key=repr)


def test_empty_table(spark):
    assert secrets.digests(secrets.scan(documents(spark, []))).count() == 0
