"""Secret scan with a worklist of decoded layers.

The text of a document is the first layer. Every layer is scanned for the three kinds of secrets, then unwrapped: lines that hold URL escapes,
lines that hold Unicode escapes, and runs of base64 letters (which may hold compressed bytes) each give another layer, which goes to the
worklist in turn, until no layer brings a new one. A layer that stands for the same place with the same content as
one seen before is a cycle and is not entered again. A layer carries, for each of its characters, the span of the document it was made of; so a
match in any layer is a span of the document.

URL and Unicode escapes are decoded within their line, so that a match may begin or end outside the escape; no secret goes past the end
of a line. Base64 is a layer of its own: a byte's span are the letters that hold its bits. Bytes that came out of compression stand for the whole run. What a run
holds is accepted if it is UTF-8 text without control characters, or UTF-16 of such text.

Compressed bytes are unpacked piece by piece: beyond ``most_bytes`` the text goes on in a further window, which begins with the last ``OVERLAP`` characters of
the one before. So memory is bounded for archives that unpack to very much, and only a secret or a run longer than the overlap could be cut.

Spans are (kind, start, end, layers) in code points, end exclusive; those found in the text itself come from ``base`` matching, whatever layers
add. Defined cases: a null or empty text has no spans; the same span found in several layers is one span, with the shortest way; repeated
rows give repeated results; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from collections import deque
from collections.abc import Container, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from llm.text import small_batches

# Kinds of secrets, their patterns and least lengths, in the order in which ties are listed.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a shorter run fails as a whole
LEAST = {"assign": 8, "access": 16}

MOST_BYTES = 32 << 20
OVERLAP = 1 << 16
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
# Any number of backslashes, as escapes of escapes have; a pair of surrogates is one character.
_UNICODE = re.compile(
    r"\\+u[dD][89abAB][0-9A-Fa-f]{2}\\+u[dD][c-fC-F][0-9A-Fa-f]{2}|\\+u[0-9A-Fa-f]{4}|\\+u\{[0-9A-Fa-f]{1,6}\}|\\+U[0-9A-Fa-f]{8}|\\+x[0-9A-Fa-f]{2}|&#[xX][0-9A-Fa-f]{1,6};|&#[0-9]{1,7};"
)
# 14 characters are the shortest secret; in base64 these are 19 letters. Wrapped lines are one run first.
LEAST_BYTES, LEAST_LETTERS = 14, 19
_RUN = re.compile(r"(?:[A-Za-z0-9+/_-]{40,}\r?\n)+[A-Za-z0-9+/_-]+={0,2}|[A-Za-z0-9+/_-]{19,}={0,2}")
_PRINTABLE = re.compile(rb"[\t\r\n\x20-\x7e]{14,}")
# What a text must hold before one of the patterns, or a decoder, can find anything; read by Arrow for a whole batch at once.
_HINTS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": "AKIA[A-Z0-9]{12}",
    "hex": "[0-9a-f]{32}",
    "coded": r"%[0-9A-Fa-f]{2}|\\[uUx]|&#|[A-Za-z0-9+/_-]{19}",
}
_CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
_STANDARD = str.maketrans("-_", "+/")
_TEXT = "array<struct<kind: string, start: bigint, end: bigint, layers: string>>"

Span = tuple[str, int, int]


def base_spans(text: str, kinds: Container[str] = KINDS) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    out = []
    if "assign" in kinds:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "access" in kinds:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if "hex" in kinds:
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


class Layer:
    """A text and the span of the document for each of its characters: [starts[i], ends[i])."""

    __slots__ = ("ends", "starts", "text", "way")

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, way: str):
        self.text, self.starts, self.ends, self.way = text, starts, ends, way

    def span(self, kind: str, a: int, b: int) -> Span:
        return kind, int(self.starts[a:b].min()), int(self.ends[a:b].max())

    def name(self) -> tuple:
        """What makes two layers the same: content and place."""
        return xxhash.xxh3_128_digest(self.text.encode("utf-8", "surrogatepass")), int(self.starts[0]), int(self.ends[-1])


def _code_points(data: bytes) -> tuple[str, np.ndarray] | None:
    """Text of UTF-8 bytes and the first byte of each character, or nothing."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text, np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)


def _url_run(run: str) -> tuple[str, list[int], list[int]]:
    """Characters of a run of escapes, with the first and last place of each; bytes that are no UTF-8 are Latin letters."""
    data = bytes.fromhex(run.replace("%", ""))
    text, starts, ends, i = [], [], [], 0
    while i < len(data):
        lead = data[i]
        width = 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
        try:
            char = data[i : i + width].decode("utf-8")
        except UnicodeDecodeError:
            char, width = chr(lead), 1
        text.append(char)
        starts.append(3 * i)
        ends.append(3 * (i + width))
        i += width
    return "".join(text), starts, ends


def _unicode_run(run: str) -> tuple[str, list[int], list[int]]:
    if run.startswith("&#"):
        number = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
    else:
        numbers = [int(digits.strip("uUx{}"), 16) for digits in run.split("\\") if digits]
        number = numbers[0]
        if len(numbers) == 2:
            number = 0x10000 + ((number - 0xD800) << 10) + (numbers[1] - 0xDC00)
    if number > 0x10FFFF or 0xD800 <= number < 0xE000:  # no character
        return run, list(range(len(run))), list(range(1, len(run) + 1))
    return chr(number), [0], [len(run)]


_ESCAPES = (("url", _URL, _url_run), ("unicode", _UNICODE, _unicode_run))


def _lines_with(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Spans of the lines in which a pattern occurs, each once."""
    done = 0
    for m in pattern.finditer(text):
        if m.start() < done:
            continue
        a = text.rfind("\n", 0, m.start()) + 1
        b = text.find("\n", m.end())
        done = len(text) if b < 0 else b
        yield a, done


def _unescaped(layer: Layer) -> Iterator[Layer]:
    for name, pattern, decode in _ESCAPES:
        for a, b in _lines_with(layer.text, pattern):
            line, parts, starts, ends, at = layer.text[a:b], [], [], [], 0
            for m in pattern.finditer(line):
                text, froms, tos = decode(m[0])
                parts += [line[at : m.start()], text]
                starts += [np.arange(at, m.start()), np.array(froms, np.int64) + m.start()]
                ends += [np.arange(at, m.start()) + 1, np.array(tos, np.int64) + m.start()]
                at = m.end()
            parts.append(line[at:])
            starts.append(np.arange(at, len(line)))
            ends.append(np.arange(at, len(line)) + 1)
            first, last = np.concatenate(starts) + a, np.concatenate(ends) - 1 + a
            if "".join(parts) != line:
                yield Layer("".join(parts), layer.starts[first], layer.ends[last], f"{layer.way}>{name}")


def _reader(data: bytes) -> tuple[str, object]:
    """Name of the compressed format that bytes begin with, and a reader for it."""
    if data[:2] == b"\x1f\x8b":
        return "gzip", zlib.decompressobj(31)
    if len(data) > 2 and data[0] & 0x0F == 8 and data[0] >> 4 <= 7 and (data[0] * 256 + data[1]) % 31 == 0:
        return "zlib", zlib.decompressobj()
    if data[:3] == b"BZh":
        return "bz2", bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor()
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return "zstd", zstandard.ZstdDecompressor().decompressobj()
    return "", None


def _unpacked(data: bytes, most_bytes: int) -> Iterator[tuple[str, bytes, int]]:
    """Pieces of what compressed bytes hold, with the format's name and the bytes used by then; nothing if they are not compressed."""
    used = 0
    while used < len(data):
        name, reader = _reader(data[used:])
        if reader is None:
            return
        try:
            if name == "zstd":  # a block of few bytes holds at most 128 KB
                while used < len(data) and not reader.eof:
                    piece = reader.decompress(data[used : used + 1024])
                    used += min(1024, len(data) - used)
                    used -= len(reader.unused_data)
                    if piece:
                        yield name, piece, used
                continue
            rest = data[used:]
            while not reader.eof:
                piece = reader.decompress(rest, most_bytes)
                rest = reader.unconsumed_tail if name in ("gzip", "zlib") else b""
                if piece:
                    yield name, piece, len(data) - len(reader.unused_data)
                elif not rest:
                    return
            used = len(data) - len(reader.unused_data)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
            return


def _as_text(data: bytes) -> tuple[str, np.ndarray] | None:
    """Text of bytes and the first byte of each character, if the bytes are text."""
    found = _code_points(data)
    if found and not _CONTROL.search(found[0]):
        return found
    if len(data) % 2 == 0 and len(data) >= 4:
        for coding, zero in (("utf-16-le", data[1::2]), ("utf-16-be", data[::2])):
            if zero.count(0) * 2 > len(zero):
                try:
                    text = data.decode(coding)
                except UnicodeDecodeError:
                    continue
                if not _CONTROL.search(text):
                    wide = np.array([2 if ord(c) > 0xFFFF else 1 for c in text], np.int64)
                    return text, 2 * (np.cumsum(wide) - wide)
    return None


def _parts(run: str) -> Iterator[tuple[int, int]]:
    """The run as a whole; of wrapped lines also all but the last, which may be other text, and each line."""
    yield 0, len(run)
    if "\n" in run:
        yield 0, run.rindex("\n")
        at = 0
        for line in run.split("\n"):
            if len(line) >= LEAST_LETTERS:
                yield at, at + len(line)
            at += len(line) + 1


def _decoded(layer: Layer, most_bytes: int) -> Iterator[Layer]:
    for m in _RUN.finditer(layer.text):
        for a, b in _parts(m[0]):
            way = ""
            # A run may begin with letters that are not part of it: then the bits stand at another place.
            for shift in range(4):
                for other in _decoded_run(layer, m.start() + a + shift, m.start() + b, most_bytes):
                    way = other.way
                    yield other
                if way:
                    break
            if way and not way.endswith(">base64"):
                break  # a compressed stream tells its own end


def _decoded_run(layer: Layer, a: int, b: int, most_bytes: int) -> Iterator[Layer]:
    run, letters = layer.text[a:b], np.arange(a, b)
    if "\n" in run:
        letters = letters[[c not in "\r\n" for c in run]]
        run = run.replace("\r", "").replace("\n", "")
    run = run.rstrip("=\r")
    run = run[: len(run) - (len(run) % 4 == 1)]
    try:
        data = base64.b64decode(run.translate(_STANDARD) + "=" * (-len(run) % 4))
    except binascii.Error:
        return
    if not data:
        return
    way = f"{layer.way}>base64"
    whole = _as_text(data)
    unpacked, used = False, 0
    if not whole:
        for *_, used in _unpacked(data, most_bytes):
            pass
    if used:
        unpacked, carried = True, b""
        start, end = int(layer.starts[letters[0]]), int(layer.ends[letters[(8 * used - 1) // 6]])
        for name, piece, _ in _unpacked(data, most_bytes):
            piece = carried + piece
            text, carried = piece.decode("utf-8", "replace"), piece[-OVERLAP:]
            yield Layer(text, np.full(len(text), start), np.full(len(text), end), f"{way}>{name}")
    found = [whole] if whole else []
    if not whole and not unpacked:
        found = [(x[0].decode(), np.arange(x.start(), x.end())) for x in _PRINTABLE.finditer(data)]
    for text, at in found:
        last = np.append(at[1:], at[-1] + 1 if not whole else len(data)) - 1
        # Byte j holds the bits 8j to 8j + 7, and a letter six bits.
        yield Layer(text, layer.starts[letters[8 * at // 6]], layer.ends[letters[(8 * last + 7) // 6]], way)


def scan_text(text: str | None, most_bytes: int = MOST_BYTES, hints: Container[str] = tuple(_HINTS)) -> list[tuple[str, int, int, str]]:
    """All spans of a text as (kind, start, end, layers), those of the text itself with no layers, in the order of start, kind and end.

    ``hints`` leave out what the text is known not to hold.
    """
    if not text:
        return []
    found: dict[Span, str] = {span: "" for span in base_spans(text, hints)}
    waiting: deque = deque()
    if "coded" in hints:
        places = np.arange(len(text) + 1, dtype=np.int64)
        waiting.append(iter((Layer(text, places[:-1], places[1:], ""),)))
    seen: set[tuple] = set()
    while waiting:
        layer = next(waiting[0], None)
        if layer is None:
            waiting.popleft()
            continue
        if not layer.text or layer.name() in seen:
            continue
        seen.add(layer.name())
        if layer.way:
            for kind, a, b in base_spans(layer.text):
                found.setdefault(layer.span(kind, a, b), layer.way[1:])
        waiting.append(_unescaped(layer))
        waiting.append(_decoded(layer, most_bytes))
    return sorted(((*span, way) for span, way in found.items()), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layers", pa.string())])
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            held = {name: pc.match_substring_regex(texts, hint).to_pylist() for name, hint in _HINTS.items()}
            spans = []
            for i in range(batch.num_rows):
                hints = [name for name in _HINTS if held[name][i]]
                spans.append(scan_text(texts[i].as_py(), most_bytes, hints) if hints else [])
            edges = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32)
            flat = [span for own in spans for span in own]
            fields = [pa.array([s[k] for s in flat], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))]
            values = pa.StructArray.from_arrays(fields, fields=list(kind))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(edges, values)], names=["doc_id", "spans"])

    return run


def scan(documents: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id and its spans, array<struct<kind, start, end, layers>>, for each row of (doc_id, text)."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_scan(most_bytes), f"doc_id bigint, spans {_TEXT}")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Numbers of the text's own spans, the hash of their list, and the list of all spans."""
    base = F.filter("spans", lambda s: s["layers"] == "")
    counted = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    counts = [counted(k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
