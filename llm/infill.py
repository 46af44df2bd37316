"""Fill-in-the-middle transformation by displacement scatter.

A text is cut at two borders of its lines into prefix, middle and suffix, and written with a mark before each part. Nothing is joined
text by text: a batch of texts is one array of bytes. Where a part begins, a difference array notes by how much its bytes
move beyond those before; its running sum is the shift of every byte, so that one numpy scatter fills the whole output. Going back, the marks
in an output give the same shifts, and one gather through them restores the text.

Dense shifts stand for a block of bytes at a time, so that the memory beyond the texts does not grow with the length of a text.

Defined cases: a null text is empty; an empty text and one that holds a mark stay as they are (``plain``); a null doc_id counts as no
digits in the hash that draws cuts and form; repeated rows give repeated results; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from llm.text import chunks, small_batches, utf8

MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle: three bytes each
MARK_BYTES = 3
SEED = 7
PERCENT = 100
SPM_PERCENT = 50
BLOCK = 1 << 20
FORMS = ("plain", "psm", "spm")
_NEWLINE = 10
_HAS_MARK = "<[PSM]>"
_MARKS = np.frombuffer("".join(MARKS).encode(), np.uint8).reshape(3, MARK_BYTES)
_ORDER = {1: (0, 2, 1), 2: (2, 0, 1)}  # by form: parts (prefix 0, middle 1, suffix 2) in the order in which they are written


def draws(ids: list[int | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers for each doc_id."""
    found = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(found), ">u4").reshape(-1, 4).astype(np.int64)


def line_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all lines, in ascending order, and the number of the first line of each row (n+1 numbers).

    A line ends behind its newline; what follows the last newline of a text is a line too.
    """
    full = np.diff(offsets) > 0
    last = offsets[1:][full]
    ends = np.union1d(np.flatnonzero(data == _NEWLINE) + 1, last) if len(data) else np.zeros(0, np.int64)
    return ends, np.searchsorted(ends, offsets, "right")


def _layout(lengths: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of n x 3 part lengths: where each part begins within its output, where its mark does, and the output's length."""
    starts, marks = np.zeros_like(lengths), np.zeros_like(lengths)
    starts[:, 1] = lengths[:, 0]  # plain: the parts as they stand, without marks
    starts[:, 2] = lengths[:, 0] + lengths[:, 1]
    for form, order in _ORDER.items():
        own, at = forms == form, 0
        for part in order:
            marks[own, part] = at if isinstance(at, int) else at[own]
            starts[own, part] = marks[own, part] + MARK_BYTES
            at = np.where(own, starts[:, part] + lengths[:, part], 0)
    return starts, marks, lengths.sum(axis=1) + np.where(forms > 0, 3 * MARK_BYTES, 0)


def _moved(source: np.ndarray, begins: np.ndarray, targets: np.ndarray, size: int, gather: bool) -> np.ndarray:
    """Scatters source to an array of ``size`` bytes, or gathers source from its places.

    ``begins`` (ascending) are the first bytes of parts on the text's side and ``targets`` their places on the output's side. The
    difference array of shifts is summed block by block.
    """
    shifts = targets - begins
    steps = np.diff(shifts, prepend=0)
    whole = int(size if gather else len(source))  # length of the text's side
    out = np.empty(size, np.uint8)
    carried = 0
    for a in range(0, whole, BLOCK):
        b = min(a + BLOCK, whole)
        first, last = np.searchsorted(begins, [a, b])
        difference = np.zeros(b - a, np.int64)
        np.add.at(difference, begins[first:last] - a, steps[first:last])
        shift = np.cumsum(difference) + carried
        carried = int(shift[-1])
        place = np.arange(a, b) + shift
        if gather:
            out[a:b] = source[place]
        else:
            out[place] = source[a:b]
    return out


def scatter(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes and their n+1 offsets, from n x 2 cuts (bytes of ``data``) and a form for each row."""
    borders = np.column_stack([offsets[:-1], cuts, offsets[1:]])
    lengths = np.diff(borders, axis=1)
    starts, marks, sizes = _layout(lengths, forms)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = _moved(data, borders[:, :3].reshape(-1), (starts + ends[:-1, None]).reshape(-1), int(ends[-1]), False)
    marked = np.flatnonzero(forms > 0)
    for part, mark in ((0, _MARKS[0]), (1, _MARKS[2]), (2, _MARKS[1])):
        at = marks[marked, part] + ends[marked]
        for k in range(MARK_BYTES):
            out[at + k] = mark[k]
    return out, ends


def gather(output: np.ndarray, offsets: np.ndarray, forms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text bytes and their n+1 offsets, from outputs alone: the marks in an output tell its parts."""
    sizes = np.diff(offsets)
    lengths = np.zeros((len(sizes), 3), np.int64)
    lengths[:, 0] = sizes  # plain: all of it is one part
    if (forms > 0).any():
        at = np.flatnonzero((output[:-2] == _MARKS[0, 0]) & (output[2:] == _MARKS[0, 2]) & np.isin(output[1:-1], _MARKS[:, 1]))
        rows = np.searchsorted(offsets, at, "right") - 1
        at = at[(forms[rows] > 0) & (at + MARK_BYTES <= offsets[rows + 1])].reshape(-1, 3)  # three marks in each marked output
        marked = np.flatnonzero(forms > 0)
        runs = np.diff(np.column_stack([at, offsets[1:][marked]]), axis=1) - MARK_BYTES
        for form, order in _ORDER.items():
            own = forms[marked] == form
            lengths[np.ix_(marked[own], order)] = runs[own]
    starts, _, _ = _layout(lengths, forms)
    ends = np.concatenate([[0], np.cumsum(lengths.sum(axis=1))])
    begins = np.column_stack([ends[:-1], ends[:-1] + lengths[:, 0], ends[:-1] + lengths[:, 0] + lengths[:, 1]])
    return _moved(output, begins.reshape(-1), (starts + offsets[:-1, None]).reshape(-1), int(ends[-1]), True), ends


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data)]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, buffers[1], buffers[2]).cast(pa.string())


def _characters(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Code points of byte ranges."""
    inner = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80, dtype=np.int64)])
    return ends - begins - (inner[ends] - inner[begins])


def _transform(seed: int, percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, edges = utf8(batch.column("text"))
            bare = ~pc.match_substring_regex(pc.fill_null(batch.column("text"), ""), _HAS_MARK).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in chunks(edges):
                data, offsets = whole[edges[a] : edges[b]], edges[a : b + 1] - edges[a]
                drawn = draws(batch.column("doc_id").slice(a, b - a).to_pylist(), seed)
                ends, first = line_ends(data, offsets)
                lines = np.diff(first)
                picked = np.sort(drawn[:, :2] % (lines + 1)[:, None], axis=1)
                # Cut k of a row stands behind its k-th line; cut 0 where the row begins.
                padded = np.concatenate([ends, [0]])
                cuts = np.where(picked > 0, padded[np.where(picked > 0, first[:-1, None] + picked - 1, 0)], offsets[:-1, None])
                marked = (lines > 0) & bare[a:b] & (drawn[:, 2] % 100 < percent)
                forms = np.where(marked, np.where(drawn[:, 3] % 100 < spm_percent, 2, 1), 0)
                output, places = scatter(data, offsets, cuts, forms)
                plain = pa.array(forms == 0)
                sizes = [_characters(data, x, y) for x, y in ((offsets[:-1], cuts[:, 0]), (cuts[:, 0], cuts[:, 1]))]
                sizes = [pc.if_else(plain, pa.scalar(None, pa.int64()), pa.array(x, pa.int64())) for x in sizes]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(lines, pa.int64()), pa.array([FORMS[f] for f in forms.tolist()], pa.string()), *sizes, _strings(output, places)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def transform(documents: DataFrame, seed: int = SEED, percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars and output for each row of (doc_id, text)."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(_transform(seed, percent, spm_percent), schema)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole, edges = utf8(batch.column("output"))
        forms = pc.index_in(batch.column("form"), pa.array(FORMS)).to_numpy()
        for a, b in chunks(edges):
            data, places = gather(whole[edges[a] : edges[b]], edges[a : b + 1] - edges[a], forms[a:b])
            own = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*own.columns, _strings(data, places)], names=[*own.schema.names, "restored"])


def restore(transformed: DataFrame) -> DataFrame:
    """Adds ``restored``, the text rebuilt from ``output`` and ``form``."""
    small_batches(transformed.sparkSession)
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields]
    return transformed.mapInArrow(_restore, ", ".join([*columns, "restored string"]))


def digests(transformed: DataFrame) -> DataFrame:
    """The transformation with hashes of output and restored text in place of the texts."""
    return restore(transformed).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


def sql(seed: int = SEED, percent: int = PERCENT, spm_percent: int = SPM_PERCENT) -> str:
    """The same as SQL: lists of lines instead of bytes."""
    group = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::BIGINT"
    return f"""
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines,
                   sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        cut AS (
            SELECT *, len(lines) AS n, least({group(0)} % (len(lines) + 1), {group(1)} % (len(lines) + 1)) AS a,
                   greatest({group(0)} % (len(lines) + 1), {group(1)} % (len(lines) + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {group(2)} % 100 >= {percent} THEN 'plain'
                        WHEN {group(3)} % 100 < {spm_percent} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (
            SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix FROM cut)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                      ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256 FROM parts"""
