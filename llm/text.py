"""Byte-level views of Arrow text columns, so that whole batches are read without a Python loop over words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 20
BATCH_BYTES = "8m"


def small_batches(spark) -> None:
    """Arrow batches of whole texts stay small: a batch stands in the JVM and in Python, coming and going, for each core.

    One longer text is still one batch.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def give_back() -> None:
    """Returns freed memory to the system: allocators keep it, and Spark's reused workers would hold the peak of every stage before."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function of a task for ``mapInArrow``, which gives back freed memory at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z and keeps every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def spaced_words() -> np.ndarray:
    """Bytes of words that end at ASCII white space (space and 0x09-0x0D)."""
    keep = np.ones(256, dtype=bool)
    keep[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return keep


def alnum_words() -> np.ndarray:
    """Bytes of words made of ASCII letters, digits and everything beyond ASCII."""
    keep = np.zeros(256, dtype=bool)
    keep[0x30:0x3A] = keep[0x41:0x5B] = keep[0x61:0x7B] = keep[0x80:] = True
    return keep


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n+1 offsets of its rows; a null is an empty text."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A field of the struct column ``row``, which carries whole rows past name clashes."""
    return pc.struct_field(batch.column("row"), name)


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` bytes; a longer text is a run of its own, never cut."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: each input bit changes half of the output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_spans(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word; words never cross rows."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = keep[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edges = offsets[:-1][(offsets[:-1] < len(data)) & (np.diff(offsets) > 0)]
    begins[edges] |= inside[1:-1][edges]
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    ends[lasts] |= inside[1:-1][lasts]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, over the word's bytes alone."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = stops - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = BYTE_VALUES[data[np.repeat(starts, lengths) + place]] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths))


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and their rows; fewer words are one shingle, no word none."""
    counts = np.bincount(rows, minlength=n_rows)
    firsts = np.cumsum(counts) - counts
    place = np.arange(len(rows)) - firsts[rows]
    made = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    first = place < made[rows]
    at = np.flatnonzero(first)
    width = np.minimum(counts, size)[rows[at]]
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        take = k < width
        out[take] = mix(out[take] * BASE + hashes[at[take] + k] + np.uint64(k + 1))
    return out, rows[at]


def distinct_by_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, rows ascending."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]
