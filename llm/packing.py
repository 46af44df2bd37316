"""Best-fit packing of token pieces into sequences of fixed length.

Documents are encoded once; only documents longer than a sequence are cut, into full pieces with the remainder first. Full
pieces are sequences of their own. The others go through a bounded-space online best-fit: a fixed number of open
bins, a bitset of the free spaces that occur, so the tightest bin that still takes a piece is one shift and one lowest bit; when
all bins are open and none fits, the fullest closes.

Pieces are dealt to tasks by hash in tasks of about ``task_tokens``; a task's last open bins are the only loss against one long run. They
are packed once more across tasks, as wholes. Piece tables are written before packing, so a repeated task
sees the same rows in the same order.

Defined cases: a null or empty text is a piece of the end id alone; repeated rows and null ids are packed each for itself;
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from llm.text import giving_back, small_batches
from llm.tokens import CACHED_PARTS, END_ID, encoder, end_bytes, vocabulary_path
from shelfwise.session import materialize

LENGTH = 1024
OPEN_BINS = 256
TASK_TOKENS = 32 << 20
TASK_ROWS = 500_000
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class BestFit:
    """Bounded-space best-fit bins. ``add`` returns the bin's number and the offset in it."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.spaces = 0  # bit f: an open bin has f tokens free
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.spaces &= ~(1 << free)
        return number

    def add(self, size: int) -> tuple[int, int]:
        fitting = self.spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
            self.n_open -= 1
        else:
            if self.n_open >= self.open_bins:
                self._take((self.spaces & -self.spaces).bit_length() - 1)  # the fullest closes
                self.n_open -= 1
            number, free = self.n_bins, self.length
            self.n_bins += 1
        if free > size:
            self.by_free[free - size].append(number)
            self.spaces |= 1 << (free - size)
            self.n_open += 1
        return number, self.length - free

    def open_numbers(self) -> set[int]:
        return {x for bins in self.by_free for x in bins}


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be short."""
    first = n % length or min(n, length)
    return [(0, first)] + [(a, length) for a in range(first, n, length)]


def _cut(path: str, end_id: int, length: int, cached_parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(path, cached_parts), end_bytes(end_id)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for a, found in own.runs(batch.column("text")):
                rows = []
                for name, data in zip(names[a : a + len(found)], found):
                    data += end
                    for k, (start, size) in enumerate(cuts(len(data) // 4, length)):
                        rows.append((name, k, start, size, zlib.crc32(data[4 * start : 4 * (start + size)])))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])
        if cached_parts < CACHED_PARTS:  # asked for where memory is short: the parts go with the task
            own.forget()

    return giving_back(run)


def pieces(
    documents: DataFrame, length: int = LENGTH, vocabulary: str | None = None, end_id: int = END_ID, cached_parts: int = CACHED_PARTS
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of (doc_id, text). Fewer cached parts take less memory and more time."""
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(vocabulary or vocabulary_path(), end_id, length, cached_parts), _PIECES)


def _fit(length: int, open_bins: int, name: str = "bin"):
    """Adds the bin under a name, place and last (the bin was still open at the end) to rows with a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(length, open_bins), TaskContext.get().partitionId() << 36
        kept, numbers = [], []
        for batch in batches:
            placed = [bins.add(size) for size in batch.column("length").to_pylist()]
            numbers.append(placed)
            kept.append(batch)
        last = np.zeros(bins.n_bins, bool)
        last[list(bins.open_numbers())] = True
        for batch, placed in zip(kept, numbers):
            own = np.array([x for x, _ in placed], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own + base), pa.array([x for _, x in placed], pa.int64()), pa.array(last[own])],
                names=[*batch.schema.names, name, "place", "last"],
            )

    return giving_back(run)


def pack(found: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS, task_tokens: int = TASK_TOKENS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Adds sequence_id and offset to stored pieces."""
    full = F.col("length") == length
    short = found.where(~full)
    tokens, rows = short.agg(F.sum("length"), F.count("*")).first()
    tasks = max(1, -(-(tokens or 0) // task_tokens), -(-rows // task_rows))
    # By hash and then doc_id, so every task sees a mixture of all lengths in an order that a repeated task finds again.
    dealt = short.repartition(tasks, F.xxhash64("doc_id", "piece")).sortWithinPartitions(F.xxhash64("piece", "doc_id"), "doc_id", "piece", "ids_crc32")
    fitted = materialize(dealt.mapInArrow(_fit(length, open_bins), f"{_PIECES}, bin bigint, place bigint, last boolean"), "packed")
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    if tasks > 1:
        # What is left open at the end of each task: at most open_bins rows a task.
        rest = fitted.where("last").groupBy("bin").agg(F.sum("length").alias("length"))
        rest = rest.repartition(-(-tasks // 64), F.xxhash64("bin")).sortWithinPartitions("bin")
        moved = materialize(rest.mapInArrow(_fit(length, open_bins, "to"), "bin bigint, length bigint, to bigint, place bigint, last boolean"), "repacked")
        moved = moved.select("bin", "to", F.col("place").alias("base"))
        again = fitted.where("last").join(moved, "bin").select(*columns, (F.col("to") * 4 + 1).alias("sequence_id"), (F.col("base") + F.col("place")).alias("offset"))
        once = fitted.where("not last").select(*columns, (F.col("bin") * 4).alias("sequence_id"), F.col("place").alias("offset"))
        packed = once.union(again)
    else:
        packed = fitted.select(*columns, (F.col("bin") * 4).alias("sequence_id"), F.col("place").alias("offset"))
    own = found.where(full).select(*columns, (F.monotonically_increasing_id() * 4 + 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    return packed.union(own)


def pack_documents(documents: DataFrame, length: int = LENGTH, cached_parts: int = CACHED_PARTS) -> DataFrame:
    """All pieces of (doc_id, text) with their sequence and place in it."""
    return pack(materialize(pieces(documents, length, cached_parts=cached_parts), "pieces"), length)
