"""Token files: ids of all documents in ascending doc_id order, as Simple-8b blocks.

The file format is Parquet of blocks, one file per range of ids. A block holds whole documents up to about ``block_ids`` ids: their
doc_ids, their numbers of ids (so offsets inside the block are a running sum) and the packed words. Columns ``file`` and
``block`` give the order. Reading decodes a block at once; ``start`` comes from the blocks' totals, one row per block.

Defined cases: a null text is empty and holds only the end id; null doc_ids come first, ties of doc_id are ordered by text (null first); repeated
rows are written each; empty tables give empty files; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from llm import simple8b
from llm.text import small_batches
from llm.tokens import END_ID, encoder, end_bytes, vocabulary_path
from shelfwise.session import stage_dir

BLOCK_IDS = 1 << 16
_BLOCKS = "file int, block int, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, words binary"


def _encode(path: str, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, file, end = encoder(path), TaskContext.get().partitionId(), end_bytes(end_id)
        ids, docs, counts, block = [], [], [], 0

        def flush() -> pa.RecordBatch:
            words = simple8b.encode(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()), pa.array([block], pa.int32()), pa.array([sum(counts)], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int64())), pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ],
                names=["file", "block", "n_ids", "doc_ids", "counts", "words"],
            )

        waiting = 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for a, found in own.runs(batch.column("text")):
                for name, data in zip(names[a : a + len(found)], found):
                    ids.append(data + end)
                    docs.append(name)
                    counts.append(len(data) // 4 + 1)
                    waiting += counts[-1]
                    if waiting >= block_ids:
                        yield flush()
                        ids, docs, counts, waiting, block = [], [], [], 0, block + 1
        if docs:
            yield flush()

    return run


def write(documents: DataFrame, path: str | None = None, vocabulary: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> str:
    """Writes the token files of (doc_id, text) and returns their folder."""
    small_batches(documents.sparkSession)
    path = path or f"{stage_dir(documents.sparkSession)}/tokens-{uuid.uuid4().hex}"
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encode(vocabulary or vocabulary_path(), end_id, block_ids), _BLOCKS).write.option("compression", "zstd").parquet(path)
    return path


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, block, docs, counts, words in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "doc_ids", "counts", "words"))):
            ids = simple8b.decode(np.frombuffer(words, "<u8")).astype("<u4").tobytes()
            ends = np.cumsum(counts)
            within = ends - counts
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(within.tolist(), ends.tolist())]
            n = len(docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int32()), pa.array([block] * n, pa.int32()), pa.array(docs, pa.int64()), pa.array(within), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                names=["file", "block", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and all its ids, as read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, counts, words in zip(*(batch.column(c).to_pylist() for c in ("doc_ids", "counts", "words"))):
                ids = simple8b.decode(np.frombuffer(words, "<u8")).astype(np.int32)
                edges = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(edges, pa.array(ids))], names=["doc_id", "ids"])

    return spark.read.schema(_BLOCKS).parquet(path).mapInArrow(run, "doc_id bigint, ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files."""
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    sizes = blocks.select("file", "block", "n_ids")
    # One row per file, then one per block of a file: both are far fewer than documents, and no window holds documents.
    files = sizes.groupBy("file").agg(F.sum("n_ids").alias("n"))
    files = files.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before_file"))
    before = F.sum("n_ids").over(Window.partitionBy("file").orderBy("block")) - F.col("n_ids")
    starts = sizes.select("file", "block", before.alias("before_block")).join(files, "file").select("file", "block", (F.col("before_block") + F.col("before_file")).alias("before"))
    found = blocks.mapInArrow(_decode, "file int, block int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint")
    return found.join(starts, ["file", "block"]).select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
