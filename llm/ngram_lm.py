"""Language-model scores by stupid backoff over word n-grams up to a given order.

    S(w | u v) = c(u v w) / c(u v)  where the n-gram occurs at least ``least`` times,
                 alpha * S(w | v)   elsewhere, and so on down to S(w) = c(w) / N.

A word with fewer words of its document before it starts at the order that these allow, so a document's first word has c(w) / N; a word
that is not scored at the order where it starts has backed off. A document's score is the mean of log10 S over its words (ASCII lower-cased, split at ASCII white space). Counts cover all
documents. All steps are joins on hash classes and blocks of documents:

1. Each task turns its documents into blocks: word hashes of a block as numbers into the block's own vocabulary.
2. Each block explodes to its different n-grams of each order with their counts in the block, dealt to classes by their
   hash. This is the map-side combine: a very common n-gram is one entry per block.
3. Per class, entries of all blocks are summed to the count table, and joined back: each block gets the counts of its
   own n-grams.
4. Per block, counts meet the words again and are summed per document.

So what moves is one entry per different n-gram of a block; the number of classes follows the number of words, so a class has bounded size.

Defined cases: a null or wordless text has no words, no score (null) and adds no counts; repeated rows count each; a null doc_id is
scored like any other; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from llm.text import BASE, chunks, lower_ascii, mix, small_batches, spaced_words, utf8, word_hashes, word_spans
from shelfwise.session import materialize

ALPHA = 0.4
LEAST = 2
ORDER = 2
BLOCK_WORDS = 1 << 20
CLASS_WORDS = 1 << 20
_LOWER, _WORDS = lower_ascii(), spaced_words()
_BLOCKS = "block bigint, n_words bigint, doc_ids array<bigint>, counts array<bigint>, words binary, vocabulary binary"


def _packed(number: np.ndarray) -> bytes:
    """Counts and numbers, mostly small: all lowest bytes first, then all next ones, compressed."""
    planes = np.ascontiguousarray(number.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1).astype(np.int64)


def _block_row(block: int, docs: list, counts: list[np.ndarray], hashes: list[np.ndarray]) -> pa.RecordBatch:
    vocabulary, number, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    # Frequent words get small numbers, so that the upper bytes of the numbers are nearly all zero.
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number, vocabulary = rank[number], vocabulary[order]
    sizes = np.concatenate(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()), pa.array([len(number)], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int64())),
            pa.array([_packed(number)], pa.binary()), pa.array([vocabulary.astype("<u8").tobytes()], pa.binary()),
        ],
        names=["block", "n_words", "doc_ids", "counts", "words", "vocabulary"],
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 32, 0
    docs, counts, hashes, waiting = [], [], [], 0
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        names = batch.column("doc_id").to_pylist()
        for a, b in chunks(offsets):
            starts, stops, rows = word_spans(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], _WORDS)
            hashes.append(word_hashes(_LOWER[data[offsets[a] : offsets[b]]], starts, stops))
            counts.append(np.bincount(rows, minlength=b - a))
            docs += names[a:b]
            waiting += len(starts)
            if waiting >= BLOCK_WORDS:
                yield _block_row(base + made, docs, counts, hashes)
                docs, counts, hashes, waiting, made = [], [], [], 0, made + 1
    if docs:
        yield _block_row(base + made, docs, counts, hashes)


def _unpacked(words: bytes, vocabulary: bytes, counts: list[int], order: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Word numbers, vocabulary hashes, and for each order from 2 the places where an n-gram of it ends, with its hash."""
    number, vocab = _numbers(words), np.frombuffer(vocabulary, "<u8")
    sizes = np.asarray(counts, np.int64)
    place = np.arange(len(number)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams, shorter = [], vocab[number]
    for length in range(2, order + 1):
        at = np.flatnonzero(place >= length - 1)
        hashes = mix(shorter[at - 1] * BASE + mix(vocab[number[at]]))
        shorter = np.zeros(len(number), np.uint64)
        shorter[at] = hashes
        grams.append((at, hashes))
    return number, vocab, grams


def _slices(hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(class, from, to) of sorted hashes; a class is the first ``bits`` bits."""
    classes = 1 << bits
    edges = np.searchsorted(hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64), np.arange(classes + 1, dtype=np.uint64))
    return [(c, int(edges[c]), int(edges[c + 1])) for c in range(classes) if edges[c] < edges[c + 1]]


def shortened(hashes: np.ndarray) -> bytes:
    """Sorted hashes as six-byte differences, or whole where one is too far from the next."""
    steps = np.diff(hashes)
    if len(steps) and int(steps.max()) >> 48:
        return b"\x08" + hashes.astype("<u8").tobytes()
    packed = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6] if len(steps) else np.zeros((0, 6), np.uint8)
    return b"\x06" + hashes[:1].astype("<u8").tobytes() + packed.tobytes()


def lengthened(data: bytes) -> np.ndarray:
    if data[0] == 8:
        return np.frombuffer(data, "<u8", offset=1)
    steps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, 6)
    wide = np.zeros((len(steps), 8), np.uint8)
    wide[:, :6] = steps
    out = np.empty(len(steps) + 1, np.uint64)
    out[0] = np.frombuffer(data, "<u8", 1, 1)[0]
    out[1:] = wide.view("<u8").reshape(-1)
    return np.cumsum(out, dtype=np.uint64)


def _entries(bits: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, vocabulary, counts, adds, asks in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "vocabulary", "counts", "adds", "asks"))):
                number, vocab, grams = _unpacked(words, vocabulary, counts, order)
                by_hash = np.argsort(vocab)
                single = vocab[by_hash], np.bincount(number, minlength=len(vocab))[by_hash]
                for length, (hashes, n) in enumerate(itertools.chain([single], (np.unique(x, return_counts=True) for _, x in grams)), 1):
                    n = n if adds else np.zeros(len(hashes), np.int64)
                    cut = _slices(hashes, bits)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([c for c, _, _ in cut], pa.int32()), pa.array([length] * len(cut), pa.int32()), pa.array([block] * len(cut), pa.int64()),
                            pa.array([asks] * len(cut), pa.bool_()), pa.array([shortened(hashes[i:j]) for _, i, j in cut], pa.binary()),
                            pa.array([_packed(n[i:j]) for _, i, j in cut], pa.binary()),
                        ],
                        names=["class", "order", "block", "asks", "hashes", "n"],
                    )

    return run


def _totals(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """The count table of one class and order, joined to the entries of the blocks that ask."""
    rows = table.to_pylist()
    hashes = [lengthened(r["hashes"]) for r in rows]
    _, number = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(number, np.concatenate([_numbers(r["n"]) for r in rows]))[number].astype(np.int64)
    edges = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
    out = [(r["block"], r["class"], r["order"], _packed(totals[edges[k] : edges[k + 1]])) for k, r in enumerate(rows) if r["asks"]]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["block", "class", "order", "totals"])


def scores(number: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]], one: np.ndarray, longer: list[np.ndarray], n_all: int, alpha: float, least: int):
    """log10 S of each word and whether it backed off, from totals of the vocabulary and of the different n-grams of each longer order."""
    before = one[number].astype(np.float64)
    value = np.log10(np.maximum(before, 1) / max(n_all, 1))  # of a corpus that lacks the word: as if it had it once
    backed = np.zeros(len(number), bool)
    for (at, hashes), totals in zip(grams, longer):
        if not len(at):
            break
        _, place = np.unique(hashes, return_inverse=True)
        whole = totals[place].astype(np.float64)
        seen = whole >= least
        value[at] = np.where(seen, np.log10(np.maximum(whole, 1) / np.maximum(before[at - 1], 1)), np.log10(alpha) + value[at])
        backed[at] = ~seen
        before = np.zeros(len(number))
        before[at] = whole
    return value, backed


def _documents(n_all: int, alpha: float, least: int, order: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.to_pylist()
        out = {"doc_id": [], "n_words": [], "n_backoff": [], "total": []}
        for r in rows:
            number, vocab, grams = _unpacked(r["words"], r["vocabulary"], r["counts"], order)
            found = sorted(right.to_pylist(), key=lambda x: (x["order"], x["class"]))
            by_hash, *longer = (
                np.concatenate([np.zeros(0, np.int64), *(_numbers(x["totals"]) for x in found if x["order"] == k)]) for k in range(1, order + 1)
            )
            one = np.empty(len(vocab), np.int64)
            one[np.argsort(vocab)] = by_hash
            value, backed = scores(number, grams, one, longer, n_all, alpha, least)
            sizes = np.asarray(r["counts"], np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            out["doc_id"] += r["doc_ids"]
            out["n_words"] += r["counts"]
            out["n_backoff"] += np.bincount(row[backed], minlength=len(sizes)).tolist()
            out["total"] += np.bincount(row, value, len(sizes)).tolist()
        kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_backoff": pa.int64(), "total": pa.float64()}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})

    return run


def _as_blocks(documents: DataFrame) -> DataFrame:
    small_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(_blocks, _BLOCKS), "word-blocks")


def score(documents: DataFrame, corpus: DataFrame | None = None, alpha: float = ALPHA, least: int = LEAST, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_backoff, score of (doc_id, text), with counts of ``corpus`` or, if None, of the documents themselves."""
    blocks = _as_blocks(documents)
    counted = blocks.withColumns({"adds": F.lit(corpus is None), "asks": F.lit(True)})
    source = blocks
    if corpus is not None:
        source = _as_blocks(corpus).withColumn("block", -1 - F.col("block"))
        counted = counted.union(source.withColumns({"adds": F.lit(True), "asks": F.lit(False)}))
    n_all = source.agg(F.sum("n_words")).first()[0] or 0
    bits = max(0, int(n_all // CLASS_WORDS).bit_length())
    entries = counted.mapInArrow(_entries(bits, order), "class int, order int, block bigint, asks boolean, hashes binary, n binary")
    totals = entries.groupBy("class", "order").applyInArrow(_totals, "block bigint, class int, order int, totals binary")
    found = blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _documents(n_all, alpha, least, order), "doc_id bigint, n_words bigint, n_backoff bigint, total double"
    )
    return found.select("doc_id", "n_words", "n_backoff", F.when(F.col("n_words") > 0, F.round(F.col("total") / F.col("n_words"), 6)).alias("score"))


def sql() -> str:
    """The same as SQL."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        words AS (SELECT r, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM docs),
        pairs AS (SELECT r, k, word, lag(word) OVER (PARTITION BY r ORDER BY k) AS before FROM words),
        one AS (SELECT word, count(*) AS n FROM words GROUP BY word),
        two AS (SELECT before, word, count(*) AS n FROM pairs WHERE before IS NOT NULL GROUP BY before, word),
        n_all AS (SELECT count(*) AS n FROM words),
        valued AS (
            SELECT p.r, CASE WHEN p.before IS NULL THEN log10(o.n / a.n) WHEN t.n >= {LEAST} THEN log10(t.n / b.n)
                        ELSE log10({ALPHA}::DOUBLE) + log10(o.n / a.n) END AS v,
                   (p.before IS NOT NULL AND t.n < {LEAST})::INT AS backed
            FROM pairs p JOIN one o ON p.word = o.word LEFT JOIN one b ON p.before = b.word
                 LEFT JOIN two t ON p.before = t.before AND p.word = t.word CROSS JOIN n_all a),
        summed AS (SELECT r, sum(v) AS total, sum(backed)::BIGINT AS n_backoff FROM valued GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff,
               CASE WHEN len(w) > 0 THEN round(total / len(w), 6) END AS score
        FROM docs LEFT JOIN summed USING (r)"""


def sql_of_order(order: int) -> str:
    """The same as SQL for n-grams up to any order: w0 is the word, w1 the one before it, and so on; gK counts, sK scores by order K."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    before = [f"w{j}" for j in range(1, order)]
    steps = []
    for n in range(1, order + 1):
        own = ", ".join(f"w{j}" for j in range(n))
        steps.append(f"g{n} AS (SELECT {own}, count(*) AS n FROM placed WHERE w{n - 1} IS NOT NULL GROUP BY {own})")
    kept = ", ".join(f"p.{c}" for c in ["r", "w0", *before])
    steps.append(f"s1 AS (SELECT {kept}, log10(t.n / a.n) AS v, 0 AS backed FROM placed p JOIN g1 t ON p.w0 = t.w0 CROSS JOIN n_all a)")
    for n in range(2, order + 1):
        same = " AND ".join(f"p.w{j} = t.w{j}" for j in range(n))
        context = " AND ".join(f"p.w{j + 1} = b.w{j}" for j in range(n - 1))
        steps.append(f"""s{n} AS (
            SELECT {kept}, CASE WHEN p.w{n - 1} IS NULL THEN p.v WHEN t.n >= {LEAST} THEN log10(t.n / b.n) ELSE log10({ALPHA}::DOUBLE) + p.v END AS v,
                   CASE WHEN p.w{n - 1} IS NULL THEN p.backed ELSE (t.n < {LEAST})::INT END AS backed
            FROM s{n - 1} p LEFT JOIN g{n} t ON {same} LEFT JOIN g{n - 1} b ON {context})""")
    lags = "".join(f", lag(word, {j}) OVER (PARTITION BY r ORDER BY k) AS w{j}" for j in range(1, order))
    chain = ",\n        ".join(steps)
    return f"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        words AS (SELECT r, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM docs),
        placed AS (SELECT r, word AS w0{lags} FROM words),
        n_all AS (SELECT count(*) AS n FROM words),
        {chain},
        summed AS (SELECT r, sum(v) AS total, sum(backed)::BIGINT AS n_backoff FROM s{order} GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_backoff, 0)::BIGINT AS n_backoff,
               CASE WHEN len(w) > 0 THEN round(total / len(w), 6) END AS score
        FROM docs LEFT JOIN summed USING (r)"""
