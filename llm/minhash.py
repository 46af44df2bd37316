"""MinHash near-dedup with SuperMinHash signatures.

A document's set holds its distinct shingles of consecutive words (ASCII lower-cased, split at ASCII white space).

1. One Arrow pass computes size, set digest and signature bands of every document. SuperMinHash lets each element draw a
   random permutation of the places, so the ranks of one element are correlated and every place gets an element early; a document
   stops as soon as no later draw can lower any place. Bands come from the threshold: rows per band are fixed, and as
   many bands are used as make a missed link at the threshold rarer than ``miss``.
2. Documents with equal sets are one node (the smallest doc_id). Nodes that share a band are a bucket. Each member is compared on
   full sets with its bucket's hub: the member that shares most buckets with others. This is linear in the group, however large.
3. What stars cannot decide stays open: groups of three or more in which the hubs left several components. There every node
   outside the main component is compared with all nodes of its group, in blocks of bounded size, on full sets through
   an inverted index of rare shingles. No pair is skipped and no pair table is written.
4. Verified links are united (``components``).

Defined cases: a document without words (or null) has an empty set and is linked with nothing; fewer words than a shingle
needs are one shingle; a null doc_id is linked with nothing and is its own (null) component, kept; rows that share a doc_id count as
one document and are linked where any of their texts is; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from llm.components import components
from llm.text import chunks, distinct_by_row, give_back, giving_back, lower_ascii, mix, shingles, small_batches, spaced_words, utf8, word_hashes, word_spans
from shelfwise.session import materialize

ROWS_PER_BAND = 5
MISS = 1e-7
BLOCK_SHINGLES = 2_000_000
LARGE_BLOCK = 200_000  # shingles: its memory is worth giving back at once
MOST_BROADCAST = 1 << 21  # ids: 16 MB
MOST_BITS = 1 << 29  # of the candidates' bitmap: 64 MB
BITMAP_SLICES = 64
_LOWER, _WORDS = lower_ascii(), spaced_words()
_LOW40 = np.uint64((1 << 40) - 1)
_EMPTY = np.uint64((1 << 64) - 1)


def n_bands(percent: int, rows: int = ROWS_PER_BAND, miss: float = MISS) -> int:
    """Bands that let a pair of this similarity share none with at most this probability."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _draw(elements: np.ndarray, step: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """Each element's place to swap with (step or later) and its rank, of 40 random bits, above ``step`` whole ranks."""
    x = mix(elements + np.uint64((step + 1) * 0xD1342543DE82EF95 & ((1 << 64) - 1)))
    swap = step + ((x >> np.uint64(40)) * np.uint64(places - step) >> np.uint64(24)).astype(np.int64)
    return swap, (x & _LOW40) | np.uint64(step << 40)


def superminhash(elements: np.ndarray, rows: np.ndarray, n_rows: int, places: int) -> np.ndarray:
    """n_rows x places signatures; rows ascending, a row without elements keeps the largest value everywhere."""
    out = np.full((n_rows, places), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    swap, rank = _draw(elements, 0, places)
    np.minimum.at(flat, rows * places + swap, rank)
    order = None
    for step in range(1, places):
        # A later draw is at least `step`: rows whose places are all below it are finished.
        live = out.max(axis=1) >= np.uint64(step << 40)
        if order is None:
            use = live[rows]
            elements, rows = elements[use], rows[use]
            order = np.tile(np.arange(places, dtype=np.uint16), (len(elements), 1))
            order[np.arange(len(elements)), swap[use]] = 0
            order[:, 0] = swap[use]
        elif step % 8 == 0:
            use = live[rows]
            if len(use) and use.mean() < 0.7:
                elements, rows, order = elements[use], rows[use], order[use]
        if not len(elements):
            break
        swap, rank = _draw(elements, step, places)
        each = np.arange(len(elements))
        place = order[each, swap].astype(np.int64)
        order[each, swap] = order[:, step]
        np.minimum.at(flat, rows * places + place, rank)
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """n x bands keys, each a hash of the band's number and its places."""
    rows = signatures.shape[1] // bands
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands)).copy()
    parts = signatures[:, : bands * rows].reshape(len(signatures), bands, rows)
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return keys


def document_shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their rows."""
    starts, stops, rows = word_spans(data, offsets, _WORDS)
    hashes = word_hashes(_LOWER[data], starts, stops)
    return distinct_by_row(*shingles(hashes, rows, len(offsets) - 1, size))


def _fingerprints(size: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in chunks(offsets, 1 << 19):
                values, rows = document_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                counts = np.bincount(rows, minlength=b - a)
                edges = np.concatenate([[0], np.cumsum(counts)])
                keys = band_keys(superminhash(values, rows, b - a, bands * ROWS_PER_BAND), bands).astype(np.int64)
                digest = [xxhash.xxh3_128_digest(values[i:j].tobytes()) for i, j in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), pa.array(digest, pa.binary()),
                        pa.ListArray.from_arrays(np.arange(0, (b - a + 1) * bands, bands, dtype=np.int32), pa.array(keys.reshape(-1))),
                    ],
                    names=["doc_id", "n_shingles", "digest", "bands"],
                )

    return giving_back(run)


def _slice_bits(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One slice of the bitmap: the places of a slice are distinct and fewer than its bits."""
    places, bits = table.column("place").to_numpy(), table.column("bits")[0].as_py()
    own = np.zeros(max(bits // BITMAP_SLICES, 8), bool)
    own[places % len(own)] = True
    return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([np.packbits(own).tobytes()], pa.binary())})


def bitmap(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """Packed bits at the hashes of the nodes, and the number of bits: about 16 a node, MOST_BITS at most.

    With more nodes than that more other documents pass it too, which costs time and never a result.
    """
    bits = min(MOST_BITS, 1 << max(16, (16 * nodes.count()).bit_length()))
    places = nodes.select(F.pmod(F.xxhash64("node"), F.lit(bits)).alias("place"), F.lit(bits).alias("bits")).distinct()
    slices = places.groupBy(F.floor(F.col("place") / (bits // BITMAP_SLICES)).cast("int").alias("slice")).applyInArrow(_slice_bits, "slice int, data binary")
    packed = np.zeros((BITMAP_SLICES, bits // BITMAP_SLICES // 8), np.uint8)
    for r in slices.collect():  # MOST_BITS / 8 bytes at most
        packed[r.slice] = np.frombuffer(r.data, np.uint8)
    return packed.reshape(-1), bits


def _sets(size: int, shared):
    """Sets of the documents whose place in the bitmap is taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((shared.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1))
            data, offsets = utf8(batch.column("text"))
            for a, b in chunks(offsets):
                values, rows = document_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                edges = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=b - a))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(edges, pa.array(values.astype(np.int64)))],
                    names=["node", "shingles"],
                )

    return giving_back(run)


def _similar(common, n_a, n_b, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def block_links(sets: list[np.ndarray], labels: np.ndarray, is_query: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between queries and all sets of a block that unite labels not united yet, as positions.

    Shingles are numbered by how many sets hold them. Two similar sets share one of their rarest shingles (the prefix that
    the threshold leaves), so an index of prefixes finds every candidate; candidates are counted on the full sets.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    # The block's largest arrays: sorted in place, of 32 bits where that will do.
    low, shift = np.uint64((1 << 32) - 1), np.uint64(32)
    values = np.concatenate(sets)
    values.sort()
    firsts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    held, values = np.diff(firsts, append=len(values)), values[firsts]
    rank = np.empty(len(held), np.uint32)
    rank[np.argsort(held, kind="stable")] = np.arange(len(held), dtype=np.uint32)
    tokens = np.empty(int(edges[-1]), np.uint32)
    for k, own in enumerate(sets):
        tokens[edges[k] : edges[k + 1]] = np.sort(rank[np.searchsorted(values, own)])
    del values, firsts, rank
    prefix = sizes - (percent * sizes + 99) // 100 + 1

    def index(lengths):
        """Owners of the first tokens of each set, by token, and where each token's owners begin."""
        keys, at = np.empty(int(lengths.sum()), np.uint64), 0
        for k, n in enumerate(lengths.tolist()):
            keys[at : at + n] = (tokens[edges[k] : edges[k] + n].astype(np.uint64) << shift) | np.uint64(k)
            at += n
        keys.sort()
        starts = np.searchsorted(keys, np.arange(len(held) + 1, dtype=np.uint64) << shift)
        return (keys & low).astype(np.int32), starts

    rare, rare_at = index(np.minimum(prefix, sizes))
    full, full_at = index(sizes)
    root = {int(x): int(x) for x in set(labels.tolist())}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for q in np.flatnonzero(is_query).tolist():
        own = tokens[edges[q] : edges[q + 1]]
        near = [rare[rare_at[t] : rare_at[t + 1]] for t in own[: prefix[q]].tolist()]
        if not near:
            continue
        near = np.unique(np.concatenate(near))
        near = near[(100 * sizes[near] >= percent * sizes[q]) & (100 * sizes[q] >= percent * sizes[near]) & (labels[near] != labels[q])]
        if not len(near):
            continue
        common = np.bincount(np.concatenate([full[full_at[t] : full_at[t + 1]] for t in own.tolist()]), minlength=len(sets))
        for hit in near[_similar(common[near], sizes[q], sizes[near], percent)].tolist():
            a, b = find(int(labels[q])), find(int(labels[hit]))
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((q, hit))
    return found


def _resolve(percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        nodes, labels = table.column("node").to_numpy(), table.column("label").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        column = table.column("shingles").chunk(0) if table.num_rows else None
        if column is None or not asks.any():
            links = []
        else:
            at, values = column.offsets.to_numpy(), column.values.to_numpy()
            links = block_links([values[i:j] for i, j in zip(at[:-1], at[1:])], labels, asks, percent)
            if len(values) >= LARGE_BLOCK:
                give_back()
        a, b = ([int(nodes[x[k]]) for x in links] for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (node, hub) whose full sets are similar enough."""
    own = sets.select("node", F.col("shingles").alias("own"))
    hubs = sets.select(F.col("node").alias("hub"), F.col("shingles").alias("other"))
    common = F.size(F.array_intersect("own", "other"))
    joined = pairs.join(own, "node").join(hubs, "hub")
    return joined.where(_similar(common, F.size("own"), F.size("other"), percent)).select(F.col("node").alias("a"), F.col("hub").alias("b"))


def _open_blocks(pairs: DataFrame, labels: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Nodes of undecided groups, dealt to blocks: every asking node meets every node of its group in exactly one block."""
    groups = components(pairs.select("node", "hub"))
    members = materialize(
        groups.join(labels, "node", "left").select(F.col("component").alias("grp"), "node", F.coalesce("label", "node").alias("label"))
        .join(sets, "node").withColumn("weight", F.size("shingles").cast("bigint")),
        "group-members",
    )
    by_label = members.groupBy("grp", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    state = by_label.groupBy("grp").agg(
        F.count("*").alias("labels"), F.sum("n").alias("n"), F.sum("weight").alias("weight"),
        F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.max_by("weight", F.struct("n", -F.col("label"))).alias("main_weight"),
    ).where("labels > 1 and n > 2")
    state = state.select(
        "grp", "main", F.ceil(F.col("weight") / block).cast("int").alias("nt"), F.ceil((F.col("weight") - F.col("main_weight")) / block).cast("int").alias("nq")
    )
    rows = members.join(state, "grp")
    cell = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    targets = rows.select("grp", "node", "label", "shingles", F.lit(False).alias("asks"), cell(F.col("nt"), 1).alias("t"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("q"))
    asking = rows.where("label <> main").select("grp", "node", "label", "shingles", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("t"), cell(F.col("nq"), 2).alias("q"))
    return targets.unionByName(asking)


def _candidate_sets(source: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Full sets of the wanted nodes. Texts are read once more but never shuffled: a bitmap of bounded size leaves the
    wanted documents and a few others, whose sets then meet the exact list."""
    packed, bits = bitmap(wanted)
    shared = source.sparkSession.sparkContext.broadcast(packed)
    placed = source.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("place"))
    found = placed.mapInArrow(_sets(size, shared), "node bigint, shingles array<bigint>").where(F.size("shingles") > 0)
    return materialize(found.join(wanted, "node", "left_semi"), "candidate-sets")


def near_duplicates(documents: DataFrame, percent: int = 80, size: int = 5, block: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of (doc_id, text); similarity in whole percent."""
    bands = n_bands(percent)
    small_batches(documents.sparkSession)
    source = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = materialize(
        source.mapInArrow(_fingerprints(size, bands), "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"), "signatures"
    )
    usable = rows.where("doc_id is not null and n_shingles > 0")
    different = materialize(usable.groupBy("digest").agg(F.min("doc_id").alias("node"), F.any_value("bands").alias("bands")), "sets")
    same_id = usable.select(F.col("doc_id").alias("a"), "digest").join(different.select("digest", F.col("node").alias("b")), "digest").where("a <> b").select("a", "b")
    member = different.select("node", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    member = materialize(member.join(shared, "bucket"), "buckets")
    central = member.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = member.join(central, "node").groupBy("bucket").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub"))
    pairs = materialize(member.join(hubs, "bucket").where("node <> hub").select("node", "hub").distinct(), "pairs")
    wanted = materialize(pairs.select("node").union(pairs.select(F.col("hub").alias("node"))).distinct(), "wanted")
    sets = _candidate_sets(source, wanted, size)
    stars = materialize(_star_links(pairs, sets, percent), "star-links")
    labels = materialize(components(stars).select("node", F.col("component").alias("label")), "star-labels")
    blocks = _open_blocks(pairs, labels, sets, block)
    rest = blocks.groupBy("grp", "q", "t").applyInArrow(_resolve(percent), "a bigint, b bigint")
    united = components(stars.union(rest).union(same_id))
    return (
        rows.select("doc_id", "n_shingles")
        .join(united, F.col("doc_id") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _held(key: str, shared):
    """Rows whose place in the bitmap is taken, or the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.column("place").to_numpy()
            taken = (shared.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(taken)], names=["row", key])

    return giving_back(run)


def without(documents: DataFrame, gone: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The rows, with all their columns, whose doc_id is not in ``gone`` (node); rows without a doc_id stay.

    Texts are not shuffled. Up to ``most_broadcast`` ids (eight bytes each) are broadcast; beyond that a bitmap of bounded size shows
    most rows to be none of them, and the ids (not the texts) of the others meet the exact list.
    """
    spark = documents.sparkSession
    if gone.count() <= most_broadcast:
        return documents.join(F.broadcast(gone.select(F.col("node").alias("__gone"))), F.col("doc_id") == F.col("__gone"), "left_anti")
    packed, bits = bitmap(gone)
    shared = spark.sparkContext.broadcast(packed)
    place = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(bits)), F.lit(0))
    rows = documents.select(F.struct(*documents.columns).alias("row"), place.alias("place"))
    small_batches(spark)
    marked = rows.mapInArrow(_held("taken", shared), f"row {documents.schema.simpleString()}, taken boolean")
    surely = marked.where(~F.col("taken")).select("row.*")
    asked = marked.where("taken").select("row.*")
    return surely.union(asked.join(gone.select(F.col("node").alias("__gone")), F.col("doc_id") == F.col("__gone"), "left_anti"))


def one_row_each(documents: DataFrame, repeated: DataFrame) -> DataFrame:
    """Of the rows of a repeated doc_id (node) one stays: the least by a hash of the whole row. Only rows of these ids move."""
    rows = without(documents, repeated)
    ids = repeated.select(F.col("node").alias("__again"))
    again = documents.join(F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids, F.col("doc_id") == F.col("__again"), "left_semi")
    columns = [F.col(c) for c in documents.columns]
    first = again.groupBy("doc_id").agg(F.min_by(F.struct(*columns), F.struct(F.xxhash64(*columns), F.length("text"))).alias("row"))
    return rows.union(first.select("row.*"))


def distinct_documents(documents: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The rows, with all their columns, of documents that are the smallest of their group; see ``near_duplicates``.

    Rows that share a doc_id are one document, of which one row stays, chosen by a fixed order; rows without an id all stay.
    """
    found = materialize(near_duplicates(documents, percent, size), "near-duplicates").where("doc_id is not null")
    gone = materialize(found.where("not kept").select(F.col("doc_id").alias("node")).distinct(), "gone")
    out = without(documents, gone)
    repeated = materialize(found.where("kept").groupBy(F.col("doc_id").alias("node")).agg(F.count("*").alias("n")).where("n > 1").select("node"), "repeated")
    return one_row_each(out, repeated) if repeated.limit(1).count() else out
