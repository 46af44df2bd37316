"""Prefix trie of conversations: z-fast tries per shard, their nodes united by Spark.

A node is a distinct sequence of first turns. It is named by its depth and a 128-bit sum over its turns, each hashed with its place;
so every prefix of a conversation has a name, and names of prefixes are running sums.

1. Turns become (hashes, words); texts are not moved. A range-partitioned running number orders them within conversations, however many
   turns one has. Long conversations are cut into bands of ``band`` turns; a band knows the name of the node it hangs on.
2. Bands are dealt to shards by hash. In a shard a z-fast trie holds compacted nodes (an edge of many turns is one node, its extent the deeper end) under the
   handle, the name at the two-fattest depth of its edge. Conversations come in batches: one fat binary search (a round halves the
   open depths of the whole batch) finds each one's exit node, then they are inserted; a conversation whose exit node was
   changed by one before it in its batch is searched again. At last edges are expanded into nodes of every depth.
3. Nodes of equal name are united: members add up, the smallest member owns the node. A shard has each node once, so no name has
   more rows than there are shards, however many conversations share it.
4. Sums over subtrees need each node counted once in the whole: it counts in the shard that holds its owner's band, and for the part of a
   conversation below a band, at the band's last node. Shards add up their part of the trie from the leaves, and nodes add up shards.
5. Members that end in a node are listed in order as pieces of text made by many tasks, which one hash per node reads in turn.

Defined cases: rows without conv_id are left out; null role or text is empty; turns come by number (null first), then by the hash of role and text; repeated rows
are turns each; a conversation whose turns were all cut off ends in the root; an empty table has no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.ordering import running_total
from shelfwise.session import materialize

STEP = 20
MOST_HEAD = 4
BAND = 1 << 16
SHARD_TURNS = 100_000
BATCH = 2_048
PIECE = 1 << 20
WORDS = r"[^\x20\x09-\x0D]+"
_NODE, _END = 0, 1
_KEY = ["p1", "p2", "depth"]
_LOCAL = "kind int, shard int, depth bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, first bigint, n bigint, words bigint, top boolean"


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that a higher power of two divides than any other."""
    return high & -1 << (low ^ high).bit_length() - 1


class ZFastTrie:
    """Compacted trie of paths, whose prefixes have names: name(path, depth) = names[start[path] + depth - top[path]].

    A node's edge covers the depths (low, extent]. ``handles`` has the nodes by their names at the two-fattest depth of the edge, ``firsts`` by the first
    name of the edge, ``roots`` the ends without an edge that paths hang on.
    """

    def __init__(self, names: list[bytes], start: list[int], top: list[int], last: list[int]):
        self.names, self.start, self.top, self.last = names, start, top, last
        self.low: list[int] = []
        self.extent: list[int] = []
        self.path: list[int] = []
        self.parent: list[int] = []
        self.members: dict[int, list[int]] = {}  # paths that end in a node
        self.handles: dict[bytes, int] = {}
        self.firsts: dict[bytes, int] = {}
        self.roots: dict[bytes, int] = {}

    def name(self, path: int, depth: int) -> bytes:
        return self.names[self.start[path] + depth - self.top[path]]

    def _add(self, low: int, extent: int, path: int, parent: int) -> int:
        for column, value in ((self.low, low), (self.extent, extent), (self.path, path), (self.parent, parent)):
            column.append(value)
        return len(self.low) - 1

    def root(self, path: int) -> int:
        name = self.name(path, self.top[path])
        if name not in self.roots:
            self.roots[name] = self._add(self.top[path], self.top[path], path, -1)
        return self.roots[name]

    def _common(self, path: int, node: int, known: int) -> int:
        """Depth down to which a path follows a node's edge; it does down to ``known``."""
        low, high, other = known, min(self.extent[node], self.last[path]), self.path[node]
        while low < high:
            middle = (low + high + 1) // 2
            if self.name(path, middle) == self.name(other, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def _whole(self, path: int, node: int) -> bool:
        """Whether a path follows a node's edge to its end."""
        extent = self.extent[node]
        return extent <= self.last[path] and self.name(path, extent) == self.name(self.path[node], extent)

    def _exit(self, path: int, node: int) -> tuple[int, int]:
        """Exit node and depth below the deepest node that a path follows to its end."""
        extent = self.extent[node]
        below = self.firsts.get(self.name(path, extent + 1)) if extent < self.last[path] else None
        return (node, extent) if below is None else (below, self._common(path, below, extent + 1))

    def locate(self, path: int, node: int) -> tuple[int, int]:
        """Exit node of a path and the depth at which it leaves it, by fat binary search below a node that it follows."""
        low, high = self.extent[node], self.last[path]
        while low < high:
            fat = two_fattest(low, high)
            found = self.handles.get(self.name(path, fat))
            if found is None:
                high = fat - 1
            elif self._whole(path, found):
                node, low = found, self.extent[found]
            else:
                return found, self._common(path, found, fat)
        return self._exit(path, node)

    def locate_batch(self, paths: list[int]) -> tuple[list[tuple[int, int]], list[int]]:
        """Exits of many paths, one round of the fat binary search for all at a time, and the deepest nodes that they follow."""
        nodes = [self.root(p) for p in paths]
        low = np.array([self.extent[n] for n in nodes], np.int64)
        high = np.array([self.last[p] for p in paths], np.int64)
        exits: list[tuple[int, int] | None] = [None] * len(paths)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            differing = low[open_] ^ high[open_]
            fat = high[open_] >> (bits := np.frexp(differing.astype(np.float64))[1] - 1) << bits
            for i, f in zip(open_.tolist(), fat.tolist()):
                found = self.handles.get(self.name(paths[i], f))
                if found is None:
                    high[i] = f - 1
                elif self._whole(paths[i], found):
                    nodes[i], low[i] = found, self.extent[found]
                else:
                    exits[i], high[i] = (found, self._common(paths[i], found, f)), low[i]
            open_ = open_[low[open_] < high[open_]]
        return [e or self._exit(p, n) for e, p, n in zip(exits, paths, nodes)], nodes

    def _split(self, node: int, depth: int) -> int:
        """Cuts a node's edge; the upper part is a new node."""
        low, extent, path = self.low[node], self.extent[node], self.path[node]
        upper = self._add(low, depth, path, self.parent[node])
        handle = two_fattest(low, extent)
        if handle <= depth:
            self.handles[self.name(path, handle)] = upper
            self.handles[self.name(path, two_fattest(depth, extent))] = node
        else:
            self.handles[self.name(path, two_fattest(low, depth))] = upper
        self.firsts[self.name(path, low + 1)] = upper
        self.firsts[self.name(path, depth + 1)] = node
        self.low[node], self.parent[node] = depth, upper
        return upper

    def _insert(self, path: int, node: int, depth: int) -> None:
        if depth < self.extent[node]:
            node = self._split(node, depth)
        last = self.last[path]
        if depth < last:
            node = self._add(depth, last, path, node)
            self.handles[self.name(path, two_fattest(depth, last))] = node
            self.firsts[self.name(path, depth + 1)] = node
        self.members.setdefault(node, []).append(path)

    def insert_batch(self, paths: list[int]) -> None:
        exits, followed = self.locate_batch(paths)
        changed = set()
        for path, (node, depth), above in zip(paths, exits, followed):
            if node in changed:
                node, depth = self.locate(path, above)
            changed.add(node)
            self._insert(path, node, depth)

    def totals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of each compacted node's subtree and the smallest of their ids."""
        count, least = np.zeros(len(self.low), np.int64), np.full(len(self.low), np.iinfo(np.int64).max)
        for node, paths in self.members.items():
            count[node], least[node] = len(paths), ids[paths].min()
        # A node lies deeper than its parent.
        for node in np.argsort(-np.array(self.extent, np.int64), kind="stable").tolist():
            above = self.parent[node]
            if above >= 0:
                count[above] += count[node]
                least[above] = min(least[above], least[node])
        return count, least

    def expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """Every node of every depth: its compacted node, and the place of its name."""
        low, extent, path = (np.array(x, np.int64) for x in (self.low, self.extent, self.path))
        is_root = low == extent
        lengths = np.where(is_root, 1, extent - low)
        first = np.array(self.start, np.int64)[path] + np.where(is_root, low, low + 1) - np.array(self.top, np.int64)[path]
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return np.repeat(np.arange(len(low)), lengths), np.repeat(first, lengths) + within


def local_nodes(conv: np.ndarray, pos: np.ndarray, h1: np.ndarray, h2: np.ndarray, words: np.ndarray, head: np.ndarray, batch: int = BATCH) -> dict[str, np.ndarray]:
    """Nodes of one shard's trie and the ends of its conversations, from rows of bands in order.

    A band begins with a row (``head``) that has the place and name of the node it hangs on; its ``words`` are 1 if the conversation ends in the band.
    """
    start = np.flatnonzero(head)
    stop = np.append(start[1:], len(conv))
    own = np.repeat(np.arange(len(start)), stop - start)

    def names(h: np.ndarray) -> np.ndarray:
        each = np.ascontiguousarray(h).view(np.uint64)
        total = np.cumsum(each)
        return (total - (total[start] - each[start])[own]).view(np.int64)

    p1, p2 = names(h1), names(h2)
    raw = np.column_stack([p1, p2]).tobytes()
    trie = ZFastTrie([raw[i : i + 16] for i in range(0, len(raw), 16)], start.tolist(), pos[start].tolist(), pos[stop - 1].tolist())
    for a in range(0, len(start), batch):
        trie.insert_batch(list(range(a, min(a + batch, len(start)))))
    count, least = trie.totals(conv[start])
    node, at = trie.expanded()
    top = head[at] & (pos[at] > 0)  # belongs to the band above
    above = np.where(head[at], at, at - 1)
    ends = stop[words[start] == 1] - 1
    nodes = {
        "kind": np.full(len(at), _NODE, np.int32), "depth": pos[at], "p1": p1[at], "p2": p2[at], "q1": p1[above], "q2": p2[above],
        "first": least[node], "n": np.where(top, 0, count[node]), "words": np.where(head[at], 0, words[at]), "top": top,
    }
    none = np.zeros(len(ends), np.int64)
    last = {"kind": np.full(len(ends), _END, np.int32), "depth": pos[ends], "p1": p1[ends], "p2": p2[ends], "q1": none, "q2": none, "first": conv[ends], "n": none, "words": none, "top": none.astype(bool)}
    return {k: np.concatenate([nodes[k], last[k]]) for k in nodes}


def _build(batch: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # A head may have the place of its band's first turn less one, which no other row of the band has.
        table = table.sort_by([("band", "ascending"), ("conv_id", "ascending"), ("pos", "ascending")])
        columns = [table.column(c).to_numpy() for c in ("conv_id", "pos", "h1", "h2", "words")]
        head = table.column("head").to_numpy().astype(bool)
        found = local_nodes(*columns, head, batch)
        found["shard"] = np.full(len(found["kind"]), key[0].as_py(), np.int32)
        fields = {"kind": pa.int32(), "shard": pa.int32(), "top": pa.bool_()}
        names = [c.split()[0] for c in _LOCAL.split(", ")]
        return pa.table({c: pa.array(found[c], fields.get(c, pa.int64())) for c in names})

    return run


def subtree_sums(name: np.ndarray, above: np.ndarray, depth: np.ndarray, root: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each node's parent (-1 at roots), and each value summed over its subtree. Names are those of ``_names``."""
    order = np.argsort(name)
    parent = np.where(root, -1, order[np.minimum(np.searchsorted(name, above, sorter=order), len(name) - 1)])
    by_depth = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.diff(depth[by_depth], prepend=-1, append=-1))
    sums = [v.copy() for v in values]
    for a, b in zip(edges[:-1], edges[1:]):
        level = by_depth[a:b]
        level = level[parent[level] >= 0]
        for s in sums:
            np.add.at(s, parent[level], s[level])
    return parent, sums


def _names(one: np.ndarray, other: np.ndarray, band: np.ndarray) -> np.ndarray:
    """One sortable name for each pair of 64-bit numbers within a band."""
    return np.column_stack([one, other, band]).astype(">u8").view("S24").reshape(-1)


def _sum_up(band: int):
    """Sums of a shard's own nodes; rows of kind _END bring what hangs below a band to the band's last node."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        columns = {n: table.column(n).to_numpy() for n in table.column_names}
        # The node between two bands stands in a shard twice if both are there: at the end of one and at the top of the other.
        columns["band"] = np.maximum(columns["depth"] - ~columns["top"].astype(bool), 0) // band
        extra = columns["kind"] == _END
        own, below = ({n: v[use] for n, v in columns.items()} for use in (~extra, extra))
        name, saved, leaves = _names(own["p1"], own["p2"], own["band"]), own["saved"].copy(), own["leaves"].copy()
        if extra.any():
            order = np.argsort(name)
            at = order[np.searchsorted(name, _names(below["p1"], below["p2"], below["band"]), sorter=order)]
            np.add.at(saved, at, below["saved"])
            np.add.at(leaves, at, below["leaves"])
        top = own["top"].astype(bool)
        root = top | (own["depth"] == 0)
        parent, (saved, leaves) = subtree_sums(name, _names(own["q1"], own["q2"], own["band"]), own["depth"], root, [saved, leaves])
        keep = ~top
        owner = pa.array(own["owner"][parent[keep]], pa.int64(), mask=root[keep])
        return pa.table({**{n: own[n][keep] for n in ("p1", "p2", "depth")}, "saved": saved[keep], "leaves": leaves[keep], "parent_conv_id": owner})

    return run


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), k1, k2 (hash of role and text) and words of each turn of (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    hash_ = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    part = lambda at: F.conv(F.substr("hash", F.lit(at), F.lit(15)), 16, 10).cast("bigint")
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), hash_.alias("hash"),
        F.regexp_count(text, F.lit(WORDS)).cast("bigint").alias("words"),
    )
    turns = turns.select("conv_id", "turn", part(1).alias("k1"), part(16).alias("k2"), "words", F.lit(1).cast("bigint").alias("one"), F.monotonically_increasing_id().alias("arrival"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("k1"), F.col("k2"), F.col("arrival")]
    numbered = materialize(running_total(turns, order, "one", "number").select("conv_id", "number", "k1", "k2", "words"), "turns")
    first = numbered.groupBy("conv_id").agg(F.min("number").alias("first"))
    return materialize(numbered.join(first, "conv_id").select("conv_id", (F.col("number") - F.col("first") + 1).alias("pos"), "k1", "k2", "words"), "ordered-turns")


def grafted(turns: DataFrame, step: int = STEP, most: int = MOST_HEAD) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations rebuilt on the heads of others, and all conversations (conv_id, length).

    Conversation c takes its first h = crc32(c) % ``most`` turns from conversation c - c % ``step`` (all if that has fewer, none if it
    is absent), then its own turns after its first h.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("own"))
    convs = lengths.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % step).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"))
    heads = turns.where((F.col("conv_id") % step == 0) & (F.col("pos") < most))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.collect_list(F.struct("pos", "k1", "k2", "words")).alias("head"))  # fewer than `most` turns
    convs = convs.join(heads, "base", "left").withColumn("head", F.filter(F.coalesce("head", F.array()), lambda t: t["pos"] <= F.col("h")))
    convs = materialize(convs.withColumn("shift", F.size("head") - F.col("h")), "grafts")
    own = turns.join(convs.select("conv_id", "h", "shift"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "k1", "k2", "words")
    taken = convs.select("conv_id", F.inline("head")).select("conv_id", "pos", "k1", "k2", "words")
    total = F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return own.unionByName(taken), convs.select("conv_id", total.cast("bigint").alias("length"))


def _shard(band: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64("conv_id", band), F.lit(shards)).cast("int")


def _wrapped(total: Column) -> Column:
    """A sum of 64-bit numbers without its carries, as a signed number."""
    whole, half = (F.lit(str(1 << bits)).cast("decimal(38,0)") for bits in (64, 63))
    low = F.pmod(total, whole)
    return F.when(low >= half, low - whole).otherwise(low).cast("bigint")


def _heads(rows: DataFrame, conversations: DataFrame, band: int) -> DataFrame:
    """One row per conversation and band: the place and name of the node that the band hangs on."""
    last = F.greatest(F.ceil(F.col("length") / band) - 1, F.lit(0)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    first = conversations.select("conv_id", zero.alias("band"), zero.alias("h1"), zero.alias("h2"), (last == 0).alias("ends"))
    long = conversations.where(F.col("length") > band).select("conv_id", last.alias("last"))
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)")
    sums = rows.join(long, "conv_id").groupBy("conv_id", "last", "band").agg(exact("h1").alias("s1"), exact("h2").alias("s2"))
    upto = Window.partitionBy("conv_id").orderBy("band")  # a row per band, not per turn
    sums = sums.select("conv_id", "last", (F.col("band") + 1).alias("band"), F.sum("s1").over(upto).alias("s1"), F.sum("s2").over(upto).alias("s2")).where("band <= last")
    later = sums.select("conv_id", "band", _wrapped(F.col("s1")).alias("h1"), _wrapped(F.col("s2")).alias("h2"), (F.col("band") == F.col("last")).alias("ends"))
    return first.unionByName(later)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids of consecutive rows of a node, cut into pieces of about PIECE bytes."""
    types = [*[pa.int64()] * 4, pa.string()]
    name, ids, done, size = None, [], [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names=[*_KEY, "first", "ids"])

    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "conv_id"))):
            if ids and (key != name or 20 * len(ids) >= PIECE):
                done.append((*name, ids[0], ",".join(map(str, ids))))
                size += 20 * len(ids)
                ids = []
                if size >= PIECE:
                    yield flush()
                    done, size = [], 0
            name = key
            ids.append(conv)
    if ids:
        done.append((*name, ids[0], ",".join(map(str, ids))))
        yield flush()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per node over its pieces in turn."""
    name, state = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
            if key == name:
                state.update(b"," + ids.encode())
                continue
            if name:
                done.append((*name, state.hexdigest()))
            name, state = key, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string()])], names=[*_KEY, "ends_sha256"])
    if name:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*name, state.hexdigest()), [pa.int64()] * 3 + [pa.string()])], names=[*_KEY, "ends_sha256"])


def hashed_ends(ends: DataFrame) -> DataFrame:
    """p1, p2, depth and the hash of the ids that end there, from rows with conv_id. A node with very many is listed by many tasks."""
    listed = ends.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id")
    pieces = materialize(listed.mapInArrow(_pieces, "p1 bigint, p2 bigint, depth bigint, first bigint, ids string"), "end-pieces")
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hashes, "p1 bigint, p2 bigint, depth bigint, ends_sha256 string")


def nodes(turns: DataFrame, conversations: DataFrame, band: int = BAND, shard_turns: int = SHARD_TURNS, batch: int = BATCH) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos, k1, k2, words) of all ``conversations`` (conv_id, length).

    p1, p2 (name), depth, conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves, words (of the last turn), saved_tokens and ends_sha256.
    """
    spark = turns.sparkSession
    conversations = materialize(conversations, "conversations")
    rows = turns.select(
        "conv_id", F.floor((F.col("pos") - 1) / band).cast("bigint").alias("band"), F.col("pos").cast("bigint").alias("pos"),
        F.xxhash64("k1", "k2", "pos").alias("h1"), F.xxhash64(F.lit(1), "k2", "k1", "pos").alias("h2"), "words", F.lit(False).alias("head"),
    )
    rows = materialize(rows, "band-turns")
    size = conversations.agg(F.count("*"), F.sum("length"), F.max("length")).first()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size[0] + (size[1] or 0)) // shard_turns))
    heads = materialize(_heads(rows, conversations, band), "band-heads")
    tops = heads.select("conv_id", "band", (F.col("band") * band).alias("pos"), "h1", "h2", F.col("ends").cast("bigint").alias("words"), F.lit(True).alias("head"))
    dealt = rows.unionByName(tops).withColumn("shard", _shard(F.col("band"), shards))
    local = materialize(dealt.groupBy("shard").applyInArrow(_build(batch), _LOCAL), "local-nodes")
    parts = local.where(F.col("kind") == _NODE)
    united = parts.groupBy(*_KEY).agg(
        F.min("first").alias("owner"), F.sum("n").alias("n_convs"), F.max("words").alias("words"), F.max(F.struct(F.col("top") == F.lit(False), "q1", "q2")).alias("above")
    )
    united = materialize(united.select(*_KEY, "owner", "n_convs", "words", "above.q1", "above.q2"), "united-nodes")
    children = united.where("depth > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    known = materialize(united.drop("q1", "q2").join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "nodes")
    counted = (F.col("first") == F.col("owner")) & ~F.col("top")  # in one shard only
    saved = F.when(counted, (F.col("n_convs") - 1) * F.col("turn_words")).otherwise(0).cast("bigint")
    leaf = (counted & (F.col("n_children") == 0)).cast("bigint")
    shape = ["kind", "shard", *_KEY, "q1", "q2", "top", "owner", "saved", "leaves"]
    marked = parts.drop("words").join(known.withColumnRenamed("words", "turn_words"), _KEY).withColumn("saved", saved).withColumn("leaves", leaf).select(shape)
    if (size[2] or 0) > band:
        marked = marked.unionByName(_below(known, heads, band, shards).select(shape))
    sums = marked.groupBy("shard").applyInArrow(_sum_up(band), "p1 bigint, p2 bigint, depth bigint, saved bigint, leaves bigint, parent_conv_id bigint")
    sums = sums.groupBy(*_KEY).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"), F.max("parent_conv_id").alias("parent_conv_id"))
    ends = hashed_ends(local.where(F.col("kind") == _END).select(*_KEY, F.col("first").alias("conv_id")))
    none = hashlib.sha256(b"").hexdigest()
    return known.join(sums, _KEY).join(ends, _KEY, "left").select(
        "p1", "p2", "depth", F.col("owner").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "words", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )


def _below(known: DataFrame, heads: DataFrame, band: int, shards: int) -> DataFrame:
    """What conversations own below each of their bands but the last, as rows at the band's last node, in its shard."""
    deep = known.where(F.col("depth") > band)
    own = deep.groupBy(F.col("owner").alias("conv_id"), F.floor((F.col("depth") - 1) / band).cast("bigint").alias("band")).agg(
        F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves")
    )
    upward = Window.partitionBy("conv_id").orderBy(F.desc("band"))  # a row per band, not per turn
    zero = F.lit(0).cast("bigint")
    rows = heads.where("band > 0").join(own, ["conv_id", "band"], "left")
    rows = rows.withColumn("saved", F.sum(F.coalesce("saved", zero)).over(upward)).withColumn("leaves", F.sum(F.coalesce("leaves", zero)).over(upward))
    return rows.select(
        F.lit(_END).alias("kind"), _shard(F.col("band") - 1, shards).alias("shard"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), (F.col("band") * band).alias("depth"),
        zero.alias("q1"), zero.alias("q2"), F.lit(False).alias("top"), zero.alias("owner"), "saved", "leaves",
    )


def digests(found: DataFrame) -> DataFrame:
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def grafted_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of the grafted conversations of (conv_id, turn, role, text)."""
    return nodes(*grafted(ordered_turns(conversations)))


def sql(step: int = STEP, most: int = MOST_HEAD) -> str:
    """The same as SQL: a row per conversation and depth, named by the hash of all turns up to there."""
    crc = "list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"
    return f"""
        WITH hashed AS (
            SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
        turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS pos FROM hashed),
        convs AS (SELECT DISTINCT conv_id, conv_id - conv_id % {step} AS base, xor({crc}, 4294967295) % {most} AS h FROM conversations WHERE conv_id IS NOT NULL),
        grafted AS (
            SELECT c.conv_id, t.pos, t.k, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL SELECT c.conv_id, t.pos + 1000, t.k, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
        placed AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, k, words FROM grafted),
        paths AS (
            SELECT conv_id, depth, words, sha256(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM placed
            UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
        steps AS (
            SELECT *, lag(node) OVER c AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths WINDOW c AS (PARTITION BY conv_id ORDER BY depth)),
        nodes AS (
            SELECT node, depth, any_value(above) AS above, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM steps GROUP BY node, depth),
        whole AS (SELECT n.*, (SELECT count(*) FROM nodes m WHERE m.above = n.node) AS n_children FROM nodes n),
        owned AS (
            SELECT s.conv_id, s.node, s.depth, CASE WHEN w.conv_id = s.conv_id THEN (w.n_convs - 1) * w.words ELSE 0 END AS saved,
                   (w.conv_id = s.conv_id AND w.n_children = 0)::BIGINT AS leaf FROM steps s JOIN whole w USING (node, depth)),
        below AS (SELECT node, sum(saved) OVER c AS saved, sum(leaf) OVER c AS leaves FROM owned WINDOW c AS (PARTITION BY conv_id ORDER BY depth DESC)),
        sums AS (SELECT node, sum(saved)::BIGINT AS saved_tokens, sum(leaves)::BIGINT AS n_leaves FROM below GROUP BY node)
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
        FROM whole w JOIN sums s USING (node) LEFT JOIN nodes p ON p.node = w.above"""
