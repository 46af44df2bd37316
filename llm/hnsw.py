"""Embedding near-dedup: hierarchical navigable small-world graphs, each asked by the vectors that could have a link in it.

* Equal vectors are one node. Each node goes, as one byte a component, to the few *cells* whose random pivots score highest for it.
  Whether two vectors share a cell depends on their angle alone, and nodes go to so many cells that two at the link angle do, but for a
  chance of about 1 in 10,000 (``cells_of_a_node``; less at smaller angles). A mean that all vectors share is taken out first. In
  a cell all nodes are compared by matrix products, with the rounding's largest error allowed for. This only tells which nodes could be
  linked, directly or over others: a *lot* is closed, no link leads out of it. A cell of too many nodes is one lot, uncompared. A node
  without a lot is alone.
* Small lots are bundled, a graph for each bundle. The nodes of a larger lot are dealt to shards by hash and all its shards are asked
  by all its nodes, so a large group of near copies spreads over all of them.
* In a shard, a vector within half the link angle of a graph node joins that node's *clump*; only clump heads are graph nodes.
  Angles obey the triangle inequality, so a clump's members are all linked, and a vector whose angle to the head plus the clump's
  radius is within the link angle is linked with all of them. Large groups are therefore counted, not paired; members
  that the bounds do not decide are compared one by one in double precision.
* Beams: a search keeps the best ``ef`` nodes and expands a few of them at a time for a whole batch of queries. When a
  shard is built, probes at the very edge of reach of known nodes audit recall, and ``ef`` doubles until they are found. A query whose beam
  is full of nodes within reach is asked again with a beam twice as wide.
* Links are never written as pairs: each cell (shard, block of queries) gives link counts and a spanning set of links, which are
  united by ``components``.

Defined cases: a null, empty or zero vector, or one with null or non-finite components, links with nothing and is its own component; so
does a row without vec_id. Vectors of different lengths never link. Rows that share a vec_id are one component and counted as rows.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.components import components
from llm.text import mix, small_batches
from shelfwise.session import materialize

THRESHOLD = 0.9
SHARD_ROWS = 50_000
BUNDLES = 32  # of small groups to a shard's rows
CELL_ROWS = 4096
CELLS_OF_A_NODE = 12
MOST_CELLS_OF_A_NODE = 32  # beyond that, cells cost more than they spare
MOST_CELLS = 16_384
CROWDED = 65_536  # a cell of more nodes is one group
DRAWS = 2000
LEAST_CENTRE = 0.02  # squared length of a mean that is taken out
KNOWN_BYTES = 4 << 20
PACKED = 4096  # bytes of nodes in a row, about
GRAPH_LINKS = 24
BEAM = 32
EXPANDED = 4
AUDITS = 256
AUDIT_RECALL = 0.998
BLOCKS_A_GRAPH = 16
MARGIN = 1e-7  # radians; arccos near 1 is exact to 1.5e-8 only


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision and without overflow."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def diverse(to_query: np.ndarray, between: np.ndarray, links: int) -> np.ndarray:
    """Mask of at most ``links`` candidates per row (sorted by similarity, -inf: none): first those closer to the
    query than to any one kept before, then the next best."""
    rows, n = to_query.shape
    kept = np.zeros((rows, n), bool)
    for j in range(n):
        shadowed = (np.where(kept[:, :j], between[:, j, :j], -np.inf) >= to_query[:, j, None]).any(axis=1) if j else np.zeros(rows, bool)
        kept[:, j] = ~shadowed & (to_query[:, j] > -np.inf) & (kept.sum(axis=1) < links)
    rest = ~kept & (to_query > -np.inf)
    room = links - kept.sum(axis=1, keepdims=True)
    return kept | (rest & (np.cumsum(rest, axis=1) <= room))


class Layer:
    """One level: vectors, links, and where each node is on the level below."""

    def __init__(self, dim: int, links: int):
        self.n, self.links = 0, links
        self.x = np.zeros((64, dim), np.float32)
        self.near = np.full((64, links), -1, np.int32)
        self.below = np.zeros(64, np.int32)

    def _room(self, n: int) -> None:
        while n > len(self.x):
            self.x = np.concatenate([self.x, np.zeros_like(self.x)])
            self.near = np.concatenate([self.near, np.full_like(self.near, -1)])
            self.below = np.concatenate([self.below, np.zeros_like(self.below)])

    def search(self, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``ef`` nodes (-1: none) and similarities, descending, for each query, from its entry nodes."""
        n_q = len(q)
        ids = np.full((n_q, ef), -1, np.int64)
        sims = np.full((n_q, ef), -np.inf, np.float32)
        seen = np.zeros((n_q, self.n + 1), bool)  # the last column stands for -1
        seen[:, self.n] = True
        opened = np.zeros((n_q, ef), bool)
        self._merge(q, np.arange(n_q), entry[:, :ef], ids, sims, opened, seen)
        while True:
            waiting = np.where(opened | (ids < 0), -np.inf, sims)
            rows = np.flatnonzero(waiting.max(axis=1) > -np.inf)
            if not len(rows):
                return ids, sims
            w = min(EXPANDED, ef)
            pick = np.argpartition(-waiting[rows], w - 1, axis=1)[:, :w]
            real = np.take_along_axis(waiting[rows], pick, 1) > -np.inf
            chosen = np.where(real, np.take_along_axis(ids[rows], pick, 1), -1)
            opened[rows[:, None], pick] = True
            self._merge(q, rows, np.where(chosen[:, :, None] >= 0, self.near[chosen], -1).reshape(len(rows), -1), ids, sims, opened, seen)

    def _merge(self, q, rows, new, ids, sims, opened, seen) -> None:
        """Puts unseen nodes into the beams of these rows, in place."""
        new = np.sort(new, axis=1)
        fresh = ~seen[rows[:, None], new]
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        seen[rows[:, None], new] = True
        some = fresh.any(axis=1)
        rows, new, fresh = rows[some], new[some], fresh[some]
        if not len(rows):
            return
        value = np.full(new.shape, -np.inf, np.float32)
        r, c = np.nonzero(fresh)
        value[r, c] = np.einsum("ij,ij->i", q[rows[r]], self.x[new[r, c]])
        all_ids = np.concatenate([ids[rows], np.where(fresh, new, -1)], axis=1)
        all_sims = np.concatenate([sims[rows], value], axis=1)
        all_opened = np.concatenate([opened[rows], np.zeros(new.shape, bool)], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, : ids.shape[1]]
        ids[rows] = np.take_along_axis(all_ids, order, 1)
        sims[rows] = np.take_along_axis(all_sims, order, 1)
        opened[rows] = np.take_along_axis(all_opened, order, 1)

    def add(self, x: np.ndarray, below: np.ndarray, found: np.ndarray, sims: np.ndarray) -> np.ndarray:
        """New nodes with candidate neighbours from the graph; the batch's own vectors are candidates too."""
        first, m = self.n, len(x)
        self._room(first + m)
        new = np.arange(first, first + m)
        self.x[new], self.below[new] = x, below
        self.n += m
        own = x @ x.T
        np.fill_diagonal(own, -np.inf)
        take = min(m, self.links)
        close = np.argsort(-own, axis=1, kind="stable")[:, :take]
        cand = np.concatenate([found, close + first], axis=1)
        value = np.concatenate([sims, np.take_along_axis(own, close, 1)], axis=1).astype(np.float32)
        value[cand < 0] = -np.inf
        self._choose(new, cand, value)
        src, k = np.nonzero(self.near[new] >= 0)
        dst = self.near[new][src, k].astype(np.int64)
        self._back(dst, new[src])
        return new

    def _choose(self, nodes: np.ndarray, cand: np.ndarray, value: np.ndarray) -> None:
        """Sets the links of nodes to diverse candidates."""
        order = np.argsort(-value, axis=1, kind="stable")[:, : 2 * self.links]
        cand, value = np.take_along_axis(cand, order, 1), np.take_along_axis(value, order, 1)
        v = self.x[np.maximum(cand, 0)]
        kept = diverse(value, v @ v.transpose(0, 2, 1), self.links)
        out = np.full((len(nodes), self.links), -1, np.int32)
        r, c = np.nonzero(kept)
        place = np.cumsum(kept, axis=1)[r, c] - 1
        out[r, place] = cand[r, c]
        self.near[nodes] = out

    def _back(self, dst: np.ndarray, src: np.ndarray) -> None:
        """Links back; a node with too many keeps diverse ones."""
        order = np.argsort(dst, kind="stable")
        dst, src = dst[order], src[order]
        nodes, at, counts = np.unique(dst, return_index=True, return_counts=True)
        place = np.arange(len(dst)) - np.repeat(at, counts)
        for a in range(0, len(nodes), 256):
            own = slice(a, a + 256)
            wide = int(counts[own].max())
            more = np.full((len(nodes[own]), wide), -1, np.int64)
            use = slice(at[a], at[a] + int(counts[own].sum()))
            more[np.repeat(np.arange(len(nodes[own])), counts[own]), place[use]] = src[use]
            cand = np.sort(np.concatenate([self.near[nodes[own]].astype(np.int64), more], axis=1), axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            value = np.einsum("ij,ikj->ik", self.x[nodes[own]], self.x[np.maximum(cand, 0)])
            value[cand < 0] = -np.inf
            self._choose(nodes[own], cand, value)


class Shard:
    """Graph over clump heads, clumps, and the beam that passed the audit."""

    def __init__(self, nodes: np.ndarray, weights: np.ndarray, vectors: np.ndarray, threshold: float):
        self.nodes, self.weights, self.x = nodes, weights, unit(vectors)
        self.reach = self.angle = float(np.arccos(threshold))
        self.threshold, self.ef = threshold, BEAM
        self.layers = [Layer(self.x.shape[1], GRAPH_LINKS)]
        self.head_of = np.full(len(nodes), -1, np.int64)  # number of the clump
        self.heads: list[int] = []
        self._build()

    def _levels(self, rows: np.ndarray) -> np.ndarray:
        """Level of each node, one in sixteen a level up, from a hash of its id."""
        bits = mix(self.nodes[rows].astype(np.uint64))
        level, still = np.zeros(len(rows), np.int64), np.ones(len(rows), bool)
        for _ in range(6):
            still = still & ((bits & np.uint64(15)) == 0)
            level += still
            bits >>= np.uint64(4)
        return level

    def _descend(self, q: np.ndarray, ef: int, to: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
        """Search results on every level from the top down to ``to``."""
        entry, out = np.zeros((len(q), 1), np.int64), []
        for level in range(len(self.layers) - 1, to - 1, -1):
            layer = self.layers[level]
            ids, sims = layer.search(q, entry, ef if level == 0 else min(ef, 16))
            out.append((ids, sims))
            entry = np.where(ids[:, :8] >= 0, layer.below[np.maximum(ids[:, :8], 0)], -1)
        return out

    def _build(self) -> None:
        # Heads are more than this apart, so no two members of a clump are further apart than the link angle.
        join = self.angle / 2 - MARGIN
        done, n = 0, len(self.nodes)
        while done < n:
            rows = np.arange(done, min(n, done + min(max(32, done // 2), 512)))
            done = rows[-1] + 1
            q = self.x[rows].astype(np.float32)
            found = self._descend(q, 2 * BEAM) if self.layers[0].n else []
            if found:
                ids, sims = found[-1]
                near = (ids[:, 0] >= 0) & (sims[:, 0] >= np.cos(join) - 1e-4)
                heads = np.array(self.heads)[np.maximum(ids[:, 0], 0)]
                near &= np.einsum("ij,ij->i", self.x[rows], self.x[heads]) >= np.cos(join)
                self.head_of[rows[near]] = ids[near, 0]
            else:
                near = np.zeros(len(rows), bool)
            fresh, own = [], self.x[rows] @ self.x[rows].T
            for k in np.flatnonzero(~near).tolist():
                to = next((j for j in fresh if own[k, j] >= np.cos(join)), None)
                if to is None:
                    self.head_of[rows[k]] = len(self.heads)
                    self.heads.append(int(rows[k]))
                    fresh.append(k)
                else:
                    self.head_of[rows[k]] = self.head_of[rows[to]]
            if fresh:
                self._insert(rows[fresh], q[fresh], [(i[fresh], s[fresh]) for i, s in found])
        self._clumps()
        self._audit()

    def _insert(self, rows: np.ndarray, q: np.ndarray, found: list) -> None:
        levels, top = self._levels(rows), len(self.layers) - 1
        below = rows  # on the lowest level: the row itself
        for level in range(int(levels.max()) + 1):
            if level == len(self.layers):
                self.layers.append(Layer(self.x.shape[1], GRAPH_LINKS))
            use = levels >= level
            if level <= top and found:
                ids, sims = found[top - level]
            else:
                ids, sims = np.zeros((len(rows), 0), np.int64), np.zeros((len(rows), 0), np.float32)
            added = np.full(len(rows), -1, np.int64)
            added[use] = self.layers[level].add(q[use], below[use], ids[use], sims[use])
            below = added
        # The search starts at node 0 of the top level, which exists once any node is there.

    def _clumps(self) -> None:
        order = np.argsort(self.head_of, kind="stable")
        self.members = order
        self.member_at = np.concatenate([[0], np.cumsum(np.bincount(self.head_of, minlength=len(self.heads)))])
        cos = np.einsum("ij,ij->i", self.x, self.x[np.array(self.heads)[self.head_of]])
        radius = np.zeros(len(self.heads))
        np.maximum.at(radius, self.head_of, np.arccos(np.clip(cos, -1, 1)))
        radius[np.diff(self.member_at) == 1] = 0
        self.radius = radius
        self.clump_weight = np.bincount(self.head_of, self.weights, len(self.heads)).astype(np.int64)
        self.reach = self.angle + float(radius.max(initial=0))

    def _audit(self) -> None:
        """Probes at the edge of reach of some heads; the beam doubles until nearly all find their head."""
        rng = np.random.Generator(np.random.PCG64(len(self.nodes)))
        chosen = rng.permutation(len(self.heads))[:AUDITS]
        x = self.x[np.array(self.heads)[chosen]]
        away = rng.standard_normal(x.shape)
        away -= np.einsum("ij,ij->i", away, x)[:, None] * x
        if x.shape[1] < 2:
            return
        probes = (np.cos(self.reach) * x + np.sin(self.reach) * unit(away)).astype(np.float32)
        while self.ef < len(self.heads):
            ids, _ = self._descend(probes, self.ef)[-1]
            if (ids == chosen[:, None]).any(axis=1).mean() >= AUDIT_RECALL:
                return
            self.ef *= 2

    def within_reach(self, q: np.ndarray, clump: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For batches of queries: (query, clump) numbers of all heads within reach, a query's own clump (or -1) among them."""
        least = np.float32(np.cos(self.reach) - 1e-4)
        for a in range(0, len(q), 512):
            rows, ef = np.arange(a, min(a + 512, len(q))), self.ef
            while len(rows):
                ids, sims = self._descend(q[rows].astype(np.float32), ef)[-1]
                full = (sims[:, -1] >= least) & (ef < len(self.heads))
                r, c = np.nonzero((sims >= least) & (ids >= 0) & ~full[:, None])
                own = clump[rows]
                lost = ~full & (own >= 0) & ~((ids == own[:, None]) & (sims >= least)).any(axis=1)
                yield np.concatenate([rows[r], rows[lost]]), np.concatenate([ids[r, c], own[lost]])
                rows, ef = rows[full], 2 * ef

    def links(self, nodes: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Number of linked rows of this shard for each query, itself left out, and links that span what is linked."""
        x = unit(vectors)
        counts, spanning = np.zeros(len(nodes), np.int64), []
        root: dict[int, int] = {}

        def find(k: int) -> int:
            while root.setdefault(k, k) != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)  # nodes are ascending
        here = self.nodes[at] == nodes
        for queries, clumps in self.within_reach(x, np.where(here, self.head_of[at], -1)):
            cos = np.einsum("ij,ij->i", x[queries], self.x[np.array(self.heads)[clumps]])
            angle = np.arccos(np.clip(cos, -1, 1))
            alone = self.radius[clumps] == 0
            whole = np.where(alone, cos >= self.threshold, angle + self.radius[clumps] <= self.angle - MARGIN)
            none = np.where(alone, ~whole, angle - self.radius[clumps] > self.angle + MARGIN)
            for k in np.flatnonzero(~none).tolist():
                q, clump = int(queries[k]), int(clumps[k])
                if whole[k]:
                    hits = int(self.clump_weight[clump])
                else:
                    members = self.members[self.member_at[clump] : self.member_at[clump + 1]]
                    hits = int(self.weights[members][self.x[members] @ x[q] >= self.threshold].sum())
                if not hits:
                    continue
                counts[q] += hits
                me, head = int(nodes[q]), int(self.nodes[self.heads[clump]])
                a, b = find(me), find(head)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    spanning.append((me, head))
        return counts - np.where(here, self.weights[at], 0), spanning  # each has found itself in its own clump

    def pack(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"{name}{k}": getattr(layer, name)[: layer.n] for k, layer in enumerate(self.layers) for name in ("x", "near", "below")}
        np.savez(
            out, nodes=self.nodes, weights=self.weights, vectors=self.x, head_of=self.head_of, heads=np.array(self.heads, np.int64),
            numbers=np.array([self.threshold, self.ef, len(self.layers)], np.float64), **arrays,
        )
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Shard:
        a, self = np.load(io.BytesIO(data)), cls.__new__(cls)
        self.nodes, self.weights, self.x, self.head_of, self.heads = a["nodes"], a["weights"], a["vectors"], a["head_of"], a["heads"].tolist()
        self.threshold, self.ef, n_layers = float(a["numbers"][0]), int(a["numbers"][1]), int(a["numbers"][2])
        self.angle = float(np.arccos(self.threshold))
        self.layers = []
        for k in range(n_layers):
            layer = Layer(self.x.shape[1], GRAPH_LINKS)
            layer.x, layer.near, layer.below = (a[f"{name}{k}"] for name in ("x", "near", "below"))
            layer.n = len(layer.x)
            self.layers.append(layer)
        self._clumps()
        return self


def _vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]).reshape(-1, dim)


def _sorted(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes in ascending order, their ids, vectors and copies."""
    order = np.argsort(table.column("number").to_numpy(), kind="stable")
    nodes, ids, copies = (table.column(name).to_numpy()[order] for name in ("number", "node", "copies"))
    return nodes, ids, _vectors(table.column("vector"), dim)[order], copies


def _graph(threshold: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dim, lot, shard = (k.as_py() for k in key)
        nodes, ids, vectors, copies = _sorted(table, dim)
        made = Shard(nodes, copies, vectors, threshold)
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "lot": pa.array([lot], pa.int64()), "shard": pa.array([shard], pa.int32()),
            "graph": pa.array([made.pack()], pa.binary()), "shard_ids": pa.array([ids.tobytes()], pa.binary()),
        })

    return run


def _block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    dim, lot, block = (k.as_py() for k in key)
    nodes, ids, vectors, _ = _sorted(table, dim)
    return pa.table({
        "dim": pa.array([dim], pa.int32()), "lot": pa.array([lot], pa.int64()), "block": pa.array([block], pa.int32()),
        "nodes": pa.array([nodes.tobytes()], pa.binary()), "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary()),
    })


def _answer(counts: np.ndarray, spanning: list[tuple[int, int]], nodes: np.ndarray, ids: np.ndarray, shard: Shard, shard_ids: np.ndarray) -> pa.RecordBatch:
    """(node, -1, links) for nodes with links, and (vec_id, vec_id, -1) for links that span them."""
    some = np.flatnonzero(counts)
    a, b = np.array(spanning, np.int64).reshape(-1, 2).T
    a, b = ids[np.searchsorted(nodes, a)], shard_ids[np.searchsorted(shard.nodes, b)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([nodes[some], a])), pa.array(np.concatenate([np.full(len(some), -1, np.int64), b])), pa.array(np.concatenate([counts[some], np.full(len(a), -1, np.int64)]))],
        names=["node", "other", "links"],
    )


def _bundle(threshold: float):
    """Graph of whole groups, asked by its own nodes."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        nodes, ids, vectors, copies = _sorted(table, key[0].as_py())
        shard = Shard(nodes, copies, vectors, threshold)
        return pa.Table.from_batches([_answer(*shard.links(nodes, vectors), nodes, ids, shard, ids)])

    return run


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, last = None, None
    for batch in batches:
        for k in range(batch.num_rows):
            dim, *at = (batch.column(name)[k].as_py() for name in ("dim", "lot", "shard"))
            if last != (dim, *at):
                shard, last = Shard.unpack(batch.column("graph")[k].as_py()), (dim, *at)
            nodes, ids, shard_ids = (np.frombuffer(batch.column(name)[k].as_py(), np.int64) for name in ("nodes", "ids", "shard_ids"))
            data = batch.column("vectors")[k].as_py()
            vectors = np.frombuffer(data, np.float32 if len(data) == 4 * dim * len(nodes) else np.float64).reshape(-1, dim)
            yield _answer(*shard.links(nodes, vectors), nodes, ids, shard, shard_ids)


def pivots(dim: int, cells: int) -> np.ndarray:
    """Random directions: what two vectors score on them depends on the angle between the vectors alone."""
    return unit(np.random.Generator(np.random.PCG64(dim)).standard_normal((cells, dim))).astype(np.float32)


def highest(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores of each row, in no order."""
    rows, wide = scores.shape
    side = 16
    if wide < 4 * n * side:
        return np.argpartition(-scores, n - 1, axis=1)[:, :n] if n < wide else np.tile(np.arange(wide), (rows, 1))
    # The n highest stand in the n strips of the highest maxima; a strip has every so manieth score, so that maxima are taken along rows.
    if wide % side:
        scores = np.pad(scores, ((0, 0), (0, -wide % side)), constant_values=-np.inf)
    strips = scores.reshape(rows, side, -1)
    best = np.argpartition(-strips.max(axis=1), n - 1, axis=1)[:, :n]
    among = np.take_along_axis(strips, best[:, None, :], 2).reshape(rows, -1)
    at = np.argpartition(-among, n - 1, axis=1)[:, :n]
    return at // n * strips.shape[2] + np.take_along_axis(best, at % n, 1)


def cells_of_a_node(cells: int, dim: int, cos: float) -> int:
    """To how many cells each of two vectors of this cosine has to go so that they meet but for a chance of about 1 in 10,000: in
    trials of up to 100,000 draws, that takes five thirds of what suffices for 99 of 100 draws."""
    rng, places = np.random.Generator(np.random.PCG64(cells)), np.arange(min(cells, 2 * MOST_CELLS_OF_A_NODE))
    worse, enough = np.maximum(places[:, None], places), []
    for _ in range(DRAWS // 100):
        one, other = rng.standard_normal((2, 100, cells), dtype=np.float32)
        length = np.sqrt(one**2 + other**2 + 2 * rng.standard_gamma(max(0, dim - 2) / 2, (100, cells), dtype=np.float32))
        ranked = []
        for scores in (one / length, (cos * one + np.float32(np.sqrt(1 - cos**2)) * other) / length):
            to = highest(scores, len(places))
            ranked.append(np.take_along_axis(to, np.argsort(-np.take_along_axis(scores, to, 1), axis=1), 1))
        enough.append(np.where(ranked[0][:, :, None] == ranked[1][:, None, :], worse, cells).min(axis=(1, 2)) + 1)
    return -(-5 * int(np.quantile(np.concatenate(enough), 0.99, method="higher")) // 3)


class Spread(NamedTuple):
    """How the nodes of one length go to cells: by what is left of them beside the centre; those closer to it than ``least`` go to all."""

    cells: int = 1
    copies: int = 1
    centre: np.ndarray | None = None
    least: float = 0.0

    def __call__(self, x: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of each copy of the unit vectors x, by cell."""
        if self.cells == 1:
            return np.arange(len(x)), np.zeros(len(x), np.int64)
        beside = x if self.centre is None else x - self.centre
        to = np.concatenate([highest(beside[a : a + 1000].astype(np.float32) @ directions.T, self.copies) for a in range(0, len(x), 1000)])
        close = np.linalg.norm(beside, axis=1) < self.least
        far = np.flatnonzero(~close)
        rows = np.concatenate([np.repeat(far, self.copies), np.repeat(np.flatnonzero(close), self.cells)])
        cell = np.concatenate([to[far].ravel(), np.tile(np.arange(self.cells), int(close.sum()))])
        order = np.argsort(cell, kind="stable")
        return rows[order], cell[order]


def spread_of(n: int, dim: int, some: np.ndarray, threshold: float, cell_rows: int = CELL_ROWS) -> Spread:
    """The spread of n nodes, of which some are known. Vectors that share much with each other would crowd into few cells; without their
    mean they don't, but then links span larger angles, the more so the closer a vector is to the mean."""
    if n <= 8 * cell_rows:
        return Spread()
    cells = min(-(-n * CELLS_OF_A_NODE // cell_rows // 16) * 16, MOST_CELLS)
    mean = unit(some).sum(axis=0) / max(1, len(some))
    centre, least, cos = None, 0.0, threshold
    if mean @ mean > LEAST_CENTRE:
        centre = mean
        least = float(np.quantile(np.linalg.norm(unit(some) - centre, axis=1), CELLS_OF_A_NODE / 10 / cells))
        cos = float(np.sqrt(max(0.0, 1 - (2 - 2 * threshold) / max(least, 1e-9) ** 2)))  # the least of two vectors as far from the centre, or farther
    copies = cells_of_a_node(cells, dim, cos)
    return Spread(cells, copies, centre, least) if copies <= min(MOST_CELLS_OF_A_NODE, cells) else Spread()


def _deal(plans: dict[int, Spread]):
    """Nodes, rounded to a byte a component, packed by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                use = batch.filter(pa.array(dims == dim)) if (dims != dim).any() else batch
                x = unit(_vectors(pa.chunked_array([use.column("vector")]), dim))
                if dim not in made:
                    made[dim] = pivots(dim, plans[dim].cells)
                rows, cell = plans[dim](x, made[dim])
                small = np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype(np.int8)
                # A row ends where the cell changes, or is full.
                first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
                place = np.arange(len(cell)) - np.repeat(first, np.diff(np.r_[first, len(cell)]))
                at = np.flatnonzero(place % max(1, PACKED // (dim + 8)) == 0)
                ends = np.r_[at, len(cell)]
                nodes, vectors = use.column("number").to_numpy()[rows], small[rows]
                binary = lambda data, width: pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), dim, np.int32)), pa.array(cell[at].astype(np.int32)), binary(nodes, 8), binary(vectors, dim)], names=["dim", "cell", "nodes", "vectors"]
                )

    return run


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the first row of its set) after the sets of each pair of rows are united."""
    while True:
        p, q = label[a], label[b]
        apart = p != q
        if not apart.any():
            return label
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]


def near_rows(small: np.ndarray, threshold: float) -> np.ndarray:
    """For each rounded vector the first row of its set: rows that could be within the link angle are in one set.

    A rounded vector is off by half a step a component at most, so its angle is known to ``off``.
    """
    n, dim = small.shape
    x = small.astype(np.float32)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    off = float(np.arcsin(np.minimum(1, np.sqrt(dim) / 2 / length)).max())
    least = np.float32(np.cos(min(np.pi, np.arccos(threshold) + 2 * off)) - 1e-4)
    x /= length
    label, room = np.arange(n), np.empty(256 * 4096, np.float32)  # memory that is new for each product would take as long as the product
    for a in range(0, n, 256):
        rows = np.arange(a, min(a + 256, n))
        # Rows of the set that most of these are in need not be compared with each other.
        values, counts = np.unique(label[rows], return_counts=True)
        most = values[counts.argmax()] if counts.max() > 1 else -1
        for part, within in ((rows[label[rows] != most], None), (rows[label[rows] == most], most)):
            if not len(part):
                continue
            rest = np.arange(a, n) if within is None else a + np.flatnonzero(label[a:] != within)
            y = x[part]
            for c in range(0, len(rest), 4096):
                cols = rest[c : c + 4096]
                there = x[cols[0] : cols[-1] + 1] if cols[-1] - cols[0] + 1 == len(cols) else x[cols]
                cos = np.matmul(y, there.T, out=room[: len(y) * len(cols)].reshape(len(y), -1))
                if within is None and c == 0:
                    cos[np.arange(len(part)), part - a] = -1  # each with itself
                if cos.max() >= least:
                    r, k = np.nonzero(cos >= least)
                    label = _joined(label, part[r], cols[k])
    return label


def _compare(threshold: float):
    """Links that span the sets of each cell, from rows in order of their cells."""

    def links(key: tuple[int, int], nodes: list[np.ndarray], vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own = np.concatenate(nodes)
        first = near_rows(np.concatenate(vectors).reshape(-1, key[0]), threshold)
        some = np.flatnonzero(first != np.arange(len(own)))
        return own[some], own[first[some]]

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes, vectors, n, head = None, [], [], 0, 0
        for batch in batches:
            keys = np.stack([batch.column(name).to_numpy() for name in ("dim", "cell")], axis=1)
            ends = np.r_[np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
            for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
                if a == b:
                    continue
                if (key := (int(keys[a, 0]), int(keys[a, 1]))) != last:
                    if 1 < n <= CROWDED:
                        yield out(*links(last, nodes, vectors))
                    last, nodes, vectors, n = key, [], [], 0
                new = np.frombuffer(b"".join(batch.column("nodes")[a:b].to_pylist()), np.int64)
                if not n:
                    head = new[0]
                n += len(new)
                if n <= CROWDED:
                    nodes.append(new)
                    vectors.append(np.frombuffer(b"".join(batch.column("vectors")[a:b].to_pylist()), np.int8))
                else:
                    for some in [*nodes, new]:
                        yield out(some, np.full(len(some), head))
                    nodes, vectors = [], []
        if 1 < n <= CROWDED:
            yield out(*links(last, nodes, vectors))

    return run


def lots_of(nodes: DataFrame, threshold: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(number, lot) of the nodes that could have a link; nodes of different lots have none."""
    spark = nodes.sparkSession
    small_batches(spark)
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    plans = dict.fromkeys(sizes, Spread())
    for dim in (dim for dim, n in sizes.items() if n > 8 * cell_rows):
        # A few nodes tell where the centre is; any would do for right results.
        share = max(1, sizes[dim] * dim * 4 // KNOWN_BYTES)
        some = nodes.where((F.col("dim") == dim) & (F.pmod("more", F.lit(share)) == 0)).select("vector").toArrow().column("vector")
        plans[dim] = spread_of(sizes[dim], dim, _vectors(some, dim) if len(some) else np.ones((0, dim)), threshold, cell_rows)
    cells = nodes.select("dim", "number", "vector").mapInArrow(_deal(plans), "dim int, cell int, nodes binary, vectors binary")
    cells = cells.repartition(tasks(spark, sum(sizes.values())), "dim", "cell").sortWithinPartitions("dim", "cell")
    united = components(cells.mapInArrow(_compare(threshold), "a bigint, b bigint"))
    return united.select(F.col("node").alias("number"), F.col("component").alias("lot"))


def tasks(spark, rows: int) -> int:
    """Of work that takes its time in Python: not fewer because there are few bytes."""
    return max(4 * spark.sparkContext.defaultParallelism, -(-rows // 16_384))


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of (vec_id, embedding); threshold above 0. The table is read twice."""
    spark = embeddings.sparkSession
    single = dict(embeddings.select("embedding").dtypes)["embedding"] == "array<float>"
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("vector"))
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & ~bad & F.exists("vector", lambda v: v != 0), F.lit(False))
    rows = rows.select("vec_id", F.when(usable, F.col("vector")).alias("vector"))
    name = [F.xxhash64(F.lit(k), "vector") for k in (1, 2)]  # 128 bits name a vector where it need not move
    nodes = rows.where("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = materialize(nodes.select("*", F.size("vector").alias("dim"), name[0].alias("name"), name[1].alias("more"), F.monotonically_increasing_id().alias("number")), "nodes")
    named = rows.select("vec_id", F.when(F.col("vector").isNotNull(), name[0]).alias("name"), F.when(F.col("vector").isNotNull(), name[1]).alias("more"))
    rows = materialize(named.join(nodes.select("name", "more", "number", "node", "copies"), ["name", "more"], "left").select("vec_id", "number", "node", "copies"), "vectors")
    lots = materialize(lots_of(nodes, threshold, cell_rows), "lots")
    # Lots of at most a bundle's rows are dealt to bundles, larger ones, which are few, to shards of their own.
    n, bundle = lots.count(), max(1, shard_rows // BUNDLES)
    sizes = lots.groupBy("lot").agg(F.count("*").alias("n")).where(F.col("n") > bundle)
    sizes = sizes.select("lot", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards")).withColumn("sets", F.ceil(F.col("shards") / BLOCKS_A_GRAPH).cast("int"))
    dealt = lots.join(F.broadcast(sizes), "lot", "left").join(nodes.select("number", "node", "copies", "dim", "vector"), "number")
    dealt = materialize(dealt, "members")
    place = lambda salt, n: F.pmod(F.xxhash64("number", F.lit(salt)), n).cast("int")
    parts = tasks(spark, n)
    own = F.when(F.col("shards") == 1, -1 - F.col("lot")).otherwise(F.pmod(F.xxhash64("lot"), F.lit(max(1, -(-n // bundle)))))
    kept = dealt.where("shards is null or shards = 1").withColumn("bundle", own)
    answers = kept.repartition(parts, "dim", "bundle").groupBy("dim", "bundle").applyInArrow(_bundle(threshold), "node bigint, other bigint, links bigint")
    large = dealt.where("shards > 1")
    graphs = materialize(
        large.withColumn("shard", place(1, F.col("shards"))).repartition(parts, "dim", "lot", "shard").groupBy("dim", "lot", "shard")
        .applyInArrow(_graph(threshold), "dim int, lot bigint, shard int, graph binary, shard_ids binary"), "graphs",
    )
    asking = large.withColumn("block", place(2, F.col("shards"))).groupBy("dim", "lot", "block").applyInArrow(_block, "dim int, lot bigint, block int, nodes binary, ids binary, vectors binary")
    sizes = F.broadcast(sizes.where("shards > 1"))
    graphs = graphs.join(sizes, "lot").select("dim", "lot", "shard", "graph", "shard_ids", F.explode(F.sequence(F.lit(0), F.col("sets") - 1)).alias("set"))
    asking = asking.join(sizes, "lot").select(
        "dim", "lot", "nodes", "ids", "vectors", F.pmod("block", "sets").alias("set"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    )
    cells = asking.join(graphs, ["dim", "lot", "shard", "set"]).select("dim", "lot", "shard", "graph", "shard_ids", "nodes", "ids", "vectors")
    found = materialize(answers.union(cells.mapInArrow(_ask, "node bigint, other bigint, links bigint")), "found")
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "number")
    same_id = rows.where("number is not null").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    united = components(found.where("links < 0").select(F.col("node").alias("a"), F.col("other").alias("b")).union(same_id.where("a <> b")))
    united = united.select(F.col("node").alias("vec_id"), F.col("component").alias("component_id"))
    n_links = F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0))
    return (
        rows.join(counts, "number", "left").join(united, "vec_id", "left")
        .select("vec_id", n_links.cast("bigint").alias("n_links"), F.coalesce(F.when(F.col("number").isNotNull(), F.col("component_id")), "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
