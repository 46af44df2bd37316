import numpy as np
import pyarrow as pa
import pytest

from llm import hnsw

RNG = np.random.Generator(np.random.PCG64(11))


def near(x, angle):
    away = RNG.standard_normal(x.shape)
    away -= (away @ x) / (x @ x) * x
    return np.cos(angle) * x + np.sin(angle) * away / np.linalg.norm(away) * np.linalg.norm(x)


@pytest.fixture(scope="module")
def rows():
    out = [RNG.standard_normal(16) for _ in range(700)]
    hot = out[5]
    out += [near(hot, RNG.uniform(0, 0.6)) for _ in range(400)]  # around and beyond the link angle of 0.451
    out += [out[7].copy() for _ in range(50)] + [out[8] * 3, out[8] * 1e-3, -out[8]]
    step = out[9]
    for _ in range(40):  # a chain
        step = near(step, 0.4)
        out.append(step)
    ids = RNG.permutation(len(out)) + 10
    table = [(int(i), [float(np.float32(v)) for v in x]) for i, x in zip(ids, out)]
    table += [(1, None), (2, []), (3, [0.0] * 16), (4, [None] * 16), (5, [float("nan")] * 16), (6, [float("inf")] + [1.0] * 15), (7, [1.0, 2.0]), (8, [2.0, 4.0])]
    return table + [(9, table[0][1]), (9, table[0][1]), (None, table[0][1])]


def brute(rows, threshold=0.9):
    use = [k for k, (i, v) in enumerate(rows) if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    units = {k: np.array(rows[k][1]) / np.linalg.norm(rows[k][1]) for k in use}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a in use:
        for b in use:
            if a != b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                p, q = find(rows[a][0]), find(rows[b][0])
                root[max(p, q)] = min(p, q)
    return sorted(((i, n, find(i), i is None or find(i) == i) for (i, _), n in zip(rows, links)), key=repr)


def test_same_as_brute_force(spark, rows):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, vector int, node string")
    for shard_rows in (hnsw.SHARD_ROWS, 60):  # the fewest shards, and many shards and blocks
        got = hnsw.near_vectors(table, shard_rows=shard_rows)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_recall_of_the_graph():
    """Nearest neighbours of vectors without any structure, the hardest case, by the audited beam."""
    x = RNG.standard_normal((4000, 32))
    shard = hnsw.Shard(np.arange(4000), np.ones(4000, np.int64), x, 0.9)
    unit = hnsw.unit(x).astype(np.float32)
    asked = np.arange(0, 4000, 20)
    truth = np.argsort(-(unit[asked] @ unit.T), axis=1)[:, :5]
    found, _ = shard._descend(unit[asked], 2 * shard.ef)[-1]
    heads = np.array(shard.heads)
    recall = np.mean([len(set(heads[f[f >= 0]]) & set(t)) / 5 for f, t in zip(found, truth)])
    assert recall >= 0.9


def test_a_packed_shard_answers_alike():
    x = RNG.standard_normal((300, 8))
    shard = hnsw.Shard(np.arange(300), np.ones(300, np.int64), x, 0.9)
    again = hnsw.Shard.unpack(shard.pack())
    assert (shard.links(np.arange(300), x)[0] == again.links(np.arange(300), x)[0]).all()


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_cells_lose_no_link(spark, rows):
    """So small cells that each node goes to some of hundreds."""
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert hnsw.spread_of(1190, 16, RNG.standard_normal((500, 16)), 0.9, 16).cells > 800
    assert collected(hnsw.near_vectors(table, shard_rows=60, cell_rows=16)) == brute(rows)


def test_vectors_without_links_enter_no_graph(spark, monkeypatch):
    """Most vectors are alone: building graphs of all, and asking all graphs for each, failed by time on large tables."""
    made, materialize = {}, hnsw.materialize
    monkeypatch.setattr(hnsw, "materialize", lambda df, name: made.setdefault(name, materialize(df, name)))
    alone = [RNG.standard_normal(64) for _ in range(2000)]
    rows = [(k, v.tolist()) for k, v in enumerate(alone + [near(v, 0.3) for v in alone[:40]])]
    got = hnsw.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), cell_rows=64)
    assert collected(got) == brute(rows)
    assert made["members"].count() == 80


def test_vectors_at_the_link_angle_meet_in_a_cell():
    """Also where all vectors share a direction, which alone would send them to the same cells."""
    shared = np.eye(64)[0]
    for part in (0, 0.3):
        own = RNG.standard_normal((20_000, 64))
        own[:, 0] = 0
        x = np.sqrt(part) * shared + np.sqrt(1 - part) * hnsw.unit(own) if part else hnsw.unit(RNG.standard_normal((20_000, 64)))
        away = RNG.standard_normal(x.shape)
        away -= np.einsum("ij,ij->i", away, x)[:, None] * x
        y = 0.9 * x + np.sqrt(0.19) * hnsw.unit(away)
        spread = hnsw.spread_of(600_000, 64, x, 0.9)
        directions = hnsw.pivots(64, spread.cells)
        (a, c), (b, d) = spread(x, directions), spread(y, directions)
        met = np.intersect1d(a * spread.cells + c, b * spread.cells + d) // spread.cells
        assert len(np.unique(met)) >= 20_000 - 10
        assert np.bincount(c, minlength=spread.cells).max() < 0.02 * 20_000


def test_vectors_near_the_centre_go_to_all_cells():
    x = np.concatenate([hnsw.unit(RNG.standard_normal((4000, 64)) + 0.5), hnsw.unit(np.ones((1, 64)))])
    spread = hnsw.spread_of(100_000, 64, x, 0.95)
    rows, cells = spread(x, hnsw.pivots(64, spread.cells))
    assert spread.least > 0 and (np.diff(cells) >= 0).all()
    assert (np.sort(cells[rows == 4000]) == np.arange(spread.cells)).all()
    assert (np.bincount(rows)[:4000] >= spread.copies).all()


def test_highest_scores_by_strips():
    scores = RNG.standard_normal((50, 1803)).astype(np.float32)
    assert (np.sort(hnsw.highest(scores, 12)) == np.sort(np.argsort(-scores, axis=1)[:, :12])).all()
    assert (np.sort(hnsw.highest(scores[:, :5], 12)) == np.arange(5)).all()


@pytest.mark.parametrize("dim", [2, 64])
def test_rounded_vectors_that_could_be_linked_are_in_one_set(dim):
    x = RNG.standard_normal((1500, dim)) * np.where(RNG.random((1500, dim)) < 0.2, 9, 1)
    x[700:] = [near(v, 0.45) for v in x[RNG.integers(0, 700, 800)]]  # just within the link angle of 0.451
    x[:300] = [near(x[0], 0.1) for _ in range(300)]
    x = hnsw.unit(x[RNG.permutation(1500)])
    small = np.rint(x * (127 / np.abs(x).max(axis=1, keepdims=True))).astype(np.int8)
    first = hnsw.near_rows(small, 0.9)
    a, b = np.nonzero(x @ x.T >= 0.9)
    assert (first[a] == first[b]).all() and (first <= np.arange(1500)).all()
    assert dim == 2 or len(np.unique(first)) > 300


def cell_batches(cells):
    for dim, cell, nodes, vectors in cells:
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([cell], pa.int32()), pa.array([np.array(nodes, np.int64).tobytes()]), pa.array([np.array(vectors, np.int8).tobytes()])], names=["dim", "cell", "nodes", "vectors"]
        )


def test_a_crowded_cell_is_one_lot(monkeypatch):
    monkeypatch.setattr(hnsw, "CROWDED", 4)
    apart = [[100, 0], [0, 100], [-100, 0], [0, -100]]
    cells = [(2, 0, [1, 2], apart[:2]), (2, 0, [3, 4], [[99, 1], [1, 99]]), (2, 1, [5], apart[:1]), (2, 2, [6, 7, 8], apart[:3]), (2, 2, [9, 10], apart[2:]), (2, 2, [11], apart[:1])]
    found = hnsw._compare(0.9)(cell_batches(cells))
    got = [pair for batch in found for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())]
    assert sorted(got) == [(3, 1), (4, 2), (6, 6), (7, 6), (8, 6), (9, 6), (10, 6), (11, 6)]


def test_an_id_with_several_vectors_and_both_zeros(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, -0.0]), (3, [0.1, 9.0]), (4, [0.2, 9.0]), (5, [-1.0, 0.0])]
    assert collected(hnsw.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))) == brute(rows)
