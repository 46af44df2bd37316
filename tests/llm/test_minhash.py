import itertools

import numpy as np
import pytest

from llm import minhash
from llm.components import components
from tests.llm.common import MESSY, documents

VOCABULARY = [f"w{k}" for k in range(400)]


def words_of(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()


def brute(docs, percent, size):
    sets = []
    for _, text, *_ in docs:
        w = words_of(text)
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    root = {d[0]: d[0] for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(zip(docs, sets), 2):
        if a[0] is not None and b[0] is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a[0]), find(b[0])
            root[max(p, q)] = min(p, q)
    return sorted(((d[0], len(s), find(d[0]), find(d[0]) == d[0]) for d, s in zip(docs, sets)), key=repr)


def hub_and_spokes(rng, first, n, words, edits):
    """Copies of one text, each with its own edits: most are similar to the original only, not to each other."""
    base = rng.choice(VOCABULARY, words).tolist()
    out = []
    for k in range(n):
        text = list(base)
        for place in rng.choice(words, edits[k % len(edits)], replace=False):
            text[place] = f"x{rng.integers(1 << 40)}"
        out.append((first + k, " ".join(text)))
    out[n // 2] = (first + n // 2, " ".join(base))  # the hub has neither the first nor the last id
    return out


@pytest.fixture(scope="module")
def docs():
    rng = np.random.Generator(np.random.PCG64(5))
    out = list(MESSY) + hub_and_spokes(rng, 100, 60, 200, [2, 5, 8, 12, 20]) + hub_and_spokes(rng, 200, 30, 60, [1, 2, 3])
    chain = rng.choice(VOCABULARY, 120).tolist()  # each is similar to the next, the ends are not
    for k in range(25):
        out.append((300 + k, " ".join(chain)))
        chain[4 * k : 4 * k + 2] = [f"y{k}", f"z{k}"]
    out += [(400 + k, " ".join(rng.choice(VOCABULARY, 50))) for k in range(40)]
    return out


@pytest.mark.parametrize("percent,size,block", [(85, 3, minhash.BLOCK_SHINGLES), (80, 5, 2_000), (85, 1, 500)])
def test_same_as_brute_force(spark, docs, percent, size, block):
    got = minhash.near_duplicates(documents(spark, docs, clashing=True), percent, size, block)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr) == brute(docs, percent, size)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_signatures_stop_early_without_a_difference():
    """The plain form: every element draws all its ranks, nothing stops."""
    rng = np.random.Generator(np.random.PCG64(2))
    sizes = [0, 1, 2, 30, 500, 3000]
    elements = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = 40
    expected = np.full((len(sizes), places), minhash._EMPTY, np.uint64)
    order = np.tile(np.arange(places), (len(elements), 1))
    for step in range(places):
        swap, rank = minhash._draw(elements, step, places)
        for e in range(len(elements)):
            order[e, step], order[e, swap[e]] = order[e, swap[e]], order[e, step]
            expected[rows[e], order[e, step]] = min(expected[rows[e], order[e, step]], rank[e])
    assert (minhash.superminhash(elements, rows, len(sizes), places) == expected).all()


def test_signatures_estimate_similarity():
    rng = np.random.Generator(np.random.PCG64(3))
    shared, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    elements, rows = np.concatenate([shared, a, shared, b]), np.repeat([0, 1], 700)
    found = minhash.superminhash(elements, rows, 2, 400)
    assert abs((found[0] == found[1]).mean() - 0.75) < 0.06


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(1, 60)] + [(900, 900), (901, 902), (902, 901), (901, 902)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 1 for k in range(1, 60)}, 500: 1, 901: 901, 902: 901}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_block_takes_little_memory_for_each_shingle():
    import tracemalloc

    rng = np.random.default_rng(1)
    base = rng.integers(-(2**62), 2**62, 200)
    sets = [np.unique(np.where(rng.random(200) < 0.1, rng.integers(-(2**62), 2**62, 200), base)) for _ in range(1500)]
    asks = np.arange(1500) >= 1490
    labels = np.where(asks, np.arange(1500), 0)
    tracemalloc.start()
    links = minhash.block_links(sets, labels, asks, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links and peak < 40 * sum(map(len, sets))


def test_a_worker_gives_back_the_memory_of_a_task():
    import subprocess
    import sys

    code = """if 1:
        import re, numpy as np, pyarrow as pa
        from llm import quality, text
        def held():
            return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024
        rng = np.random.default_rng(1)
        texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 300)) for _ in range(6000)]
        batch = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array(range(6000)), pa.array(texts)], ["doc_id", "text"])], ["row"])
        run = text.giving_back(quality._measure)
        before = held()
        for _ in run(iter([batch] * 2)): pass
        print(held() - before)
    """
    assert float(subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True).stdout) < 30
