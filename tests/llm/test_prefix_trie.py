import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm import prefix_trie, registry
from tests.conftest import SF_DIR
from tests.llm.common import plain

SCHEMA = "conv_id bigint, turn bigint, role string, text string, first int, n int, depth int, words int"
SAID = random.Random(3)
ROWS = (
    [(c, t, ("user", "assistant")[t % 2], SAID.choice(["yes", "no no", "", "maybe  so\n", "é 東 京"])) for c in range(45) for t in range(SAID.randint(0, 7))]
    + [(7, None, None, None), (7, None, None, None), (7, 2, "user", None), (21, 1, "x", "tie"), (21, 1, "x", "other tie"), (21, 1, "x", "tie")]
    + [(100 + c, 0, "user", "same opening") for c in range(60)]  # copies of one turn: many are cut to nothing, absent heads
    + [(c, t, "user", "deep " + "w " * (t % 3)) for c in (60, 61, 62, 63, 64) for t in range(23)]
    + [(None, 1, "user", "lost"), (-5, 1, "user", "minus"), (-5, 2, "user", "minus"), (1 << 50, 3, "user", "far"), (200, 1, "user", "long " * 30_000)]
)


def table(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def brute_force(rows):
    """All prefixes of all rebuilt conversations in a dictionary."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv, []).append((turn is not None, turn or 0, key, role, text))
    for own in turns.values():
        own.sort()
    rebuilt = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - int(np.fmod(conv, 20))
        rebuilt[conv] = tuple(t[3:] for t in turns.get(base, [])[:h] + own[h:])
    members = {}
    for conv, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(conv)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = {p for p in below if len(p) == len(path) + 1}
        leaves = sum(not any(len(q) > len(p) and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(found):
    return sorted((tuple(r) for r in prefix_trie.digests(found).collect()), key=repr)


def test_awkward_rows_against_all_prefixes(spark):
    assert rows_of(prefix_trie.grafted_trie(table(spark))) == brute_force(ROWS)


@pytest.mark.parametrize(("band", "shard_turns", "batch"), [(3, 20, 2), (1, 1000, 1000), (8, 50, 1)])
def test_bands_shards_and_batches_do_not_matter(spark, monkeypatch, band, shard_turns, batch):
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    turns, convs = prefix_trie.grafted(prefix_trie.ordered_turns(table(spark)))
    assert rows_of(prefix_trie.nodes(turns, convs, band, shard_turns, batch)) == brute_force(ROWS)


def drawn(*values):
    return int.from_bytes(hashlib.sha256(repr(values).encode()).digest()[:8], "little", signed=True)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=25), st.integers(1, 6))
def test_trie_of_one_shard(paths, batch):
    conv, pos, h, words, head = [], [], [], [], []
    for number, path in enumerate(paths):
        conv += [number] * (len(path) + 1)
        pos += range(len(path) + 1)
        h += [0] + [drawn(depth, turn) for depth, turn in enumerate(path)]
        words += [1] + [turn + 5 for turn in path]
        head += [True] + [False] * len(path)
    h = np.array(h, np.int64)
    found = prefix_trie.local_nodes(np.array(conv), np.array(pos), h, h // 2, np.array(words), np.array(head), batch)
    use = found["kind"] == 0
    got = sorted(zip(*(found[c][use].tolist() for c in ("depth", "first", "n", "words"))))
    members = {}
    for number, path in enumerate(paths):
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(number)
    assert got == sorted((len(p), min(m), len(m), p[-1] + 5 if p else 0) for p, m in members.items())
    assert len(set(zip(found["p1"][use].tolist(), found["depth"][use].tolist()))) == len(members)
    ends = sorted(zip(found["first"][~use].tolist(), found["depth"][~use].tolist()))
    assert ends == [(number, len(path)) for number, path in enumerate(paths)]


def test_handles_lie_at_two_fattest_depths():
    for low in range(40):
        for high in range(low + 1, 70):
            assert prefix_trie.two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: x & -x)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'")
    found = con.sql(registry.oracle_sql()["op11_zfast_trie"])
    columns = [c[0] for c in found.description]
    got = registry.queries()["op11_zfast_trie"](spark, SF_DIR)
    assert set(columns) == set(got.columns)
    assert plain(got.select(*columns)) == sorted((tuple(r[columns.index(c)] for c in sorted(columns)) for r in found.fetchall()), key=repr)


def test_empty_table(spark):
    assert prefix_trie.grafted_trie(table(spark, [])).count() == 0
