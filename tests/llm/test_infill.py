import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm import infill, registry
from llm.text import utf8
from tests.conftest import SF_DIR
from tests.llm.common import MESSY, documents, plain

AWKWARD = [
    (21, "\n"), (22, "\n\n\n"), (23, "a\nb"), (24, "a\r\nb\r\n"), (25, "has <M> inside\nline"), (26, "<P"), (27, "P>x\n<\n<S\n>"), (28, "é\n東京\n\U0001f600\n"),
    (29, "x y\u0085z\n"), (30, "<\n" * 50), (31, "P>\n" * 50), (31, "P>\n" * 50), (-5, "minus\none"), (1 << 60, "wide\nid\n"),
]


def expected(doc_id, text, seed=7, percent=100, spm=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(lines), "plain", None, None, text
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("seed", "percent", "spm"), [(7, 100, 50), (3, 40, 0), (3, 100, 100), (1, 0, 50)])
def test_awkward_rows_against_lists_of_lines(spark, seed, percent, spm):
    rows = [r[:2] for r in MESSY + AWKWARD]
    made = infill.transform(documents(spark, rows, clashing=True), seed, percent, spm)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()]
    assert sorted(got, key=repr) == sorted(((d, *expected(d, t, seed, percent, spm)) for d, t in rows), key=repr)
    back = [(r.doc_id, r.restored) for r in infill.restore(made).collect()]
    assert sorted(back, key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="<PSM>\nxé", max_size=30), st.integers(0, 50), st.integers(0, 50), st.booleans()), max_size=8), st.integers(1, 9))
def test_scatter_and_gather_are_inverse(rows, block):
    import pyarrow as pa

    data, offsets = utf8(pa.array([t for t, *_ in rows], pa.string()))
    infill.BLOCK, kept = block, infill.BLOCK
    try:
        ends, first = infill.line_ends(data, offsets)
        cuts, forms = [], []
        for i, (text, a, b, spm) in enumerate(rows):
            places = [offsets[i], *ends[first[i] : first[i + 1]]]
            cuts.append(sorted((places[a % len(places)], places[b % len(places)])))
            forms.append(0 if not text or re.search("<[PSM]>", text) else 1 + spm)
        cuts, forms = np.array(cuts, np.int64).reshape(-1, 2), np.array(forms, np.int64)
        out, edges = infill.scatter(data, offsets, cuts, forms)
        for i, (text, *_, spm) in enumerate(rows):
            raw = data[offsets[i] : offsets[i + 1]].tobytes()
            x, y = cuts[i] - offsets[i]
            p, m, s = raw[:x], raw[x:y], raw[y:]
            want = raw if not forms[i] else b"<S>" + s + b"<P>" + p + b"<M>" + m if spm else b"<P>" + p + b"<S>" + s + b"<M>" + m
            assert out[edges[i] : edges[i + 1]].tobytes() == want
        back, places = infill.gather(out, edges, forms)
        assert back.tobytes() == data.tobytes() and places.tolist() == offsets.tolist()
    finally:
        infill.BLOCK = kept


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    found = con.sql(registry.oracle_sql()["op12_infill"])
    columns = [c[0] for c in found.description]
    got = registry.queries()["op12_infill"](spark, SF_DIR)
    assert set(columns) == set(got.columns)
    assert plain(got.select(*columns)) == sorted((tuple(r[columns.index(c)] for c in sorted(columns)) for r in found.fetchall()), key=repr)


def test_empty_table(spark):
    assert infill.digests(infill.transform(documents(spark, []))).count() == 0
