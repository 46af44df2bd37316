"""Stupid backoff beyond bigrams: SQL of the same order, longer context by hand, many classes."""

import duckdb
import numpy as np
import pytest

from llm import ngram_lm
from llm.registry import op4_stupid_backoff_trigrams
from tests.conftest import SF_DIR
from tests.llm.common import MESSY, documents, plain


def _expected(con, statement):
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    return sorted((tuple(row[names.index(c)] for c in sorted(names)) for row in result.fetchall()), key=repr)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_each_order_is_its_sql(spark, order):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    rows = [r[:2] for r in MESSY] + [(k, f"the cat number {k % 7} sat on the mat on the {k % 3}") for k in range(20, 40)]
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert plain(ngram_lm.score(documents(spark, rows, clashing=True), order=order)) == _expected(con, ngram_lm.sql_of_order(order))
    if order == 2:
        assert _expected(con, ngram_lm.sql_of_order(2)) == _expected(con, ngram_lm.sql())


def test_a_trigram_counts_its_whole_context(spark):
    """After "b a" always c, after "d a" always e: bigrams alone give each a half."""
    rows = [(1, "b a c"), (2, "b a c"), (3, "d a e"), (4, "d a e")]
    got = {r.doc_id: r for r in ngram_lm.score(documents(spark, rows), order=3).collect()}
    assert got[1].score == pytest.approx((np.log10(2 / 12) + 0 + 0) / 3, abs=1e-6) and got[1].n_backoff == 0


def test_trigrams_in_many_classes_and_blocks(spark, monkeypatch):
    rows = [(k, " ".join(f"v{(k * j) % 23}" for j in range(60))) for k in range(60)]
    whole = plain(ngram_lm.score(documents(spark, rows), order=3))
    monkeypatch.setattr(ngram_lm, "CLASS_WORDS", 50)
    assert plain(ngram_lm.score(documents(spark, rows).repartition(7), order=3)) == whole


def test_the_trigram_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert plain(op4_stupid_backoff_trigrams(spark, SF_DIR)) == _expected(con, ngram_lm.sql_of_order(3))
