"""Language model, language identification, quality classifier: SQL, brute force and held-out accuracy."""

import duckdb
import numpy as np
import pytest

from llm import language, ngram_lm, quality
from tests.conftest import SF_DIR
from tests.llm.common import MESSY, documents, plain

SMALL = SF_DIR


def test_language_model_is_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    rows = [r[:2] for r in MESSY] + [(k, f"the cat number {k} sat on the mat") for k in range(20, 40)]
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    result = con.execute(ngram_lm.sql())
    columns = sorted(d[0] for d in result.description)
    names = [d[0] for d in result.description]
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    assert plain(ngram_lm.score(documents(spark, rows, clashing=True))) == expected


def test_language_model_in_many_classes_and_blocks(spark, monkeypatch):
    rows = [(k, " ".join(f"v{(k * j) % 23}" for j in range(60))) for k in range(60)]
    whole = plain(ngram_lm.score(documents(spark, rows)))
    monkeypatch.setattr(ngram_lm, "CLASS_WORDS", 50)
    assert plain(ngram_lm.score(documents(spark, rows).repartition(7))) == whole


def test_language_model_of_another_corpus(spark):
    corpus = documents(spark, [(1, "a b a b a c"), (2, "a b")])
    got = {r.doc_id: r for r in ngram_lm.score(documents(spark, [(1, "a b"), (2, "b z"), (3, "")]), corpus).collect()}
    n = 8
    assert got[1].score == pytest.approx((np.log10(4 / n) + np.log10(3 / 4)) / 2, abs=1e-6)
    assert got[2].score == pytest.approx((np.log10(3 / n) + np.log10(0.4) + np.log10(1 / n)) / 2, abs=1e-6) and got[2].n_backoff == 1
    assert got[3].score is None
    assert ngram_lm.score(documents(spark, [])).count() == 0


def test_hashes_survive_shortening():
    rng = np.random.Generator(np.random.PCG64(1))
    for n in (1, 2, 70_000):
        h = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        assert (ngram_lm.lengthened(ngram_lm.shortened(h)) == h).all()


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def test_languages_of_held_out_documents(spark):
    docs = table(spark, "documents")
    model = language.learn_from_documents(docs)
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    held = docs.where(language.held_out(docs.doc_id)).collect()
    assert len(held) > 30 and np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values())


def test_languages_of_awkward_rows(spark):
    rows = [(100 + k, t, g) for k in range(40) for t, g in (("the cat and the dog", "en"), ("der hund und die katze", "de"))] + [(1, "the dog", None)]
    model = language.learn(documents(spark, rows))
    assert model.languages == ("de", "en")
    got = sorted(((r.doc_id, r.lang_pred) for r in language.identify(documents(spark, MESSY, clashing=True), model).collect()), key=repr)
    none = {3, 4, 5, 10}
    assert all((lang == "und") == (doc in none) for doc, lang in got if doc is not None) and len(got) == len(MESSY)
    kept = language.determined(documents(spark, MESSY, clashing=True), model)
    assert kept.columns == documents(spark, MESSY, clashing=True).columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in MESSY} - none
    assert {r.lang_pred for r in language.identify(documents(spark, MESSY), language.learn(documents(spark, []))).collect()} == {"und"}
    assert language.identify(documents(spark, []), model).count() == 0


def test_kernel_is_the_share_of_common_ngrams():
    def grams(text):
        b = text.encode()
        return {(n, b[k : k + n]) for n in (1, 2, 3) for k in range(len(b) - n + 1)}

    texts = ["hello world", "help the word", "zzz", ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    bits = language.presence(data, offsets, places=1 << 16)
    got = language.kernel(bits, bits)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            x, y = grams(a), grams(b)
            assert got[i, j] == pytest.approx(len(x & y) / np.sqrt(len(x) * len(y)) if x and y else 0, abs=0.02)


def test_quality_of_held_out_documents(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    truth = labels.where(quality.held_out(labels.doc_id)).collect()
    assert len(got) == docs.count() and len(truth) > 10
    assert np.mean([got[r.doc_id].predicted == r.quality for r in truth]) >= 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_scores_do_not_see_labels_that_are_held_out(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = ([(r.doc_id, round(r.score, 6)) for r in quality.score_documents(docs, x).orderBy("doc_id").collect()] for x in (labels, turned))
    assert one == other


def test_quality_of_awkward_rows(spark):
    rule = ((quality.Bound("log_words", True, 2.5),), 3.0)
    ensemble = quality.Ensemble(-1.5, (rule,))
    docs = documents(spark, MESSY, clashing=True)
    got = quality.classify(quality.measure(docs), ensemble).collect()
    assert len(got) == len(MESSY) and {r.predicted for r in got if r.doc_id in (1, 2, 8)} == {1} and {r.predicted for r in got if r.doc_id in (3, 4, 5, 6)} == {0}
    kept = quality.good(docs, ensemble)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 8}
    assert quality.measure(documents(spark, [])).count() == 0


def test_quality_without_labels_of_both_kinds(spark):
    docs = documents(spark, MESSY)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.score_documents(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (2, 1), (2, 1), (7, 1)], "doc_id bigint, quality int")
    assert {round(r.score, 6) for r in quality.score_documents(docs, odd).collect()} == {0.75}  # 2 and 7 count, 1 contradicts itself


def test_statistics_of_one_text_alone_and_among_others():
    texts = ["A B!! c|d\n\nx x x x", "", "été 12,5%", "x " * 500]
    one = [quality.statistics(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in texts]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    assert np.allclose(np.vstack(one), quality.statistics(data, offsets)) and not one[1].any()
    first = dict(zip(quality.STATISTICS, one[0][0]))
    assert first["repeated_neighbours"] == 3 / 7 and first["upper"] == 2 / 18 and first["exclaims"] == 2 / 18
