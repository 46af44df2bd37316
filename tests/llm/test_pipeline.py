import collections

import corpus_pipeline
from llm import registry
from tests.conftest import SF_DIR
from tests.llm.common import MESSY, documents


def test_stages_are_the_agreed_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "decontaminate", "pack"]


def test_pipeline_runs_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
            sizes.append(docs.count())
            assert 0.5 * sizes[-2] < sizes[-1] <= sizes[-2]
    assert sizes[2] < sizes[1] and sizes[3] < sizes[2]  # quality and near-duplicates drop some
    one, other = ({(r.doc_id, r.piece, r.length, r.ids_crc32) for r in x.collect()} for x in (docs, corpus_pipeline.run(spark, SF_DIR)))
    assert one == other
    assert len({d for d, *_ in one}) == sizes[4]


def test_near_duplicate_stage_keeps_one_row_of_repeated_rows(spark):
    out = corpus_pipeline.near_duplicates(spark, documents(spark, MESSY, clashing=True), SF_DIR)
    assert out.columns == documents(spark, MESSY, clashing=True).columns
    assert collections.Counter(r.doc_id for r in out.collect()) == {1: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, None: 2, 10: 1}


def test_language_stage_rejects_what_no_language_claims(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang")
    junk = [(900_001, "xqzt wvkj pqrr zzxx kkqj vvwq bnmk jjqz wxvk ptkq zzqj"), (900_002, "12 34 ??"), (900_003, None), (900_004, "")]
    planted = docs.union(documents(spark, junk))
    kept = {r.doc_id for r in corpus_pipeline.language(spark, planted, SF_DIR).collect()}
    assert not kept & {d for d, _ in junk}
    assert kept == {r.doc_id for r in docs.where("text rlike '[A-Za-z]'").collect()}


def test_dropping_documents_moves_no_text(spark):
    from llm import minhash

    rows = [(k, f"text {k} " * 50) for k in range(400)] + [(5, "another text of five"), (None, "without an id"), (None, "without an id")]
    docs = documents(spark, rows, clashing=True)
    gone = spark.range(0, 300, 7).toDF("node")
    expected = sorted(((d, t) for d, t in rows if d is None or d >= 300 or d % 7), key=repr)
    for most in (1000, 0):  # a broadcast, a bitmap
        out = minhash.without(docs, gone, most_broadcast=most)
        assert out.columns == docs.columns and sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == expected
    plan = minhash.without(docs, gone)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    again = minhash.one_row_each(docs, spark.createDataFrame([(5,)], "node bigint")).where("doc_id = 5").collect()
    other = minhash.one_row_each(docs.repartition(7, "text"), spark.createDataFrame([(5,)], "node bigint")).where("doc_id = 5").collect()
    assert len(again) == 1 and again == other


def test_stages_take_awkward_and_empty_tables(spark):
    for rows in (MESSY, []):
        docs = documents(spark, rows, clashing=True)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.count() <= 2000 and (name == "pack" or out.columns == docs.columns)


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in registry.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(registry.oracle_sql()) <= set(registry.queries())
