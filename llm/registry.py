"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm import decontaminate, hnsw, infill, language, minhash, ngram_lm, packing, prefix_trie, quality, secrets, token_files, url_filter, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85, size=3)


def op4_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"))


def op4_stupid_backoff_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score(table(spark, sf_dir, "documents"), order=3)


def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(spark, token_files.write(table(spark, sf_dir, "documents")))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digests(found)


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents, language.learn_from_documents(documents))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_zfast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digests(prefix_trie.grafted_trie(table(spark, sf_dir, "conversations")))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(infill.transform(table(spark, sf_dir, "documents")))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


QUERIES = (
    op1_hnsw, op2_rule_ensemble, op3_superminhash, op4_stupid_backoff, op4_stupid_backoff_trigrams, op5_simple8b, op6_decontaminate, op7_best_fit, op8_warc, op9_language, op10_url_filter, op11_zfast_trie, op12_infill, op13_secrets,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    trigrams = {"op4_stupid_backoff_trigrams": ngram_lm.sql_of_order(3)}
    added = {"op11_zfast_trie": prefix_trie.sql(), "op12_infill": infill.sql()}
    return trigrams | added | {"op4_stupid_backoff": ngram_lm.sql(), "op6_decontaminate": decontaminate.sql(), "op8_warc": warc.sql(), "op10_url_filter": url_filter.sql()}
