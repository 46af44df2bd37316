"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next.

1. language: documents without letters, and those that no learned language claims, go.
2. quality: documents that the rule ensemble scores below its threshold go.
3. near_duplicates: of each group of documents that share 0.8 of their 5-word shingles, the smallest doc_id stays.
4. decontaminate: documents of which at least a twentieth stands in benchmark windows go.
5. pack: the rest becomes token sequences of 1024.

Every stage but the last returns the columns it was given. Language and quality models are learned as their operators say,
from the stage's own documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm import decontaminate as benchmark_hits, language as languages, minhash, packing, quality as qualities
from shelfwise.session import materialize

CACHED_PARTS = 100_000  # for each of two generations: workers and executors still hold what the stages before took


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages stay; those without letters, and those that no language claims, go.

    The model is learned from the stage's own rows with a language. Null and empty texts have no letters and go; short texts with letters stay; very long
    ones are judged whole; ties between languages decide nothing here; repeated rows are judged alike; without labelled rows every text
    with a letter stays; an empty table stays empty; all columns are kept, whatever their names.
    """
    return languages.determined(docs, languages.learn_from_documents(docs))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores below its threshold go.

    It is learned from labelled rows of the stage's own input. Null and empty texts have statistics of zero and are scored by them; a score at
    the threshold stays; repeated rows are scored alike; without labels all have one score; an empty table stays empty; all
    columns are kept, whatever their names.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return qualities.good(docs, qualities.ensemble_for(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays.

    Null, empty and wordless texts are nobody's duplicate and stay; fewer than five words are one shingle; very long texts count whole. Rows that
    repeat a doc_id are one document, of which one row stays, chosen by a fixed order; rows without an id all stay. An empty table stays
    empty; all columns are kept, whatever their names.
    """
    return minhash.distinct_documents(docs, percent=80, size=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words stands in windows of benchmark items go.

    Null, empty and wordless texts have no hit and stay; very long texts are scanned whole; items without an id count as well; exactly a twentieth
    goes; repeated rows are judged alike; empty tables have no hits; all columns are kept, whatever their names.
    """
    return benchmark_hits.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents become sequences of at most 1,024 tokens.

    Null and empty texts are one end token; longer ones than a sequence are cut; rows that repeat an id are pieces of their own; an empty
    table gives none; extra columns are left behind.
    """
    return packing.pack_documents(docs, cached_parts=CACHED_PARTS)


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Trained models and signatures have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
