"""Extracts are written once; the quality gate rests on what the writes have seen."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import extracts, quality
from shelfwise.plans import registry

from tests.conftest import SF_DIR

SCHEMA = "item_id string, store_id string, `cat id` string, EOQ double, order_qty bigint, note string"
ROWS = [
    ("a", "S1", "FOODS", -1.0, 3, None),
    ("a", "S1", "FOODS", -1.0, 3, None),
    ("b", None, None, None, -7, "x"),
    (None, "S9", "HOME", float("nan"), 0, ""),
]


def _written(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    conditions = {"foods": F.col("cat_id") == "FOODS", "other": F.col("cat_id") != "FOODS"}
    return df, extracts.write_extract(df, "planted", lambda d: quality.clip_negative(quality.clean(d)), conditions)


@pytest.mark.parametrize("rows", [ROWS, []])
def test_the_write_counts_what_scans_would(spark, rows):
    df, extract = _written(spark, rows)
    assert extract.rows.columns == ["item_id", "store_id", "cat_id", "EOQ", "order_qty", "note"]
    assert extract.n_rows == extract.rows.count() == len(rows)
    assert extract.nulls == {r.column_name: r.n_null for r in quality.null_counts(df, "t").collect()}
    assert extract.negatives == {r.column_name: r.n_clipped for r in quality.negative_counts(df, "t").collect()}
    # Conditions see the rows as written: a NULL category has become UNKNOWN, which is not FOODS.
    assert extract.matches == {name: extract.rows.where(c).count() for name, c in (("foods", "cat_id = 'FOODS'"), ("other", "cat_id <> 'FOODS'"))}
    assert extract.rows.where("EOQ < 0 or order_qty < 0 or note is null").count() == 0
    if rows:
        assert extract.nulls["cat id"] == 1 and extract.negatives == {"EOQ": 2, "order_qty": 1} and extract.matches == {"foods": 2, "other": 2}


def test_report_from_writes_equals_report_from_scans(spark):
    df, extract = _written(spark, ROWS)
    checks = quality.expectation("size", quality.count_of(df), quality.count_of(df.limit(1)))
    orphans = quality.orphan_ids({"planted": df}, df.where("item_id = 'a'"), df.where("store_id = 'S1'"))
    seen = {r.rule: r.findings for r in extracts.report({"planted": extract}, ["planted"], checks, orphans).collect()}
    scanned = {r.rule: r.findings for r in quality.report({"planted": df}, checks, orphans).collect()}
    assert seen == scanned
    # Unknown are item b and NULL, store S9 and NULL.
    assert seen == {"null_values": 6, "negative_values": 3, "column_names": 1, "row_counts": 1, "id_consistency": 4}


def _scans(df):
    """How often the plan scans each stage folder or table."""
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    return Counter(re.findall(r"FileScan.*?/([\w-]+)-[0-9a-f]{32}[\],]", plan))


def test_the_gate_reads_no_extract_twice(spark):
    queries = registry.queries()
    found = _scans(queries["dq_report"](spark, SF_DIR))
    extracted = {name: n for name, n in found.items() if name.startswith("extract-")}
    assert set(extracted) == {f"extract-{n}" for n in ("dashboard", "policy", "newsvendor", "allocation", "fact_forecasts")}
    assert set(extracted.values()) == {1}  # for their ids only
    assert not {"policy", "newsvendor", "allocation", "best"} & set(found)  # nor the stages behind them
    for name in ("dq_row_counts", "extract_summary", "dq_clip_counts"):
        assert not [n for n in _scans(queries[name](spark, SF_DIR)) if n.startswith("extract-")]
