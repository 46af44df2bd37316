"""Registered queries against DuckDB on the input tables.

By default a part of the queries that touches every stage; FULL_ORACLE=1 runs them all.
"""
import math
import os

import pytest

from pyspark.sql import functions as F

from shelfwise.plans import oracle, registry

from tests.conftest import SF_DIR

duckdb = pytest.importorskip("duckdb")

TABLES = "region nation customer supplier part orders lineitem events".split()
DEFAULT = (
    "sales_by_category_month zero_sales_percentage top_items_revenue snap_impact price_trend basic_stats dataset_overview "
    "zero_share_hist seasonality_dow abc_class abc_xyz abc_xyz_matrix dim_date dim_item label_encode seasonal_naive "
    "croston_sba croston_forecasts ets_forecast accuracy_by_category model_comparison improvement_pct fact_forecasts "
    "item_forecast_stats error_std_quantiles normal_ppf safety_stock eoq_cost reorder_point newsvendor_profit "
    "budget_allocation policy_by_category dq_report extract_dashboard kpi_cost_summary ss_error_trend "
    "dq_orphan_ids dq_row_counts dq_label_coverage dq_null_counts dq_clip_counts dq_clip_negative fact_forecasts_all best_forecast_all "
    "gbt_forecast_check gbt_beats_naive gbt_importance_check csv_wide_scan csv_calendar_scan csv_price_last parquet_by_store star_tables "
    "result_table csv_result json_result long_schema policy_joined summary_values policy_avg_by_abc risk_by_category cost_by_category "
    "category_months_of_year snap_impact_of_year event_day_sales newsvendor_summary model_features price_change lag_features metric_display "
    "csv_price_arrivals fact_loads sample_rows series_cv_merged footer_profile"
).split()
STATEMENTS = oracle.statements()
CHOSEN = sorted(STATEMENTS) if os.environ.get("FULL_ORACLE") else DEFAULT


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "0" if value == 0 else "inf" if math.isinf(value) else repr(value)
    return repr(value)


def test_every_statement_belongs_to_a_query():
    assert set(STATEMENTS) <= set(registry.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(_plain(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(STATEMENTS[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    expected = sorted(tuple(_plain(row[order.index(c)]) for c in columns) for row in result.fetchall())
    assert got == expected


def test_trees_beat_the_naive_forecast(spark):
    rows = registry.queries()["model_comparison_all"](spark, SF_DIR).collect()
    mae = {(r.Category, r.Model): r.MAE for r in rows}
    assert {m for _, m in mae} == {"Seasonal Naive", "ETS", "Croston SBA (Z-class)", "GBT"}
    for category in {c for c, _ in mae}:
        assert mae[(category, "GBT")] < mae[(category, "Seasonal Naive")]


def test_smoothing_is_a_model_of_its_own(spark):
    """Where a series is smoothed, its forecasts are not those of the naive model; elsewhere they are."""
    run = registry.retail(spark, SF_DIR)
    for forecasting in (run.weekly, run.daily):
        smoothed = forecasting.ets.select("item_id", "store_id", "date", F.lit(True).alias("own"))
        rows = forecasting.base.join(smoothed, ["item_id", "store_id", "date"], "left").collect()
        own = [r.ets_forecast != r.seasonal_naive_forecast for r in rows if r.own and r.ets_forecast + r.seasonal_naive_forecast > 0]
        assert len(own) > 100 and sum(own) > 0.9 * len(own)
        assert all(r.ets_forecast == r.seasonal_naive_forecast for r in rows if not r.own)


def test_one_tree_model_per_run(spark):
    run = registry.retail(spark, SF_DIR)
    assert run.daily.tree_model is run.daily.tree_model
    assert 1 <= run.daily.tree_model.stages[-1].getNumTrees < 1000  # the holdout ended the fit


def test_boosting_goes_on_while_the_holdout_gains(spark, monkeypatch):
    """A smooth signal: more rounds help, so the fit outlasts the first batch of rounds."""
    import datetime as dt

    from shelfwise.operators import features, trees
    from shelfwise.params import DAY

    columns = features.feature_columns(DAY)
    days = spark.range(1500).select("id", F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 150).cast("int")).alias("date"))
    rows = days.select("date", *[((F.col("id") * (k + 7)) % 101).cast("double").alias(c) for k, c in enumerate(columns)])
    rows = rows.withColumn("units_sold", F.col(columns[0]) * 3 + F.col(columns[1]))
    monkeypatch.setattr(trees, "FIRST_ROUNDS", 2)
    monkeypatch.setattr(trees, "LEAST_GAIN", 0.0)
    model = trees.train_trees(rows, dt.date(2020, 5, 29), DAY, most_rounds=8, patience=1, depth=3)
    assert model.stages[-1].getNumTrees > 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_task_over_prices(spark):
    run = registry.retail(spark, SF_DIR)
    from shelfwise.operators.ordering import median_by_counts

    counted = median_by_counts(run.fine.fact_prices, [], "sell_price", "m")
    singles = [line for line in _plan(counted).splitlines() if "SinglePartition" in line]
    assert len(singles) <= 2  # one row per range for their offsets, one row per task for the result; never the values


def test_order_lines_are_not_shuffled_by_supplier_while_stores_are_few(spark):
    from shelfwise.sources import orders

    plan = _plan(orders.observed_sales(spark, SF_DIR, "brand"))
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(l_suppkey" in line]


def test_stages_follow_the_input_files(spark, tmp_path):
    import shutil

    for name in registry.INPUTS:
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    one = registry.retail(spark, str(tmp_path))
    assert registry.retail(spark, str(tmp_path)) is one
    os.utime(tmp_path / "part.parquet", (1, 1))
    assert registry.retail(spark, str(tmp_path)) is not one


def test_stages_can_be_dropped():
    """In a session of its own process, as all stages of the run go."""
    import subprocess
    import sys

    code = f"""
import os, tempfile
from shelfwise.session import local_session, stage_dir
from shelfwise.plans import registry
base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
spark = local_session(2, 2, **{{"spark.checkpoint.dir": base, "spark.sql.warehouse.dir": base + "/warehouse"}})
registry.queries()["parquet_by_store"](spark, "{SF_DIR}").count()
assert spark.catalog.listTables() and os.listdir(base + "/shelfwise")
registry.forget(spark)
assert not spark.catalog.listTables() and not os.listdir(base + "/shelfwise")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=300)


def _moved(df, table):
    """Exchanges above the scan of a table, in a plan without broadcasts of data-sized sides."""
    text = df._jdf.queryExecution().executedPlan().toString()
    path, depth = [], {}
    for line in text.splitlines():
        level = len(line) - len(line.lstrip(" :+-"))
        depth = {k: v for k, v in depth.items() if k < level}
        depth[level] = line
        if f".{table}_" in line and "FileScan" in line:
            path += [v.strip() for v in depth.values() if "Exchange" in v]
    return path


def test_features_read_the_bucketed_fact_in_place(spark):
    run = registry.retail(spark, SF_DIR)
    run.daily.labels, run.brand.codes
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _moved(run.daily.features, "fact_sales") == []
        from shelfwise.operators import segment

        assert _moved(segment.series_totals(run.daily.valued), "fact_sales") == []
        # Without the setting the price join moves the daily rows, so the check above can fail.
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
        assert _moved(segment.series_totals(run.daily.valued.select("*")), "fact_sales") != []
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
