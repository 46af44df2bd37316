"""Reports on a period read the folders of its years only, and give what the whole fact gives."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ingest, reports
from shelfwise.plans import registry
from shelfwise.session import materialize
from shelfwise.sources import orders

from tests.conftest import SF_DIR

FIRST, LAST = dt.date(2019, 12, 20), dt.date(2022, 1, 10)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sales(spark):
    pairs = spark.createDataFrame([("F1", "CA_1"), ("F2", "CA_1"), ("F1", "TX_1"), ("H1", "CA_1")], "item_id string, store_id string")
    days = F.explode(F.sequence(F.lit(FIRST), F.lit(LAST))).alias("date")
    units = (F.abs(F.hash("item_id", "store_id", "date")) % 7).cast("bigint")
    return pairs.select("*", days).withColumn("units_sold", units)


@pytest.fixture
def star(spark):
    sales = _sales(spark)
    stored = materialize(
        sales.withColumn(ingest.YEAR_PART, F.year("date")), "period_sales", ("item_id", "store_id"), partition_by=(ingest.YEAR_PART,)
    )
    dates = ingest.build_dim_date(orders.calendar(spark, FIRST, LAST))
    items = spark.createDataFrame([("F1", "FOODS_1", "FOODS"), ("F2", "FOODS_2", "FOODS"), ("H1", "HOME_1", "HOME")], "item_id string, dept_id string, cat_id string")
    stores = spark.createDataFrame([("CA_1", "CA"), ("TX_1", "TX")], "store_id string, state_id string")
    prices = sales.select("item_id", "store_id", orders.week_of(F.col("date")).alias("wm_yr_wk")).distinct().withColumn("sell_price", F.lit(1.25))
    return sales, stored, dates, items, stores, prices


def _spoil(stored, keep):
    """Make the files of all other years unreadable: whoever opens one fails."""
    others = [f.removeprefix("file:").replace("///", "/") for f in stored.inputFiles() if f"{ingest.YEAR_PART}={keep}/" not in f]
    assert len(others) >= 3
    for path in others:
        Path(path).write_bytes(b"not a file of rows")


def test_one_year_is_read_alone(spark, star):
    sales, stored, dates, items, stores, prices = star
    days = dates.where(F.col("year") == 2021)
    months = lambda fact: reports.sales_by_category_month(fact, days, items, prices).collect()
    uplift = lambda fact: reports.snap_impact(fact, days, items, stores).collect()
    expected = months(sales), uplift(sales)
    _spoil(stored, 2021)
    assert (months(stored), uplift(stored)) == expected
    assert len(expected[0]) == 24 and len(expected[1]) == 2
    with pytest.raises(Exception):  # noqa: B017  (whole fact: the spoiled files are opened)
        reports.snap_impact(stored, dates, items, stores).collect()


def test_years_found_at_run_time(spark, star):
    """The filter names an event and dates, no year: the set of years comes from the days themselves."""
    sales, stored, dates, items, _, prices = star
    days = dates.where((F.col("event_name_1") == "Christmas") & (F.col("date") > F.lit(dt.date(2020, 12, 31))))
    of = lambda fact: reports.sales_by_category_month(fact, days, items, prices)
    expected = of(sales).collect()
    assert "dynamicpruning" in _plan(of(stored))
    _spoil(stored, 2021)
    assert of(stored).collect() == expected and len(expected) == 2


def test_no_days_and_edges(spark, star):
    """No day at all gives no row; the first and last days of a year belong to it."""
    sales, stored, dates, items, stores, prices = star
    none = dates.where(F.col("year") == 1999)
    assert reports.sales_by_category_month(stored, none, items, prices).collect() == []
    assert reports.snap_impact(stored, none, items, stores).collect() == []
    edges = dates.where(F.col("date").isin(dt.date(2020, 12, 31), dt.date(2021, 1, 1)))
    rows = lambda fact: sorted(tuple(r) for r in ingest.on_days(fact, edges.select("date", "year")).select("item_id", "store_id", "date", "units_sold", "year").collect())
    assert rows(stored) == rows(sales) and len(rows(stored)) == 8


def test_queries_prune_and_series_are_still_read_in_place(spark):
    run = registry.retail(spark, SF_DIR)
    queries = registry.queries()
    for name in ("category_months_of_year", "snap_impact_of_year"):
        assert f"({ingest.YEAR_PART}" in _plan(queries[name](spark, SF_DIR)).split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "dynamicpruning" in _plan(queries["event_day_sales"](spark, SF_DIR))
    totals = _plan(run.fine.fact_sales.groupBy("item_id", "store_id").agg(F.sum("units_sold")))
    assert "Exchange" not in totals and ingest.YEAR_PART not in run.fine.fact_sales.columns
