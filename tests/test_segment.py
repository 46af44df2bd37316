import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import segment


def _totals(spark, revenues):
    rows = [(f"i{n}", "s", Decimal(v)) for n, v in enumerate(revenues)]
    return spark.createDataFrame(rows, "item_id string, store_id string, total_revenue decimal(30,2)")


def test_classes_include_the_edges(spark):
    got = segment.with_abc(_totals(spark, [40, 30, 20, 10])).orderBy("item_id").select("abc_class").collect()
    assert [r[0] for r in got] == ["A", "A", "B", "C"]  # shares .4 .7 .9 1.0


def test_ties_across_the_edge_follow_the_key(spark):
    got = segment.with_abc(_totals(spark, [10] * 10)).orderBy("item_id").select("abc_class").collect()
    assert [r[0] for r in got] == ["A"] * 7 + ["B"] * 2 + ["C"]


def test_no_revenue_is_class_c(spark):
    got = segment.with_abc(_totals(spark, [0, 0])).select("abc_class").collect()
    assert [r[0] for r in got] == ["C", "C"]


def test_scope_restarts_per_store(spark):
    rows = [("a", "s1", Decimal(90)), ("b", "s1", Decimal(10)), ("a", "s2", Decimal(7)), ("b", "s2", Decimal(3))]
    df = spark.createDataFrame(rows, "item_id string, store_id string, total_revenue decimal(30,2)")
    got = {(r.item_id, r.store_id): r.abc_class for r in segment.with_abc(df, ["store_id"]).collect()}
    assert got == {("a", "s1"): "B", ("b", "s1"): "C", ("a", "s2"): "A", ("b", "s2"): "C"}


def test_cv_limits_and_zero_mean(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (1.0,), (1.01,), (float("inf"),)], "cv double")
    assert [r[0] for r in segment.with_xyz(df).select("xyz_class").collect()] == ["X", "Y", "Y", "Z", "Z"]
    zero = spark.createDataFrame([(0, 0.0, 5)], "sum_units bigint, sum_squares double, n_periods bigint")
    assert segment.with_variation(zero).first().cv == float("inf")
    flat = spark.createDataFrame([(15, 45.0, 5)], "sum_units bigint, sum_squares double, n_periods bigint")
    assert segment.with_variation(flat).first().cv == 0.0


def test_matrix_keeps_empty_cells(spark):
    df = spark.createDataFrame([("AX",), ("AX",), ("CZ",)], "abc_xyz string")
    got = [tuple(r) for r in segment.segment_matrix(df).orderBy("abc_class").collect()]
    assert got == [("A", 2, 0, 0), ("B", 0, 0, 0), ("C", 0, 0, 1)]


def test_missing_price_counts_as_no_revenue(spark):
    df = spark.createDataFrame([("a", "s", 5, None), ("a", "s", 2, 1.99)], "item_id string, store_id string, units_sold bigint, sell_price double")
    assert segment.daily_revenue(df).agg(F.sum("revenue_cents")).first()[0] == 398


@pytest.mark.parametrize("extra", range(7))
def test_weeks_are_laid_from_the_cutoff(spark, extra):
    """No week crosses the cutoff, every week has seven days, and an incomplete first one is left out."""
    first, n = dt.date(2020, 1, 1), 56 + extra
    last = first + dt.timedelta(days=n - 1)
    cutoff = last - dt.timedelta(days=28)
    rows = [("a", "s", first + dt.timedelta(days=k), 1, 2.0) for k in range(n)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, date date, units_sold bigint, sell_price double")
    got = sorted((r.date, r.units_sold) for r in segment.demand_panel(df, first, cutoff, 7).collect())
    assert [units for _, units in got] == [7] * 8
    assert [(day - cutoff).days for day, _ in got] == [1 + 7 * k for k in range(-4, 4)]
