import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import accuracy, allocation, inventory, kpi, newsvendor, policy, quality, selection
from shelfwise.params import DAILY_POLICY

STATS = "item_id string, store_id string, cat_id string, dept_id string, state_id string, abc_class string, xyz_class string, abc_xyz string, forecast_mean double, actual_mean double, forecast_bias double, forecast_error_std double, forecast_rmse double, cv_actual double, sell_price double, best_model_used string"


def _stats(spark, rows):
    full = [
        (i, "S1", cat, f"{cat}_1", "CA", abc, "X", f"{abc}X", mean, mean, 0.1, std, 1.0, 0.5, price, "GBT")
        for i, cat, abc, mean, std, price in rows
    ]
    return spark.createDataFrame(full, STATS)


@pytest.fixture(scope="module")
def costs(spark):
    rows = [
        ("a", "FOODS", "A", 4.0, 2.0, 3.0),
        ("b", "FOODS", "B", 0.0, 0.0, 2.0),
        ("c", "HOBBIES", "C", 1.0, 5.0, 0.001),
        ("d", "HOUSEHOLD", "?", 100.0, 0.5, 10.0),
    ]
    return policy.with_policy_cost(inventory.inventory_policy(_stats(spark, rows))).cache()


def test_safety_stock_by_hand(costs):
    rows = {r.item_id: r for r in costs.collect()}
    assert rows["a"].safety_stock == 10.9  # 2.0537 * 2 * sqrt(7) = 10.867
    assert rows["a"].ss_holding_cost == pytest.approx(10.9 * 3 * 0.2)
    assert rows["a"].safety_stock_90 == 6.8 and rows["a"].safety_stock_95 == 8.7
    assert rows["b"].safety_stock == 0.0
    assert rows["d"].service_level == 0.90  # unknown class


def test_order_quantity_edges(costs):
    rows = {r.item_id: r for r in costs.collect()}
    assert rows["a"].EOQ == 156.0  # sqrt(2 * 1460 * 5 / 0.6) = 155.99
    assert rows["b"].EOQ == 1.0 and rows["b"].DOH == 999.0 and rows["b"].turnover == 0.0
    assert rows["c"].sell_price == 0.01  # price floor; the unit cost floor is 0.01 too
    assert rows["c"].EOQ == 604.0  # sqrt(2 * 365 * 5 / 0.01) = 604.15
    assert all(r.EOQ >= 1 and r.safety_stock >= 0 for r in rows.values())


def test_reorder_point_and_costs(costs):
    a = costs.where("item_id = 'a'").first()
    assert a.ROP == 38.9 and a.stockout_risk == 0 and a.DOH == 14.0
    assert a.total_annual_cost_naive == pytest.approx(1460 / 30 * 5 + (15 + 10.9) * 0.6)
    assert a.naive_annual_holding_cost == pytest.approx(15 * 3 * 0.2)  # no safety stock in this one
    assert a.naive_total_cost == pytest.approx(1460 / 30 * 5 + 9 + 2 * 3 * 0.3 * 12)
    assert a.optimized_total_cost == pytest.approx(a.total_annual_cost_EOQ + 2 * 3 * 0.3 * 0.02)
    assert costs.where("item_id = 'c'").first().stockout_risk == 1


def test_joined_stage_tables_give_the_same_fact(costs):
    key = ["item_id", "store_id"]
    joined = policy.join_policy(costs.drop("annual_saving", "annual_saving_pct", "best_model_used"), costs, costs.select(*key, "best_model_used"))
    plain = costs.select(*policy.INVENTORY_FACT)
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0


def test_newsvendor_only_perishables(costs):
    rows = {r.item_id: r for r in newsvendor.newsvendor(costs).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].CR == pytest.approx(0.75) and rows["a"].Q_star == 5.3  # 4 + 2 * 0.6745
    assert rows["b"].demand_std == 1.0 and rows["b"].Q_star == 0.7
    assert rows["a"].expected_leftover == pytest.approx(rows["a"].Q_star - rows["a"].expected_sales)


def _allocate(spark, items, budget):
    rows = [(n, "S1", "A", float(p), float(q)) for n, p, q in items]
    df = spark.createDataFrame(rows, "item_id string, store_id string, abc_class string, sell_price double, forecast_mean double")
    out = allocation.allocate(df, replace(DAILY_POLICY, budgets={"only": float(budget)}))
    return {r.item_id: r for r in out.collect()}


def test_allocation_edges(spark):
    items = [("a", 2, 10), ("b", 2, 5), ("c", 4, 10)]
    exact = _allocate(spark, items, 30)
    assert [exact[k].order_qty for k in "abc"] == [10, 5, 0]
    part = _allocate(spark, items, 50)
    assert part["c"].order_qty == pytest.approx(5)
    assert all(r.order_qty == 0 for r in _allocate(spark, items, 0).values())
    assert sum(r.order_qty for r in _allocate(spark, items, 10**6).values()) == 25


def test_allocation_beats_random_plans(spark):
    rng = random.Random(4)
    items = [(f"i{k:02d}", rng.randint(1, 20), rng.randint(0, 30)) for k in range(25)]
    budget = 900
    best = _allocate(spark, items, budget)
    filled, spent = sum(r.fulfilled for r in best.values()), sum(r.budget_spent for r in best.values())
    assert spent <= budget + 1e-6
    for _ in range(300):
        left, got = budget, 0.0
        for _, price, need in rng.sample(items, len(items)):
            q = min(need, left / price)
            left, got = left - q * price, got + q
        assert got <= filled + 1e-6


def test_prices_fall_back_to_category_then_overall(spark):
    rows = [("a", "F", 2.0), ("b", "F", 4.0), ("c", "F", None), ("d", "F", -1.0), ("e", "H", None), ("f", "K", 0.001)]
    base = _stats(spark, [(i, c, "A", 1.0, 1.0, p) for i, c, p in rows])
    got = {r.item_id: r.sell_price for r in selection.item_forecast_stats(base).collect()}
    # F's median runs over -1, 2 and 4, the overall one over -1, 0.001, 2 and 4.
    assert got == {"a": 2.0, "b": 4.0, "c": 2.0, "d": 2.0, "e": pytest.approx(1.0005), "f": 0.01}


def test_error_statistics(spark):
    import datetime as dt

    rows = [("one", 1, 5, 3.0), ("flat", 1, 2, 1.0), ("flat", 2, 2, 1.0), ("zero", 1, 0, 0.0), ("zero", 2, 0, 1.0)]
    df = spark.createDataFrame(
        [(i, "S", dt.date(2020, 1, d), a, f, "GBT") for i, d, a, f in rows],
        "item_id string, store_id string, date date, actual_units bigint, best_forecast double, best_model_used string",
    )
    got = {r.item_id: r for r in selection.error_stats(df).collect()}
    assert got["one"].forecast_error_std == 0.0 and got["one"].forecast_rmse == 2.0 and got["one"].forecast_bias == 2.0
    assert got["flat"].forecast_error_std == 0.0 and got["flat"].best_model_used == "GBT"
    assert got["zero"].cv_actual == 0.0


def test_best_forecast_order(spark):
    rows = [("a", "Z", 1.0, 2.0, 3.0), ("b", "Z", None, 2.0, 3.0), ("c", "X", 1.0, 2.0, 3.0), ("d", "X", 1.0, None, 3.0)]
    df = spark.createDataFrame(rows, "item_id string, xyz_class string, croston_forecast double, gbt_forecast double, seasonal_naive_forecast double")
    got = {r.item_id: (r.best_forecast, r.best_model_used) for r in selection.with_best_forecast(df).collect()}
    assert got == {"a": (1.0, "Croston_SBA"), "b": (2.0, "GBT"), "c": (2.0, "GBT"), "d": (3.0, "Seasonal_Naive")}


def test_accuracy_without_demand_has_no_mape(spark):
    df = spark.createDataFrame([("F", 0, 1.0), ("F", 0, 3.0), ("H", 2, 1.0)], "cat_id string, actual bigint, f double")
    got = {(r.Category, r.Metric): r.m for r in accuracy.accuracy_long(df, {"m": "f"}).collect()}
    assert got[("F", "MAPE")] is None and got[("H", "MAPE")] == 50.0
    assert got[("F", "Bias")] == 2.0 and got[("F", "MAE")] == 2.0 and got[("F", "RMSE")] == pytest.approx(5**0.5)
    wide = accuracy.to_wide(accuracy.accuracy_long(df, {"m": "f"}, ("RMSE", "MAE")), "m", "M")
    assert [r.MAPE for r in wide.collect()] == [None, None]
    shown = accuracy.metric_display(wide.withColumn("MAPE", F.when(F.col("Category") == "H", 12.345)))
    assert {r.Category: r.MAPE for r in shown.collect()} == {"F": "N/A (intermittent)", "H": "12.35"}


def test_quality_rules(spark):
    df = spark.createDataFrame([("a", None, -1.0), (None, 2, 3.0)], "name string, `a count` int, EOQ double")
    cleaned = quality.clean(df)
    assert cleaned.columns == ["name", "a_count", "EOQ"]
    assert [tuple(r) for r in quality.clip_negative(cleaned).collect()] == [("a", 0, 0.0), ("UNKNOWN", 2, 3.0)]
    nulls = {r.column_name: r.n_null for r in quality.null_counts(df, "t").collect()}
    assert nulls == {"name": 1, "a count": 1, "EOQ": 0}
    assert [r.n_clipped for r in quality.negative_counts(df, "t").collect()] == [1]
    check = quality.expectation("c", quality.count_of(df), spark.createDataFrame([(7,)], "n bigint"), tolerance=5).first()
    assert (check.expected, check.actual, check.ok) == (2, 7, 1)


def test_orphans_and_filters(spark):
    master = spark.createDataFrame([("a", "S1")], "item_id string, store_id string")
    other = spark.createDataFrame([("a", "S1"), ("x", "S9")], "item_id string, store_id string")
    got = sorted(tuple(r) for r in quality.orphan_ids({"t": other}, master, master.select("store_id")).collect())
    assert got == [("t", "unexpected_store", "S9"), ("t", "unknown_item", "x")]
    df = spark.createDataFrame([("A", "FOODS", 1), ("A", "FOODS", 0), ("C", "FOODS", 1)], "abc_class string, cat_id string, stockout_risk int")
    assert kpi.kpi_filter(df, ["A"]).count() == 2
    assert kpi.kpi_filter(df, risk="at-risk").count() == 2 and kpi.kpi_filter(df, risk="safe").count() == 1
    assert kpi.select_existing(df, ["abc_class", "nope"]).columns == ["abc_class"]
    assert kpi.rename_existing(df, {"cat_id": "category", "nope": "x"}).columns == ["abc_class", "category", "stockout_risk"]


def test_report_finds_planted_faults(spark):
    good = spark.createDataFrame([("a", "S1", 1.0), ("b", "S1", 2.0)], "item_id string, store_id string, EOQ double")
    bad = spark.createDataFrame([("a", "S1", -1.0), ("x", "S9", None)], "item_id string, store_id string, order_qty double")
    days = spark.createDataFrame([(n,) for n in range(9)], "date int")
    series = good.withColumns({"abc_class": F.lit("A"), "cat_id": F.lit("FOODS")})
    checks = quality.row_count_checks(series, series, series, series, days.limit(1), days, 2)
    failed = {r.check_name for r in checks.collect() if not r.ok}
    assert failed == {"allocation_is_scenarios_times_ab", "calendar_days"}
    orphans = quality.orphan_ids({"allocation": bad}, good, good.select("store_id"))
    got = {r.rule: r.findings for r in quality.report({"good": good, "allocation": bad}, checks, orphans).collect()}
    assert got == {"null_values": 1, "negative_values": 1, "column_names": 0, "row_counts": 2, "id_consistency": 2}


def test_risk_rank_breaks_ties_by_class(spark):
    df = spark.createDataFrame([("B", 1), ("B", 0), ("A", 1), ("A", 0), ("C", 1)], "abc_class string, stockout_risk int")
    got = {r.abc_class: r.risk_rank for r in kpi.risk_rank(df).collect()}
    assert got == {"C": 1, "A": 2, "B": 3}
