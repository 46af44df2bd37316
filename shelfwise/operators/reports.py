"""Analytical reports over the star schema and over the result facts.

A report on a period takes ``dim_date`` filtered to it; a fact that is split by year is then read in the years of the period only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions.scalars import cents, tidy
from shelfwise.operators.ingest import on_days


def _priced(fact_sales: DataFrame, dim_date: DataFrame, fact_prices: DataFrame) -> DataFrame:
    """Sales with the price of their week; days without a price drop out."""
    weeks = dim_date.select("date", "wm_yr_wk", "year", "month")
    return on_days(fact_sales, weeks).join(fact_prices, ["item_id", "store_id", "wm_yr_wk"])


def _revenue() -> Column:
    return F.sum(F.col("units_sold") * cents(F.col("sell_price")))


def _as_money(total: Column) -> Column:
    return tidy(total / 100.0, 2)


def sales_by_category_month(fact_sales, dim_date, dim_item, fact_prices) -> DataFrame:
    """Units and revenue by category, year and month."""
    # Reduce to item level first: the item join then sees far fewer rows than the fact.
    per_item = _priced(fact_sales, dim_date, fact_prices).groupBy("item_id", "year", "month").agg(
        F.sum("units_sold").alias("units"), _revenue().alias("revenue")
    )
    return (
        per_item.join(dim_item, "item_id")
        .groupBy("cat_id", "year", "month")
        .agg(F.sum("units").alias("total_units"), _as_money(F.sum("revenue")).alias("total_revenue"))
        .orderBy("cat_id", "year", "month")
    )


def zero_sales_percentage(fact_sales, n: int = 1000) -> DataFrame:
    """Series with the highest share of zero-sale days."""
    zero = F.sum((F.col("units_sold") == 0).cast("bigint"))
    return (
        fact_sales.groupBy("item_id", "store_id")
        .agg(F.count(F.lit(1)).alias("total_days"), zero.alias("zero_days"))
        .withColumn("zero_percentage", tidy(F.col("zero_days") * 100.0 / F.col("total_days"), 2))
        .orderBy(F.desc("zero_percentage"), "item_id", "store_id")
        .limit(n)
    )


def top_items_revenue(fact_sales, dim_date, dim_item, fact_prices, n: int = 20) -> DataFrame:
    """Items with the highest revenue; the mean price is weighted by days."""
    per_item = _priced(fact_sales, dim_date, fact_prices).groupBy("item_id").agg(
        F.sum("units_sold").alias("total_units"),
        tidy(F.avg(cents(F.col("sell_price"))) / 100.0, 2).alias("avg_price"),
        _as_money(_revenue()).alias("total_revenue"),
    )
    return (
        per_item.join(dim_item, "item_id")
        .select("item_id", "dept_id", "cat_id", "total_units", "avg_price", "total_revenue")
        .orderBy(F.desc("total_revenue"), "item_id")
        .limit(n)
    )


def _uplift(on_days: Column, off_days: Column) -> Column:
    return F.when(off_days != 0, 100.0 * (on_days - off_days) / off_days)


def snap_impact(
    fact_sales, dim_date, dim_item, dim_store, category: str = "FOODS", state: str = "CA", flag: str = "snap_CA"
) -> DataFrame:
    """Mean daily units on benefit days and other days by department, and the uplift."""
    days = dim_date.select("date", F.col(flag).alias("on_day"))
    sales = fact_sales.join(dim_store.where(F.col("state_id") == state), "store_id", "left_semi").join(
        dim_item.where(F.col("cat_id") == category).select("item_id", "dept_id"), "item_id"
    )
    sums = (
        on_days(sales, days)
        .groupBy("dept_id")
        .agg(
            F.avg(F.when(F.col("on_day") == 1, F.col("units_sold"))).alias("on_mean"),
            F.avg(F.when(F.col("on_day") == 0, F.col("units_sold"))).alias("off_mean"),
        )
    )
    return sums.select(
        "dept_id",
        tidy("on_mean", 4).alias("avg_sales_snap"),
        tidy("off_mean", 4).alias("avg_sales_nonsnap"),
        tidy(_uplift(F.col("on_mean"), F.col("off_mean")), 2).alias("pct_uplift"),
    ).orderBy("dept_id")


def price_trend(fact_prices, dim_date, dim_item) -> DataFrame:
    """Mean price by category and year with the change on the year before.

    Weeks are mapped to years by their distinct pairs, so a price counts once per week;
    a week across New Year counts in both years.
    """
    weeks = F.broadcast(dim_date.select("wm_yr_wk", "year").distinct())
    per_item = fact_prices.join(weeks, "wm_yr_wk").groupBy("item_id", "year").agg(
        F.sum(cents(F.col("sell_price"))).alias("price_sum"),
        F.count(F.lit(1)).alias("points"),
    )
    yearly = (
        per_item.join(dim_item, "item_id")
        .groupBy("cat_id", "year")
        .agg((F.sum("price_sum") / 100.0).alias("price_sum"), F.sum("points").alias("num_price_points"))
        .withColumn("avg_price", tidy(F.col("price_sum") / F.col("num_price_points"), 4))
    )
    before = F.lag("avg_price").over(Window.partitionBy("cat_id").orderBy("year"))
    return yearly.select(
        "cat_id",
        "year",
        "avg_price",
        "num_price_points",
        tidy(F.col("avg_price") - before, 4).alias("yoy_change"),
        tidy(100.0 * (F.col("avg_price") - before) / before, 2).alias("yoy_pct_change"),
    ).orderBy("cat_id", "year")


def forecast_mae_by_category(fact_forecasts, dim_item) -> DataFrame:
    """Mean absolute error of the chosen forecast by category."""
    per_item = fact_forecasts.groupBy("item_id").agg(
        F.sum("abs_error").alias("err"), F.count(F.lit(1)).alias("rows")
    )
    return (
        per_item.join(dim_item, "item_id")
        .groupBy(F.col("cat_id").alias("category"))
        .agg((F.sum("err") / F.sum("rows")).alias("mean_abs_error"), F.sum("rows").alias("n"))
        .orderBy(F.desc("mean_abs_error"), "category")
    )


def forecast_count_by_segment(fact_forecasts) -> DataFrame:
    """Forecast rows per segment."""
    return fact_forecasts.groupBy("abc_xyz").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "abc_xyz"
    )


def worst_series(fact_forecasts, n: int = 10) -> DataFrame:
    """Series with the highest mean absolute error."""
    return (
        fact_forecasts.groupBy("item_id", "store_id")
        .agg(F.avg("abs_error").alias("avg_error"))
        .orderBy(F.desc("avg_error"), "item_id", "store_id")
        .limit(n)
    )


def policy_avg_by_abc(policy) -> DataFrame:
    """Mean policy figures by revenue class."""
    mean = lambda c: tidy(F.avg(c), 2)
    return policy.groupBy("abc_class").agg(
        mean("safety_stock").alias("avg_safety_stock"),
        mean("ROP").alias("avg_ROP"),
        mean("turnover").alias("avg_turnover"),
        mean("annual_saving_pct").alias("avg_saving_pct"),
    ).orderBy("abc_class")


def risk_by_category(policy) -> DataFrame:
    """Share of series at stockout risk by category."""
    return policy.groupBy("cat_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        F.sum("stockout_risk").alias("items_at_risk"),
        tidy(100.0 * F.sum("stockout_risk") / F.count(F.lit(1)), 1).alias("pct_at_risk"),
    )


def cost_by_category(policy) -> DataFrame:
    """Naive and optimised cost by category.

    The saving is measured against a baseline with stockout cost and divided by one
    without it, as the figures have always been reported.
    """
    return policy.groupBy("cat_id").agg(
        tidy(F.sum("total_annual_cost_naive"), 2).alias("naive_total"),
        tidy(F.sum("total_annual_cost_EOQ"), 2).alias("optimized_total"),
        tidy(F.sum("annual_saving"), 2).alias("total_saving"),
        tidy(100.0 * F.sum("annual_saving") / F.sum("total_annual_cost_naive"), 1).alias("saving_pct"),
    )


def newsvendor_summary(fact_newsvendor) -> DataFrame:
    """Mean order sizes and profit gain of the newsvendor against EOQ."""
    base = F.abs("expected_profit_eoq")
    gain = F.when(base != 0, 100.0 * F.col("profit_improvement") / base)
    return fact_newsvendor.agg(
        tidy(F.avg("Q_star"), 2).alias("avg_newsvendor_qty"),
        tidy(F.avg("EOQ"), 2).alias("avg_eoq_qty"),
        tidy(F.avg("profit_improvement"), 4).alias("avg_profit_improvement"),
        tidy(F.avg(gain), 1).alias("avg_profit_improvement_pct"),
    )


def fill_rate_by_scenario(fact_allocation) -> DataFrame:
    """Fill rate and spend of each budget."""
    demand = F.sum("demand_mean")
    return fact_allocation.groupBy("scenario").agg(
        tidy(F.when(demand > 0, F.sum("fulfilled") / demand * 100.0), 1).alias("fill_rate_pct"),
        tidy(F.sum("budget_spent"), 2).alias("total_spent"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table: (table_name, rows)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
