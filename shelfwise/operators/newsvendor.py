"""Single-period order quantity for perishables under normal demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.normal import norm_cdf, norm_ppf
from shelfwise.functions.scalars import clip_low, ratio, tidy
from shelfwise.params import DAILY_POLICY, PERISHABLE_CATEGORY, PolicyParams


def with_order_quantity(
    policy: DataFrame, params: PolicyParams = DAILY_POLICY, category: str = PERISHABLE_CATEGORY
) -> DataFrame:
    """Critical ratio and optimal order of one category, with the difference to EOQ."""
    return (
        policy.where(F.col("cat_id") == category)
        .withColumn("sell_price", clip_low(F.col("sell_price"), 0.01))
        .withColumn("Cu", F.col("sell_price") * params.margin_rate)
        .withColumn("Co", F.col("sell_price") * params.disposal_rate)
        .withColumn("CR", F.col("Cu") / (F.col("Cu") + F.col("Co")))
        .withColumn("demand_std", clip_low(F.col("forecast_error_std"), 1.0))
        .withColumn(
            "Q_star",
            F.bround(clip_low(norm_ppf(F.col("CR"), F.col("forecast_mean"), F.col("demand_std")), 0.0), 1),
        )
        .withColumn("q_difference", F.col("Q_star") - F.col("EOQ"))
        .withColumn("q_difference_pct", ratio(F.col("q_difference") * 100, F.col("EOQ"), 0.0))
    )


def expected_sales(q: Column, mean: Column, sd: Column) -> Column:
    """Mean demand when demand stays below the order, the order otherwise.

    This weighting is kept as defined; it is not the truncated-normal expectation.
    """
    below = norm_cdf(q, mean, sd)
    return mean * below + q * (1.0 - below)


def with_profit(orders: DataFrame) -> DataFrame:
    """Expected sales, leftover, shortage and profit at the optimum and at EOQ."""
    mean, sd = F.col("forecast_mean"), F.col("demand_std")
    profit = lambda sold, q: sold * F.col("Cu") - (q - sold) * F.col("Co")
    base = F.abs("expected_profit_eoq")
    return (
        orders.withColumn("expected_sales", expected_sales(F.col("Q_star"), mean, sd))
        .withColumn("expected_leftover", F.col("Q_star") - F.col("expected_sales"))
        .withColumn("expected_stockout", mean - F.col("expected_sales"))
        .withColumn("expected_profit_newsvendor", profit(F.col("expected_sales"), F.col("Q_star")))
        .withColumn("eoq_sales", expected_sales(F.col("EOQ"), mean, sd))
        .withColumn("expected_profit_eoq", profit(F.col("eoq_sales"), F.col("EOQ")))
        .drop("eoq_sales")
        .withColumn("profit_improvement", F.col("expected_profit_newsvendor") - F.col("expected_profit_eoq"))
        .withColumn("profit_improvement_pct", ratio(F.col("profit_improvement") * 100, base, 0.0))
    )


# Columns of the newsvendor result.
OUTPUT = (
    "item_id", "store_id", "cat_id", "dept_id", "abc_class", "sell_price", "Cu", "Co", "CR",
    "forecast_mean", "demand_std", "Q_star", "EOQ", "q_difference", "q_difference_pct",
    "expected_sales", "expected_leftover", "expected_stockout", "expected_profit_newsvendor",
    "expected_profit_eoq", "profit_improvement", "profit_improvement_pct",
)


def newsvendor(policy: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """All newsvendor figures per perishable series."""
    return with_profit(with_order_quantity(policy, params)).select(*OUTPUT)


def newsvendor_rollup(orders: DataFrame) -> DataFrame:
    """Averages, total gain, and how often the order is below or above EOQ."""
    share = lambda cond: tidy(100.0 * F.avg(cond.cast("double")), 1)
    return orders.agg(
        tidy(F.avg("CR"), 4).alias("avg_cr"),
        tidy(F.avg("Q_star"), 2).alias("avg_q_star"),
        tidy(F.avg("EOQ"), 2).alias("avg_eoq"),
        tidy(F.sum("profit_improvement"), 2).alias("total_gain"),
        share(F.col("Q_star") < F.col("EOQ")).alias("pct_less"),
        share(F.col("Q_star") > F.col("EOQ")).alias("pct_more"),
    )
