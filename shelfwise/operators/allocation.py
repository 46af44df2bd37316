"""Order quantities under a shared budget.

Maximise the demand served, the sum of min(order, demand), when the spend may not exceed
a budget. With a single budget this is a fractional knapsack whose items all have value
one per unit, so filling by ascending price is an exact optimum, and the one that spends
least. The running spend is a distributed prefix sum, computed once for all budgets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import clip_low, ratio, tidy
from shelfwise.operators.ordering import running_total
from shelfwise.params import DAILY_POLICY, PolicyParams


def allocate(policy: DataFrame, params: PolicyParams = DAILY_POLICY, store_id: str | None = None) -> DataFrame:
    """Orders of the A and B series in every budget scenario, optionally for one store."""
    chosen = policy.where(F.col("abc_class").isin("A", "B"))
    if store_id is not None:
        chosen = chosen.where(F.col("store_id") == store_id)
    priced = chosen.select(
        "item_id",
        "store_id",
        "abc_class",
        clip_low(F.col("sell_price"), 0.01).alias("sell_price"),
        F.col("forecast_mean").alias("demand_mean"),
    ).withColumn("full_cost", F.round(F.col("demand_mean") * F.col("sell_price"), 6).cast("decimal(24,6)"))
    order = [F.asc("sell_price"), F.asc("item_id"), F.asc("store_id")]
    ranked = running_total(priced, order, "full_cost", "spent_upto")
    cost_before = (F.col("spent_upto") - F.col("full_cost")).cast("double")
    scenarios = F.array(
        *[F.struct(F.lit(n).alias("scenario"), F.lit(b).alias("budget")) for n, b in params.budgets.items()]
    )
    left = F.col("budget") - F.col("cost_before")
    quantity = F.when(left <= 0, 0.0).otherwise(F.least(F.col("demand_mean"), left / F.col("sell_price")))
    return (
        ranked.withColumn("cost_before", cost_before)
        .select("*", F.explode(scenarios).alias("s"))
        .select("*", "s.*")
        .withColumn("order_qty", quantity)
        .select(
            "item_id",
            "store_id",
            "abc_class",
            "scenario",
            "budget",
            "order_qty",
            F.col("order_qty").alias("fulfilled"),
            "demand_mean",
            "sell_price",
            (F.col("order_qty") * F.col("sell_price")).alias("budget_spent"),
        )
    )


def budget_scenarios(allocation: DataFrame) -> DataFrame:
    """Fill rate, series ordered and mean order per budget, and what 10,000 more would add.

    The marginal figure compares each budget with the next lower one.
    """
    from pyspark.sql import Window

    ordered = F.col("order_qty") > 1e-6
    sums = allocation.groupBy("scenario", "budget").agg(
        ratio(F.sum("fulfilled") * 100.0, F.sum("demand_mean"), 0.0).alias("fill"),
        F.sum(ordered.cast("bigint")).alias("items_ordered"),
        F.coalesce(F.avg(F.when(ordered, F.col("order_qty"))), F.lit(0.0)).alias("avg_order"),
        F.sum("budget_spent").alias("spent"),
    )
    by_budget = Window.partitionBy(F.lit(0)).orderBy("budget")  # one row per scenario
    step = (F.col("fill") - F.lag("fill").over(by_budget)) / (
        (F.col("budget") - F.lag("budget").over(by_budget)) / 10_000.0
    )
    return sums.select(
        "scenario",
        "budget",
        tidy("fill", 4).alias("fill_rate_pct"),
        "items_ordered",
        tidy("avg_order", 4).alias("avg_order_qty"),
        tidy("spent", 2).alias("total_spent"),
        tidy(step, 4).alias("marginal_fill_per_10k"),
    )
