"""Yearly cost of a naive and the optimised policy, and the result facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import clip_low, ratio, tidy
from shelfwise.operators.inventory import service_level
from shelfwise.params import DAILY_POLICY, PolicyParams


def with_policy_cost(policy: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Both policies with stockout cost. The naive holding cost has no safety stock here."""
    loss = F.col("forecast_error_std") * F.col("sell_price") * params.margin_rate
    price = clip_low(F.col("sell_price"), 0.01)
    parts = policy.withColumn("sell_price", price).withColumns(
        {
            "naive_order_frequency": F.col("D_annual") / params.naive_lot,
            "naive_annual_ordering_cost": F.col("D_annual") / params.naive_lot * params.order_cost,
            "naive_annual_holding_cost": F.col("sell_price") * (params.naive_lot / 2) * params.holding_rate,
            "naive_stockout_cost": loss * params.stockouts_per_year,
            "optimized_stockout_cost": loss * (1 - F.col("service_level")),
        }
    )
    naive = F.col("naive_annual_ordering_cost") + F.col("naive_annual_holding_cost") + F.col("naive_stockout_cost")
    totals = parts.withColumns(
        {
            "naive_total_cost": naive,
            "optimized_total_cost": F.col("total_annual_cost_EOQ") + F.col("optimized_stockout_cost"),
        }
    )
    saving = F.col("naive_total_cost") - F.col("optimized_total_cost")
    return totals.withColumns(
        {"annual_saving": saving, "annual_saving_pct": ratio(saving * 100, F.col("naive_total_cost"), 0.0)}
    )


def policy_rollup(costs: DataFrame, by: str) -> DataFrame:
    """Cost of both policies, saving and reduction per group."""
    naive, saving = F.sum("naive_total_cost"), F.sum("annual_saving")
    return costs.groupBy(by).agg(
        tidy(naive, 2).alias("naive_cost"),
        tidy(F.sum("optimized_total_cost"), 2).alias("optimized_cost"),
        tidy(saving, 2).alias("total_saving"),
        tidy(F.avg("annual_saving_pct"), 2).alias("avg_saving_pct"),
        tidy(ratio(100.0 * saving, naive), 2).alias("pct_reduction"),
    )


# Component name, naive column, optimised column.
COMPONENTS = (
    ("ordering", "naive_annual_ordering_cost", "annual_ordering_cost"),
    ("holding", "naive_annual_holding_cost", "annual_holding_cost"),
    ("stockout", "naive_stockout_cost", "optimized_stockout_cost"),
)


def policy_components(costs: DataFrame) -> DataFrame:
    """Cost by category and component under both policies; the change is naive minus optimised."""
    sums = costs.groupBy("cat_id").agg(
        *[F.sum(n).alias(f"{c}_naive") for c, n, _ in COMPONENTS],
        *[F.sum(o).alias(f"{c}_best") for c, _, o in COMPONENTS],
    )
    rows = [
        F.struct(
            F.lit(c).alias("component"),
            tidy(f"{c}_naive", 2).alias("naive_cost"),
            tidy(f"{c}_best", 2).alias("optimized_cost"),
            tidy(F.col(f"{c}_naive") - F.col(f"{c}_best"), 2).alias("reduction"),
        )
        for c, _, _ in COMPONENTS
    ]
    return sums.select("cat_id", F.explode(F.array(*rows)).alias("row")).select("cat_id", "row.*")


def policy_drivers(costs: DataFrame) -> DataFrame:
    """Stockout cost avoided against holding cost added, over all series."""
    cut = F.sum("naive_stockout_cost") - F.sum("optimized_stockout_cost")
    rise = F.sum("annual_holding_cost") - F.sum("naive_annual_holding_cost")
    return costs.agg(
        tidy(cut, 2).alias("stockout_reduction"),
        tidy(rise, 2).alias("holding_increase"),
        tidy(cut - rise, 2).alias("net_saving"),
    )


def target_fill_rate(costs: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Mean target service level against the assumed fill rate of the naive policy."""
    return costs.agg(
        F.lit(params.naive_fill_pct).alias("naive_fill_pct"),
        tidy(100.0 * F.avg(service_level(params)), 4).alias("optimized_fill_pct"),
    )


# Columns of the three result facts.
INVENTORY_FACT = (
    "item_id", "store_id", "cat_id", "dept_id", "state_id", "abc_class", "xyz_class", "abc_xyz",
    "sell_price", "forecast_mean", "forecast_error_std", "service_level", "Z_score", "sigma_L",
    "safety_stock", "ss_holding_cost", "EOQ", "ROP", "demand_during_lead_time", "stockout_risk",
    "DOH", "turnover", "annual_ordering_cost", "annual_holding_cost", "total_annual_cost_EOQ",
    "total_annual_cost_naive", "annual_saving", "annual_saving_pct", "best_model_used",
)
NEWSVENDOR_FACT = (
    "item_id", "store_id", "cat_id", "sell_price", "Cu", "Co", "CR", "forecast_mean", "demand_std",
    "Q_star", "EOQ", "expected_profit_newsvendor", "expected_profit_eoq", "profit_improvement",
)
ALLOCATION_FACT = (
    "item_id", "store_id", "abc_class", "scenario", "order_qty", "fulfilled", "demand_mean",
    "sell_price", "budget_spent",
)


def join_policy(reorder: DataFrame, costs: DataFrame, models: DataFrame) -> DataFrame:
    """Inventory fact from separately stored stage tables.

    The cost table's naive cost is preferred where it has one.
    """
    key = ["item_id", "store_id"]
    right = costs.select(
        *key, "annual_saving", "annual_saving_pct", F.col("total_annual_cost_naive").alias("naive_from_costs")
    )
    base = reorder.drop("annual_saving", "annual_saving_pct", "best_model_used")
    return (
        base.join(right, key, "left")
        .join(models.select(*key, "best_model_used"), key, "left")
        .withColumn("total_annual_cost_naive", F.coalesce("naive_from_costs", "total_annual_cost_naive"))
        .select(*INVENTORY_FACT)
    )
