"""One JSON document with the headline figures of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.scalars import tidy
from shelfwise.operators import kpi
from shelfwise.params import PolicyParams


def _map_of(df: DataFrame, key: str, value: Column) -> Column:
    """Grouped aggregate as a map value (classes or categories, so a few entries)."""
    grouped = df.groupBy(key).agg(value.alias("value"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(key), F.col("value"))))
    return grouped.agg(F.map_from_entries(pairs).alias("m")).scalar()


def _section(df: DataFrame) -> Column:
    return df.select(F.struct("*").alias("s")).scalar()


def summary_document(
    dashboard: DataFrame,
    costs: DataFrame,
    newsvendor: DataFrame,
    training: DataFrame,
    comparison: DataFrame,
    improvement: DataFrame,
    insight: DataFrame,
    params: PolicyParams,
    tree_metrics: DataFrame,
    tree_improvement: DataFrame,
) -> DataFrame:
    """Seven sections as nested structs, rendered to one JSON string."""
    dataset = dashboard.agg(
        F.count(F.lit(1)).alias("total_item_store_combinations"),
        F.countDistinct("item_id").alias("total_unique_items"),
        F.countDistinct("store_id").alias("n_stores"),
        F.sort_array(F.collect_set("cat_id")).alias("category_names"),
    )
    coverage = kpi.croston_coverage(dashboard)
    totals = costs.agg(
        tidy(F.sum("naive_total_cost"), 2).alias("total_naive_annual_cost"),
        tidy(F.sum("optimized_total_cost"), 2).alias("total_optimized_annual_cost"),
        tidy(F.sum("annual_saving"), 2).alias("total_annual_saving"),
        tidy(100.0 * F.sum("annual_saving") / F.sum("naive_total_cost"), 1).alias("pct_cost_reduction"),
        tidy(F.sum("ss_holding_cost"), 2).alias("total_annual_ss_holding_cost"),
        tidy(F.sum("total_annual_cost_naive"), 2).alias("order_size_naive_cost"),
        tidy(F.sum("total_annual_cost_EOQ"), 2).alias("order_size_optimized_cost"),
        tidy(100.0 * (1 - F.sum("total_annual_cost_EOQ") / F.sum("total_annual_cost_naive")), 1).alias("order_size_pct_reduction"),
    )
    vendor = newsvendor.agg(
        F.count(F.lit(1)).alias("n_item_store_combinations"),
        tidy(F.avg("CR"), 4).alias("avg_critical_ratio"),
        tidy(F.avg("Q_star"), 2).alias("avg_q_star"),
        tidy(F.sum("profit_improvement"), 2).alias("total_expected_profit_improvement"),
    )
    mean = lambda c: tidy(F.avg(c), 2)
    inventory = F.struct(
        _map_of(dashboard, "abc_class", mean("safety_stock")).alias("avg_safety_stock_by_abc"),
        _map_of(dashboard, "cat_id", mean("EOQ")).alias("avg_eoq_by_category"),
        _map_of(dashboard, "cat_id", mean("DOH")).alias("avg_doh_by_category"),
        _map_of(dashboard, "cat_id", mean("turnover")).alias("avg_turnover_by_category"),
        _section(kpi.at_risk(dashboard)).alias("risk"),
    )
    rmse = {
        model: _map_of(comparison.where(F.col("Model") == model), "Category", F.first("RMSE"))
        for model in ("Seasonal Naive", "ETS", "Croston SBA (Z-class)")
    }
    tree_rmse = tree_metrics.where(F.col("Metric") == "RMSE")
    forecasting = F.struct(
        rmse["Seasonal Naive"].alias("seasonal_naive_rmse_by_category"),
        rmse["ETS"].alias("ets_rmse_by_category"),
        rmse["Croston SBA (Z-class)"].alias("croston_rmse_by_category"),
        _map_of(tree_rmse, "Category", tidy(F.first("GBT"), 4)).alias("trees_rmse_by_category"),
        _map_of(tree_improvement, "scope", tidy(F.first("improvement_pct"), 1)).alias("trees_pct_improvement"),
        _map_of(improvement, "scope", tidy(F.first("improvement_pct"), 1)).alias("croston_pct_improvement"),
        _section(coverage).alias("coverage"),
    )
    cost = F.struct(
        _section(totals).alias("totals"),
        _map_of(costs, "cat_id", tidy(F.sum("annual_saving"), 2)).alias("saving_by_category"),
        _section(kpi.cost_reduction(dashboard)).alias("reduction"),
    )
    assumptions = F.struct(
        F.lit(params.holding_rate).alias("holding_cost_rate"),
        F.lit(params.order_cost).alias("ordering_cost"),
        F.lit(params.lead_time).alias("lead_time"),
        F.lit(params.margin_rate).alias("margin_rate"),
        F.lit(params.disposal_rate).alias("disposal_cost_rate"),
    )
    document = F.struct(
        _section(dataset).alias("dataset"),
        _section(training).alias("training"),
        forecasting.alias("forecasting"),
        inventory.alias("inventory"),
        cost.alias("cost_comparison"),
        _section(vendor).alias("newsvendor"),
        _section(insight).alias("key_insight"),
        assumptions.alias("cost_assumptions"),
    )
    one_row = dashboard.agg(F.count(F.lit(1)).alias("n"))
    return one_row.select(F.to_json(document).alias("document"))


def summary_values(
    dashboard: DataFrame, costs: DataFrame, newsvendor: DataFrame, comparison: DataFrame, improvement: DataFrame
) -> DataFrame:
    """Rows (section, key, value) of the document's figures that need no trees."""

    def rows(df: DataFrame, section: str, key: Column, value: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), key.cast("string").alias("key"), value.cast("double").alias("value"))

    def figures(df: DataFrame, section: str, values: dict[str, Column]) -> DataFrame:
        sums = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
        pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in values]))
        return sums.select(F.lit(section).alias("section"), pairs.alias("e")).select("section", "e.key", "e.value")

    def grouped(df: DataFrame, section: str, by: str, value: Column) -> DataFrame:
        return rows(df.groupBy(by).agg(value.alias("value")), section, F.col(by), F.col("value"))

    total = lambda c: tidy(F.sum(c), 2)
    share = lambda top, bottom: tidy(100.0 * (1 - F.sum(top) / F.sum(bottom)), 1)
    parts = [
        figures(costs, "cost_totals", {
            "naive": total("naive_total_cost"), "optimized": total("optimized_total_cost"), "saving": total("annual_saving"),
            "pct_reduction": tidy(100.0 * F.sum("annual_saving") / F.sum("naive_total_cost"), 1), "safety_stock_holding": total("ss_holding_cost"),
        }),
        figures(costs, "order_size_only", {
            "naive": total("total_annual_cost_naive"), "optimized": total("total_annual_cost_EOQ"),
            "pct_reduction": share("total_annual_cost_EOQ", "total_annual_cost_naive"),
        }),
        figures(newsvendor, "newsvendor", {
            "n_series": F.count(F.lit(1)), "mean_critical_ratio": tidy(F.avg("CR"), 4), "mean_order": tidy(F.avg("Q_star"), 2), "gain": total("profit_improvement"),
        }),
        grouped(costs, "saving_by_category", "cat_id", total("annual_saving")),
        grouped(dashboard, "safety_stock_by_class", "abc_class", tidy(F.avg("safety_stock"), 2)),
        *[grouped(dashboard, f"{c}_by_category", "cat_id", tidy(F.avg(c), 2)) for c in ("EOQ", "DOH", "turnover")],
        rows(comparison, "rmse", F.concat_ws(" / ", "Model", "Category"), F.col("RMSE")),
        rows(improvement, "croston_improvement", F.col("scope"), tidy(F.col("improvement_pct"), 1)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
