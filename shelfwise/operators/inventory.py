"""Safety stock, order quantity and reorder point: column arithmetic on one row per series.

The whole chain is a single stage; only the summaries at the end shuffle.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import clip_low, lookup, ratio, tidy
from shelfwise.params import DAILY_POLICY, PolicyParams

SENSITIVITY_LEVELS = (90, 95, 98)


def service_level(params: PolicyParams = DAILY_POLICY):
    """Service level of the row's revenue class."""
    return lookup(F.col("abc_class"), params.service_levels, params.default_service_level)


def _z_table(params: PolicyParams) -> dict[str, float]:
    return {c: NormalDist().inv_cdf(v) for c, v in params.service_levels.items()}


def with_safety_stock(stats: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Buffer against forecast error over the lead time, with cost at three service levels."""
    normal = NormalDist()
    z = lookup(F.col("abc_class"), _z_table(params), normal.inv_cdf(params.default_service_level))
    sigma = F.col("forecast_error_std") * math.sqrt(params.lead_time)
    stock = lambda score: F.bround(clip_low(score * F.col("sigma_L"), 0.0), 1)
    cost = lambda name: F.col(name) * F.col("sell_price") * params.holding_rate
    scores = {f"_{v}": F.lit(normal.inv_cdf(v / 100)) for v in SENSITIVITY_LEVELS}
    scores[""] = F.col("Z_score")
    levels = stats.withColumns({"service_level": service_level(params), "Z_score": z, "sigma_L": sigma})
    stocked = levels.withColumns({f"safety_stock{k}": stock(score) for k, score in scores.items()})
    return stocked.withColumns(
        {("ss_cost" + k if k else "ss_holding_cost"): cost(f"safety_stock{k}") for k in scores}
    )


def with_eoq(safety: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Economic order quantity; at least one unit, and one unit where nothing is forecast."""
    unit_cost = clip_low(F.col("sell_price"), 0.01) * params.holding_rate
    raw = F.sqrt(
        F.when(F.col("D_annual") > 0, 2.0 * F.col("D_annual") * params.order_cost).otherwise(0.0)
        / clip_low(F.col("holding_cost_per_unit"), 0.01)
    )
    based = safety.withColumns(
        {
            "D_annual": F.col("forecast_mean") * params.periods_per_year,
            "sell_price": clip_low(F.col("sell_price"), 0.01),
            "holding_cost_per_unit": unit_cost,
        }
    )
    return based.withColumn(
        "EOQ", F.when(F.col("D_annual") <= 0, 1.0).otherwise(clip_low(F.bround(raw, 0), 1.0))
    )


def with_eoq_cost(eoq: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Yearly cost under EOQ and under a fixed lot; both hold the safety stock."""
    lot = params.naive_lot
    hold = lambda q: (q / 2 + F.col("safety_stock")) * F.col("holding_cost_per_unit")
    order = lambda q: F.col("D_annual") / q * params.order_cost
    total = lambda suffix: F.col(f"annual_ordering_cost{suffix}") + F.col(f"annual_holding_cost{suffix}")
    parts = eoq.withColumns(
        {
            "annual_ordering_cost": order(F.col("EOQ")),
            "annual_holding_cost": hold(F.col("EOQ")),
            "annual_ordering_cost_naive": order(F.lit(lot)),
            "annual_holding_cost_naive": hold(F.lit(lot)),
        }
    )
    totals = parts.withColumns({"total_annual_cost_EOQ": total(""), "total_annual_cost_naive": total("_naive")})
    saving = F.col("total_annual_cost_naive") - F.col("total_annual_cost_EOQ")
    return totals.withColumns(
        {
            "cost_saving_vs_naive": saving,
            "cost_saving_pct": ratio(saving * 100, F.col("total_annual_cost_naive"), 0.0),
        }
    )


def with_reorder_point(costed: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Reorder point, stockout risk of a plain cover rule, days on hand and turnover."""
    mean = F.col("forecast_mean")
    stocked = costed.withColumns(
        {
            "demand_during_lead_time": mean * params.lead_time,
            "ROP": F.bround(mean * params.lead_time + F.col("safety_stock"), 1),
            "naive_current_stock": mean * params.cover_periods,
            "turnover": F.col("D_annual") / clip_low(F.col("EOQ") / 2 + F.col("safety_stock"), 0.01),
        }
    )
    return stocked.withColumns(
        {
            "stockout_risk": (F.col("naive_current_stock") < F.col("ROP")).cast("int"),
            "DOH": ratio(F.col("naive_current_stock"), mean, 999.0),
        }
    )


def inventory_policy(stats: DataFrame, params: PolicyParams = DAILY_POLICY) -> DataFrame:
    """Statistics per series to the complete reorder frame."""
    safety = with_safety_stock(stats, params)
    return with_reorder_point(with_eoq_cost(with_eoq(safety, params), params), params)


def safety_stock_rollups(safety: DataFrame) -> DataFrame:
    """Mean buffer by class and category, and what the service level costs in total."""
    parts = []
    for dim in ("abc_class", "cat_id"):
        parts.append(
            safety.groupBy(F.lit(dim).alias("dimension"), F.col(dim).alias("member")).agg(
                tidy(F.avg("safety_stock"), 2).alias("avg_safety_stock"), *_cost_totals()
            )
        )
    total = safety.agg(tidy(F.avg("safety_stock"), 2).alias("avg_safety_stock"), *_cost_totals()).select(
        F.lit("all").alias("dimension"), F.lit("ALL").alias("member"), "*"
    )
    rows = parts[0].unionByName(parts[1]).unionByName(total)
    extra = F.col("cost_98") - F.col("cost_90")
    return rows.withColumn("extra_cost", tidy(extra, 2)).withColumn(
        "extra_pct", tidy(ratio(100.0 * extra, F.col("cost_90")), 1)
    ).withColumns({c: tidy(c, 2) for c in ("holding_cost", "cost_90", "cost_98")})


def _cost_totals():
    return [
        F.sum("ss_holding_cost").alias("holding_cost"),
        F.sum("ss_cost_90").alias("cost_90"),
        F.sum("ss_cost_98").alias("cost_98"),
    ]


def service_level_curve(safety: DataFrame) -> DataFrame:
    """Total buffer cost by category and service level, and the rise over the lowest level."""
    sums = safety.groupBy("cat_id").agg(
        *[F.sum(f"ss_cost_{v}").alias(f"c{v}") for v in SENSITIVITY_LEVELS],
        *[F.sum(f"safety_stock_{v}").alias(f"s{v}") for v in SENSITIVITY_LEVELS],
    )
    lowest = F.col(f"c{SENSITIVITY_LEVELS[0]}")
    points = [
        F.struct(
            F.lit(v).alias("service_level"),
            tidy(f"s{v}", 2).alias("safety_stock"),
            tidy(f"c{v}", 2).alias("holding_cost"),
            tidy(F.col(f"c{v}") - lowest, 2).alias("extra_cost"),
        )
        for v in SENSITIVITY_LEVELS
    ]
    return sums.select("cat_id", F.explode(F.array(*points)).alias("point")).select("cat_id", "point.*")


def eoq_by_category(costed: DataFrame) -> DataFrame:
    """Mean order size and cost of both policies by category."""
    naive, best = F.sum("total_annual_cost_naive"), F.sum("total_annual_cost_EOQ")
    return costed.groupBy("cat_id").agg(
        tidy(F.avg("EOQ"), 2).alias("avg_eoq"),
        tidy(naive, 2).alias("naive_cost"),
        tidy(best, 2).alias("eoq_cost"),
        tidy(naive - best, 2).alias("saving"),
        tidy(ratio(100.0 * (naive - best), naive), 1).alias("saving_pct"),
    )


def eoq_sensitivity(
    costed: DataFrame, n: int = 3, points: int = 400, params: PolicyParams = DAILY_POLICY
) -> DataFrame:
    """Cost curve over order sizes from 1 to three times EOQ for the n largest savers."""
    top = costed.orderBy(F.desc("cost_saving_vs_naive"), "item_id", "store_id").limit(n)
    grid = top.select(
        "item_id", "store_id", "D_annual", "holding_cost_per_unit", "EOQ",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("step"),
    )
    q = 1.0 + (3.0 * F.col("EOQ") - 1.0) * F.col("step") / (points - 1)
    ordering, holding = F.col("D_annual") / F.col("q") * params.order_cost, F.col("q") / 2.0 * F.col("holding_cost_per_unit")
    return grid.withColumn("q", q).select(
        "item_id", "store_id", "step", "q", ordering.alias("ordering_cost"), holding.alias("holding_cost"),
        (ordering + holding).alias("total_cost"),
    )


def largest(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n rows with the largest value; ties follow the series key."""
    return df.orderBy(F.desc(column), "item_id", "store_id").limit(n)


def stockout_risk_by_abc(policy: DataFrame) -> DataFrame:
    """Series at risk by revenue class."""
    return policy.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum("stockout_risk").alias("at_risk"),
        tidy(100.0 * F.sum("stockout_risk") / F.count(F.lit(1)), 1).alias("pct_at_risk"),
    )


def doh_turnover_by_category(policy: DataFrame) -> DataFrame:
    """Mean days on hand and turnover by category."""
    return policy.groupBy("cat_id").agg(
        tidy(F.avg("DOH"), 2).alias("avg_doh"), tidy(F.avg("turnover"), 2).alias("avg_turnover")
    )


def a_class_at_risk(policy: DataFrame, n: int = 10) -> DataFrame:
    """High-revenue series at risk, largest demand first."""
    return largest(
        policy.where((F.col("abc_class") == "A") & (F.col("stockout_risk") == 1)), "forecast_mean", n
    ).select("item_id", "store_id", "cat_id", "forecast_mean", "naive_current_stock", "ROP", "DOH")
