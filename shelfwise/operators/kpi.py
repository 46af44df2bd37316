"""Dashboard figures: small aggregates over the cleaned extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.scalars import ratio, tidy, tidy_even
from shelfwise.params import ABC_CLASSES, CATEGORIES

# Columns of the item table.
ITEM_TABLE = (
    "item_id", "cat_id", "dept_id", "abc_class", "xyz_class", "safety_stock", "EOQ", "ROP", "DOH",
    "turnover", "stockout_risk", "sell_price", "forecast_mean",
)


def _rows():
    return F.count(F.lit(1))


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns, skipping those the frame does not have."""
    return df.select(*[c for c in columns if c in df.columns])


def rename_existing(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns where the old name is present and the new one is not."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns and b not in df.columns})


def kpi_filter(
    df: DataFrame, abc: Sequence[str] = ABC_CLASSES, categories: Sequence[str] = CATEGORIES, risk: str = "all"
) -> DataFrame:
    """Dashboard selection; ``risk`` is all, at-risk or safe."""
    out = df.where(F.col("abc_class").isin(*abc) & F.col("cat_id").isin(*categories))
    if risk == "at-risk":
        return out.where(F.col("stockout_risk") == 1)
    if risk == "safe":
        return out.where(F.col("stockout_risk") == 0)
    return out


def _cost_sums(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("total_annual_cost_naive").alias("naive"),
        F.sum("total_annual_cost_EOQ").alias("best"),
        F.sum("annual_saving").alias("saving"),
    )


def cost_reduction(df: DataFrame) -> DataFrame:
    """Reduction by order sizes alone, and by the whole policy with stockout cost."""
    naive, best, saving = F.col("naive"), F.col("best"), F.col("saving")
    percent = lambda top, bottom: tidy(F.when(bottom != 0, top / bottom * 100).otherwise(0.0), 4)
    return _cost_sums(df).select(
        percent(naive - best, naive).alias("eoq_only_pct"), percent(saving, saving + best).alias("total_policy_pct")
    )


def executive(df: DataFrame) -> DataFrame:
    """Series, saving and stockout risk."""
    return df.agg(
        _rows().alias("n_items"),
        tidy(F.sum("annual_saving"), 2).alias("total_saving"),
        F.sum((F.col("stockout_risk") == 1).cast("bigint")).alias("at_risk"),
        tidy(100.0 * F.avg((F.col("stockout_risk") == 1).cast("double")), 4).alias("at_risk_pct"),
    )


def cost_by_category(df: DataFrame) -> DataFrame:
    """Cost of both policies by category."""
    return df.groupBy("cat_id").agg(
        tidy(F.sum("total_annual_cost_naive"), 2).alias("Naive_Cost"),
        tidy(F.sum("total_annual_cost_EOQ"), 2).alias("Optimized_Cost"),
    )


def safety_stock_by_abc(df: DataFrame) -> DataFrame:
    """Mean buffer and order size by class."""
    return df.groupBy("abc_class").agg(
        tidy(F.avg("safety_stock"), 4).alias("Avg_Safety_Stock"), tidy(F.avg("EOQ"), 4).alias("Avg_EOQ")
    )


def segment_counts(df: DataFrame) -> DataFrame:
    """Series per segment, fewest first."""
    return df.groupBy("abc_xyz").agg(_rows().alias("count")).orderBy("count", "abc_xyz")


def policy_means(df: DataFrame) -> DataFrame:
    """Mean buffer, order size, reorder point and turnover."""
    return df.agg(
        *[
            tidy(F.avg(c), 4).alias(n)
            for c, n in (("safety_stock", "avg_ss"), ("EOQ", "avg_eoq"), ("ROP", "avg_rop"), ("turnover", "avg_turnover"))
        ]
    )


def category_abc(df: DataFrame) -> DataFrame:
    """Mean buffer and turnover by category and class."""
    return df.groupBy("cat_id", "abc_class").agg(
        tidy(F.avg("safety_stock"), 4).alias("Avg_SS"), tidy(F.avg("turnover"), 4).alias("Avg_Turnover")
    )


def item_table(df: DataFrame) -> DataFrame:
    """Policy per item with numbers rounded to two places."""
    picked = select_existing(df, ITEM_TABLE)
    return picked.withColumns({c: tidy_even(c, 2) for c, t in picked.dtypes if t == "double"})


def at_risk(df: DataFrame) -> DataFrame:
    """Size of the risk group, its high-revenue part and its mean days on hand."""
    risky = F.col("stockout_risk") == 1
    return df.agg(
        F.sum(risky.cast("bigint")).alias("n_at_risk"),
        F.sum((~risky).cast("bigint")).alias("n_safe"),
        tidy(100.0 * F.avg(risky.cast("double")), 4).alias("pct_at_risk"),
        F.sum((risky & (F.col("abc_class") == "A")).cast("bigint")).alias("a_class_at_risk"),
        tidy(F.coalesce(F.avg(F.when(risky, F.col("DOH"))), F.lit(0.0)), 4).alias("avg_doh_at_risk"),
    )


def a_class_priority(df: DataFrame) -> DataFrame:
    """All high-revenue series at risk, shortest cover first, rounded to two places."""
    risky = df.where((F.col("abc_class") == "A") & (F.col("stockout_risk") == 1))
    ordered = risky.orderBy("DOH", "item_id", "store_id")
    picked = select_existing(ordered, ("item_id", "store_id", "cat_id", "safety_stock", "ROP", "DOH", "EOQ", "sell_price", "forecast_mean"))
    return picked.withColumns({c: tidy_even(c, 2) for c, t in picked.dtypes if t == "double"})


def risk_by_abc(df: DataFrame) -> DataFrame:
    """Risk share by class, A first."""
    return df.groupBy("abc_class").agg(
        F.sum("stockout_risk").alias("At_Risk"),
        F.count("stockout_risk").alias("Total"),
        tidy(100.0 * F.avg("stockout_risk"), 4).alias("Risk_Pct"),
    ).orderBy("abc_class")


def risk_rank(df: DataFrame) -> DataFrame:
    """Classes ranked by risk share, ties in class order (three rows)."""
    ranks = Window.partitionBy(F.lit(0)).orderBy(F.desc("Risk_Pct"), "abc_class")
    return risk_by_abc(df).select("abc_class", "Risk_Pct", F.row_number().over(ranks).alias("risk_rank"))


def risk_by_category(df: DataFrame) -> DataFrame:
    """Series at risk by category, fewest first."""
    return df.groupBy("cat_id").agg(F.sum("stockout_risk").alias("At_Risk"), _rows().alias("Total")).orderBy(
        "At_Risk", "cat_id"
    )


def saving_by_category(df: DataFrame) -> DataFrame:
    """Saving by category."""
    return df.groupBy("cat_id").agg(tidy(F.sum("annual_saving"), 2).alias("Total_Saving"))


def cost_summary(df: DataFrame) -> DataFrame:
    """Costs and saving by category; the share is of saving plus remaining cost."""
    sums = df.groupBy("cat_id").agg(
        tidy(F.sum("total_annual_cost_naive"), 2).alias("Naive_Cost"),
        tidy(F.sum("total_annual_cost_EOQ"), 2).alias("Optimized_Cost"),
        tidy(F.sum("annual_saving"), 2).alias("Total_Saving"),
        tidy(F.avg("annual_saving_pct"), 2).alias("Avg_Saving_Pct"),
    )
    share = ratio(F.col("Total_Saving") * 100, F.col("Total_Saving") + F.col("Optimized_Cost"))
    return sums.withColumn("Saving_Pct", tidy(share, 1))


def scenarios(allocation: DataFrame) -> DataFrame:
    """Demand, served units, spend and rows per budget."""
    sums = allocation.groupBy("scenario").agg(
        F.sum("demand_mean").alias("demand"),
        F.sum("fulfilled").alias("filled"),
        F.sum("budget_spent").alias("spend"),
        F.count("item_id").alias("Items"),
    )
    return sums.select(
        "scenario",
        tidy("demand", 2).alias("Total_Demand"),
        tidy("filled", 2).alias("Total_Fulfilled"),
        tidy("spend", 2).alias("Total_Spent"),
        "Items",
        tidy(ratio(F.col("filled") * 100, F.col("demand")), 1).alias("Fill_Rate_Pct"),
    )


def _with_error(df: DataFrame, detail: DataFrame) -> DataFrame:
    errors = detail.select("item_id", "store_id", "forecast_error_std")
    joined = df if "forecast_error_std" in df.columns else df.join(errors, ["item_id", "store_id"], "left")
    return joined.dropna(subset=["forecast_error_std", "safety_stock"])


def error_slope(df: DataFrame, detail: DataFrame) -> DataFrame:
    """Least-squares slope of safety stock on forecast error."""
    fit = F.regr_slope(F.col("safety_stock"), F.col("forecast_error_std"))
    return _with_error(df, detail).agg(_rows().alias("n"), tidy(fit, 6).alias("slope"))


def error_trend(df: DataFrame, detail: DataFrame) -> DataFrame:
    """Least-squares line of safety stock on forecast error, per class."""
    y, x = F.col("safety_stock"), F.col("forecast_error_std")
    return _with_error(df, detail).groupBy("abc_class").agg(
        _rows().alias("n"),
        tidy(F.regr_slope(y, x), 6).alias("slope"),
        tidy(F.regr_intercept(y, x), 6).alias("intercept"),
    )


def error_vs_raw(safety: DataFrame, lead_time: int, z: float) -> DataFrame:
    """Mean A-class buffer sized on forecast error against one sized on raw demand."""
    raw = F.col("cv_actual") * F.col("actual_mean") * z * float(lead_time) ** 0.5
    means = safety.where(F.col("abc_class") == "A").agg(
        tidy(F.avg("safety_stock"), 2).alias("forecast_error_stock"), tidy(F.avg(raw), 2).alias("raw_demand_stock")
    )
    gain = (F.col("raw_demand_stock") - F.col("forecast_error_stock")) * 100.0
    return means.withColumn("reduction_pct", tidy(ratio(gain, F.col("raw_demand_stock"), 0.0), 1))


def inventory_stats(df: DataFrame) -> DataFrame:
    """Counts and means by class and category in long form: (section, member, value)."""
    def means(section: str, by: str, column: str) -> DataFrame:
        return df.groupBy(F.col(by).alias("member")).agg(tidy(F.avg(column), 2).alias("value")).select(
            F.lit(section).alias("section"), "member", "value"
        )

    totals = df.agg(
        F.count("safety_stock").cast("double").alias("n_with_safety_stock"),
        tidy(100.0 * F.avg("stockout_risk"), 1).alias("pct_items_stockout_risk"),
        F.sum(((F.col("abc_class") == "A") & (F.col("stockout_risk") == 1)).cast("double")).alias("n_a_class_at_stockout_risk"),
    )
    names = totals.columns
    flat = totals.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("section"), F.lit("ALL").alias("member"), F.col(n).alias("value")) for n in names])).alias("r")
    ).select("r.*")
    return (
        flat.unionByName(means("avg_safety_stock_by_abc", "abc_class", "safety_stock"))
        .unionByName(means("avg_eoq_by_category", "cat_id", "EOQ"))
        .unionByName(means("avg_doh_by_category", "cat_id", "DOH"))
        .unionByName(means("avg_turnover_by_category", "cat_id", "turnover"))
    )


def croston_coverage(df: DataFrame) -> DataFrame:
    """Intermittent series, and series forecast by a Croston model (any letter case)."""
    uses = F.lower(F.col("best_model_used")).contains("croston")
    return df.agg(
        F.sum((F.col("xyz_class") == "Z").cast("bigint")).alias("n_zclass"), F.sum(uses.cast("bigint")).alias("n_croston")
    )


def training_range(dim_date: DataFrame, n_days: int) -> DataFrame:
    """First and last date of the first n calendar days, by their ``d_n`` label."""
    number = F.substring_index("d", "_", -1).cast("int")
    return dim_date.where(number.between(1, n_days)).agg(
        F.min("date").alias("training_start"), F.max("date").alias("training_end"), _rows().alias("n_days")
    )
