"""Exploratory statistics over the long sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import calendar_parts, tidy
from shelfwise.operators.ordering import median_by_counts
from shelfwise.params import CATEGORIES

# Segments each forecasting method is meant for.
METHOD_SEGMENTS = {
    "Boosted trees (stable, high-value)": ("AX", "BX", "AY", "BY"),
    "ETS baseline (low-value)": ("CX", "CY"),
    "Croston/SBA (intermittent demand)": ("AZ", "BZ", "CZ"),
}
# Description, forecasting model and stock policy per segment.
SEGMENT_METHODS = (
    ("AX", "High value, stable", "Boosted trees", "EOQ + SS (98%)"),
    ("AY", "High value, variable", "Boosted trees", "EOQ + SS (98%)"),
    ("BX", "Med value, stable", "Boosted trees", "EOQ + SS (95%)"),
    ("BY", "Med value, variable", "Boosted trees", "EOQ + SS (95%)"),
    ("CX", "Low value, stable", "ETS Baseline", "EOQ + SS (90%)"),
    ("CY", "Low value, variable", "ETS Baseline", "EOQ + SS (90%)"),
    ("AZ", "High value, intermittent", "Croston SBA", "Newsvendor (if FOODS)"),
    ("BZ", "Med value, intermittent", "Croston SBA", "Newsvendor (if FOODS)"),
    ("CZ", "Low value, intermittent", "Croston SBA", "Simple ROP"),
)


def basic_stats(sales_long: DataFrame) -> DataFrame:
    """Count, mean, exact median, population deviation, maximum and zero share by category."""
    units = F.col("units_sold")
    moments = sales_long.groupBy("cat_id").agg(
        F.count(F.lit(1)).alias("count"),
        tidy(F.avg(units), 4).alias("mean"),
        tidy(F.stddev_pop(units.cast("double")), 4).alias("std"),
        F.max(units).alias("max"),
        tidy(100.0 * F.avg((units == 0).cast("double")), 2).alias("pct_zero"),
    )
    medians = median_by_counts(sales_long, ["cat_id"], "units_sold", "median")
    return moments.join(medians, "cat_id").select(
        F.col("cat_id").alias("category"), "count", "mean", "median", "std", "max", "pct_zero"
    )


def dataset_overview(sales_long: DataFrame) -> DataFrame:
    """Distinct items and stores, date range, rows and share of zero rows."""
    per_series = sales_long.groupBy("item_id", "store_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum((F.col("units_sold") == 0).cast("bigint")).alias("zeros"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
    )
    return per_series.agg(
        F.countDistinct("item_id").alias("n_items"),
        F.countDistinct("store_id").alias("n_stores"),
        F.min("first").alias("date_min"),
        F.max("last").alias("date_max"),
        F.sum("rows").alias("total_records"),
        tidy(100.0 * F.sum("zeros") / F.sum("rows"), 2).alias("pct_zero"),
    )


def zero_share(sales_long: DataFrame) -> DataFrame:
    """Percentage of zero-sale days per series."""
    return sales_long.groupBy("item_id", "store_id").agg(
        (100.0 * F.sum((F.col("units_sold") == 0).cast("bigint")) / F.count(F.lit(1))).alias("zero_pct")
    )


def zero_share_over(sales_long: DataFrame, limit: float = 40.0) -> DataFrame:
    """Share of series whose zero percentage exceeds the limit."""
    over = (F.col("zero_pct") > limit).cast("double")
    return zero_share(sales_long).agg(
        F.count(F.lit(1)).alias("n_pairs"), tidy(100.0 * F.avg(over), 2).alias("pct_over_limit")
    )


def zero_share_hist(sales_long: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width histogram of the zero percentage, empty bins included."""
    shares = zero_share(sales_long)
    span = shares.agg(F.min("zero_pct").alias("low"), F.max("zero_pct").alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    width = high - low
    at = F.when(width > 0, F.floor((F.col("zero_pct") - low) / width * bins)).otherwise(0)
    counts = shares.groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n_pairs")
    )
    edges = span.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", (F.col("high") - F.col("low")).alias("width")
    )
    return edges.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        tidy(F.col("low") + F.col("width") * F.col("bin") / bins, 6).alias("bin_start"),
        F.coalesce("n_pairs", F.lit(0).cast("bigint")).alias("n_pairs"),
    )


def seasonality(sales_long: DataFrame, part: str, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Mean units per calendar part and category, categories across."""
    key = "dow" if part == "day_of_week" else part
    return (
        sales_long.groupBy(calendar_parts(F.col("date"))[part].alias(key))
        .pivot("cat_id", list(categories))
        .agg(tidy(F.avg("units_sold"), 6))
        .orderBy(key)
    )


def snap_lift_overall(sales_long: DataFrame, category: str = "FOODS", state: str = "CA") -> DataFrame:
    """Mean units on benefit days and other days for one category in one state."""
    picked = sales_long.where((F.col("cat_id") == category) & (F.col("state_id") == state))
    means = picked.agg(
        F.avg(F.when(F.col("snap_CA") == 0, F.col("units_sold"))).alias("off"),
        F.avg(F.when(F.col("snap_CA") == 1, F.col("units_sold"))).alias("on"),
    )
    return means.select(
        tidy("off", 4).alias("avg_non_snap"),
        tidy("on", 4).alias("avg_snap"),
        tidy(F.when(F.col("off") != 0, 100.0 * (F.col("on") - F.col("off")) / F.col("off")), 2).alias(
            "uplift_pct"
        ),
    )


def method_assignment(labels: DataFrame) -> DataFrame:
    """Series per forecasting method."""
    counts = labels.agg(
        *[
            F.coalesce(F.sum(F.col("abc_xyz").isin(*cells).cast("bigint")), F.lit(0)).alias(f"m{i}")
            for i, cells in enumerate(METHOD_SEGMENTS.values())
        ]
    )
    rows = [
        F.struct(
            F.lit(method).alias("method"), F.lit(", ".join(cells)).alias("segments"), F.col(f"m{i}").alias("n_series")
        )
        for i, (method, cells) in enumerate(METHOD_SEGMENTS.items())
    ]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def segment_methods(labels: DataFrame) -> DataFrame:
    """Each series with the description, model and policy of its segment."""
    table = labels.sparkSession.createDataFrame(
        list(SEGMENT_METHODS), "abc_xyz string, description string, forecasting_model string, inventory_policy string"
    )
    return labels.select("item_id", "store_id", "abc_xyz").join(F.broadcast(table), "abc_xyz", "left")


def bias_summary(stats: DataFrame) -> DataFrame:
    """How many series are under-forecast on average, and how many use each model."""
    under = (F.col("forecast_bias") > 0).cast("bigint")
    used = lambda model: F.sum((F.col("best_model_used") == model).cast("bigint"))
    return stats.agg(
        F.count(F.lit(1)).alias("n_series"),
        F.sum(under).alias("n_under_forecast"),
        tidy(100.0 * F.avg(under), 1).alias("pct_under_forecast"),
        used("Croston_SBA").alias("n_croston"),
        used("GBT").alias("n_trees"),
        used("Seasonal_Naive").alias("n_naive"),
    )


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, non-null count, least and greatest value of every column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs += [
            F.count(F.col(c)).alias(f"f{i}"),
            F.min(F.col(c)).cast("string").alias(f"a{i}"),
            F.max(F.col(c)).cast("string").alias(f"b{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(dict(df.dtypes)[c]).alias("data_type"),
            F.col("n").alias("n_rows"),
            F.col(f"f{i}").alias("n_known"),
            F.col(f"a{i}").alias("least"),
            F.col(f"b{i}").alias("greatest"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("row")).select("row.*")
