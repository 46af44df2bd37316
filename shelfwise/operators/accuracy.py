"""Forecast accuracy by category and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.scalars import fixed_text, tidy
from shelfwise.params import CATEGORIES

METRICS = ("RMSE", "MAE", "MAPE", "Bias")


def metric_columns(actual: str, forecast: str) -> dict[str, Column]:
    """Accuracy aggregates; MAPE uses rows with demand only, bias is forecast minus actual."""
    error = F.col(forecast) - F.col(actual)
    return {
        "RMSE": F.sqrt(F.avg(error * error)),
        "MAE": F.avg(F.abs(error)),
        "MAPE": F.avg(F.when(F.col(actual) > 0, F.abs(error) / F.col(actual))) * 100.0,
        "Bias": F.avg(error),
    }


def accuracy_long(df: DataFrame, models: dict[str, str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """Rows (Category, Metric, one column per model)."""
    names = list(models)
    aggs = [
        metric_columns("actual", models[m])[k].alias(f"{k}_{i}")
        for k in metrics
        for i, m in enumerate(names)
    ]
    rows = [
        F.struct(F.lit(k).alias("Metric"), *[F.col(f"{k}_{i}").alias(m) for i, m in enumerate(names)])
        for k in metrics
    ]
    return (
        df.groupBy(F.col("cat_id").alias("Category"))
        .agg(*aggs)
        .select("Category", F.explode(F.array(*rows)).alias("row"))
        .select("Category", "row.*")
    )


def to_wide(long: DataFrame, column: str, model: str) -> DataFrame:
    """Long metrics of one model to one row per category; an absent metric is NULL."""
    wide = long.groupBy("Category").pivot("Metric", list(METRICS)).agg(F.first(column))
    return wide.select("Category", F.lit(model).alias("Model"), *METRICS)


def model_comparison(parts: Sequence[DataFrame]) -> DataFrame:
    """All models under each other, rounded."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "Category", "Model", *[tidy(m, 4).alias(m) for m in METRICS]
    ).orderBy("Category", "Model")


def metric_display(comparison: DataFrame) -> DataFrame:
    """Comparison with MAPE as text; intermittent models have none."""
    text = F.when(F.col("MAPE").isNull(), F.lit("N/A (intermittent)")).otherwise(
        fixed_text(F.col("MAPE"), 2)
    )
    return comparison.withColumn("MAPE", text)


def improvement(base: Column, model: Column) -> Column:
    """Percent by which a model lowers an error."""
    return F.when(base > 0, (base - model) / base * 100.0)


def improvement_by_scope(df: DataFrame, base: str, model: str, categories=CATEGORIES) -> DataFrame:
    """RMSE improvement per category, pooled over all rows, and from the mean of category RMSEs.

    Pooled and mean-of-categories differ; both have been reported as "overall".
    """
    square = lambda c: (F.col(c) - F.col("actual")) * (F.col(c) - F.col("actual"))
    per_category = df.groupBy("cat_id").agg(
        F.sum(square(base)).alias("b"), F.sum(square(model)).alias("m"), F.count(F.lit(1)).alias("n")
    )
    rmse = lambda c: F.sqrt(F.col(c) / F.col("n"))
    by_category = per_category.where(F.col("cat_id").isin(*categories)).select(
        F.col("cat_id").alias("scope"), rmse("b").alias("base_rmse"), rmse("m").alias("model_rmse")
    )
    pooled = per_category.agg(F.sum("b").alias("b"), F.sum("m").alias("m"), F.sum("n").alias("n")).select(
        F.lit("POOLED").alias("scope"), rmse("b").alias("base_rmse"), rmse("m").alias("model_rmse")
    )
    averaged = by_category.agg(F.avg("base_rmse").alias("base_rmse"), F.avg("model_rmse").alias("model_rmse")).select(
        F.lit("MEAN_OF_CATEGORIES").alias("scope"), "base_rmse", "model_rmse"
    )
    rows = by_category.unionByName(pooled).unionByName(averaged)
    return rows.withColumn("improvement_pct", improvement(F.col("base_rmse"), F.col("model_rmse")))
