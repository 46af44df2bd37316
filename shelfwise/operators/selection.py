"""Joining model forecasts, choosing the best one, and its error statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.scalars import clip_low
from shelfwise.operators.ingest import attach_labels
from shelfwise.operators.ordering import median_by_counts

_ROW = ["item_id", "store_id", "date"]
_KEY = ["item_id", "store_id"]
MODELS = ("Croston_SBA", "GBT", "Seasonal_Naive")


def forecast_wide(base: DataFrame, croston: DataFrame | None = None, trees: DataFrame | None = None) -> DataFrame:
    """All models side by side on the baseline rows; a model that was not run is NULL."""
    out = base.select(*_ROW, F.col("actual").alias("actual_units"), "seasonal_naive_forecast", "ets_forecast")
    for frame, column, name in (
        (croston, "croston_sba_forecast", "croston_forecast"),
        (trees, "gbt_forecast", "gbt_forecast"),
    ):
        if frame is None:
            out = out.withColumn(name, F.lit(None).cast("double"))
        else:
            out = out.join(frame.select(*_ROW, F.col(column).alias(name)), _ROW, "left")
    return out


def _use_croston() -> Column:
    return (F.col("xyz_class") == "Z") & F.col("croston_forecast").isNotNull()


def with_best_forecast(labelled: DataFrame) -> DataFrame:
    """Croston for intermittent series, else boosted trees, else seasonal naive."""
    other = F.coalesce("gbt_forecast", "seasonal_naive_forecast")
    model = F.when(F.col("gbt_forecast").isNotNull(), "GBT").otherwise("Seasonal_Naive")
    return labelled.withColumn(
        "best_forecast", F.when(_use_croston(), F.col("croston_forecast")).otherwise(other)
    ).withColumn("best_model_used", F.when(_use_croston(), "Croston_SBA").otherwise(model))


def fact_forecasts(best: DataFrame) -> DataFrame:
    """Forecast fact: models, choice, signed error (forecast minus actual) and classes."""
    return best.select(
        *_ROW,
        "actual_units",
        "seasonal_naive_forecast",
        "ets_forecast",
        "croston_forecast",
        "gbt_forecast",
        "best_forecast",
        (F.col("best_forecast") - F.col("actual_units")).alias("forecast_error"),
        F.abs(F.col("best_forecast") - F.col("actual_units")).alias("abs_error"),
        "abc_class",
        "xyz_class",
        "abc_xyz",
    )


def error_stats(best: DataFrame) -> DataFrame:
    """Residual statistics per series; the residual is actual minus forecast.

    Deviations are sample deviations, zero for a single row.
    """
    actual = F.col("actual_units").cast("double")
    residual = actual - F.col("best_forecast")
    spread = lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0))
    # The first row's model, carried as its number: fixed-width buffers aggregate by hash.
    first_model = F.min_by(F.array_position(F.array(*map(F.lit, MODELS)), F.col("best_model_used")), "date")
    sums = best.groupBy(*_KEY).agg(
        F.avg("best_forecast").alias("forecast_mean"),
        F.avg(actual).alias("actual_mean"),
        F.avg(residual).alias("forecast_bias"),
        spread(residual).alias("forecast_error_std"),
        F.sqrt(F.avg(residual * residual)).alias("forecast_rmse"),
        F.when(F.avg(actual) > 0, spread(actual) / F.avg(actual)).otherwise(0.0).alias("cv_actual"),
        first_model.alias("model_no"),
    )
    name = F.element_at(F.array(*map(F.lit, MODELS)), F.col("model_no").cast("int"))
    return sums.withColumn("best_model_used", name).drop("model_no")


def median_price(fact_prices: DataFrame, stores: list[str] | None = None) -> DataFrame:
    """Median price per series over all its weeks, optionally for some stores only."""
    prices = fact_prices if stores is None else fact_prices.where(F.col("store_id").isin(*stores))
    # One row per week and series, so the exact median buffers a bounded list.
    return prices.groupBy(*_KEY).agg(F.median("sell_price").alias("sell_price"))


def attach_price(
    stats: DataFrame, labels: DataFrame, fact_prices: DataFrame, dim_item: DataFrame, dim_store: DataFrame
) -> DataFrame:
    """Error statistics with classes, hierarchy and the series' median price, which may be NULL."""
    priced = stats.join(median_price(fact_prices), _KEY, "left")
    return attach_labels(priced, labels).join(dim_item, "item_id", "left").join(dim_store, "store_id", "left")


def item_forecast_stats(priced: DataFrame) -> DataFrame:
    """Statistics with a usable price. ``priced`` is read three times, so pass a stored table.

    A missing or non-positive price takes the category median, then the overall median
    (both over the series' prices as they are), and never falls below 0.01.
    """
    by_category = median_by_counts(priced, ["cat_id"], "sell_price", "category_price")
    overall = median_by_counts(priced, [], "sell_price", "overall_price").select("overall_price").scalar()
    usable = F.when(F.col("sell_price") > 0, F.col("sell_price"))
    return (
        priced.join(by_category, "cat_id", "left")
        .withColumn("sell_price", clip_low(F.coalesce(usable, F.col("category_price"), overall), 0.01))
        .select(
            *_KEY,
            "cat_id",
            "dept_id",
            "state_id",
            "abc_class",
            "xyz_class",
            "abc_xyz",
            "forecast_mean",
            "actual_mean",
            "forecast_bias",
            "forecast_error_std",
            "forecast_rmse",
            "cv_actual",
            "sell_price",
            "best_model_used",
        )
    )
