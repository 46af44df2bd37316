"""Leakage-safe model features. Panels are dense, so a row lag is a time lag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.scalars import calendar_parts, flag, own_state_flag
from shelfwise.params import DAY, TimeGrain

ENCODED = ("item_id", "store_id", "dept_id", "cat_id", "state_id")


def _series():
    # A series holds one row per period, so its window is bounded by the calendar.
    return Window.partitionBy("item_id", "store_id").orderBy("date")


def with_lags(panel: DataFrame, grain: TimeGrain = DAY) -> DataFrame:
    """Demand n periods ago, for each lag of the grain."""
    return panel.withColumns({f"lag_{n}": F.lag("units_sold", n).over(_series()) for n in grain.lags})


def with_rolling(lagged: DataFrame, grain: TimeGrain = DAY) -> DataFrame:
    """Rolling mean and sample deviation of the shortest lag; one value has no deviation.

    A frame of n rows is the difference of two running sums, so the cost per row does not
    grow with n. Units are whole numbers, hence the sums and differences are exact.
    """
    base = F.col(f"lag_{grain.lags[0]}").cast("bigint")
    upto = _series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {"run_n": F.count(base), "run_s": F.sum(base), "run_q": F.sum(base * base)}
    summed = lagged.withColumns({k: F.coalesce(v.over(upto), F.lit(0)) for k, v in running.items()})
    out = {}
    for width in grain.rolling:
        n, s, q = (F.col(k) - F.lag(k, width, 0).over(_series()) for k in running)
        out[f"roll_mean_{width}"] = F.when(n > 0, s / n)
        out[f"roll_std_{width}"] = F.when(n > 1, F.sqrt((n * q - s * s) / (n * (n - 1))))
    return summed.withColumns(out).drop(*running)


def with_price_vs_mean(df: DataFrame) -> DataFrame:
    """Price against the mean price of the series."""
    mean = F.avg("sell_price").over(Window.partitionBy("item_id", "store_id"))
    return df.withColumn("price_vs_mean", F.col("sell_price") / mean)


def price_steps(fact_prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Weekly prices with the change on the calendar week before, NULL when that had no price.

    Done at the weekly grain, on the price table alone, so daily rows meet it in the one
    price join they need anyway.
    """
    ordered = Window.partitionBy(F.lit(0)).orderBy("wm_yr_wk")  # one row per calendar week
    weeks = calendar.select("wm_yr_wk").distinct().withColumn("week_before", F.lag("wm_yr_wk").over(ordered))
    series = Window.partitionBy("item_id", "store_id").orderBy("wm_yr_wk")
    change = F.col("sell_price") - F.lag("sell_price").over(series)
    return fact_prices.join(F.broadcast(weeks), "wm_yr_wk").select(
        "item_id",
        "store_id",
        "wm_yr_wk",
        "sell_price",
        F.when(F.lag("wm_yr_wk").over(series) == F.col("week_before"), change).alias("price_change"),
    )


def with_calendar_features(df: DataFrame) -> DataFrame:
    """Date parts, event flag and the own state's benefit-day flag."""
    parts = calendar_parts(F.col("date"))
    wanted = ("day_of_week", "week_of_year", "month", "year", "is_weekend")
    return df.withColumns(
        {
            **{p: parts[p] for p in wanted},
            "is_event": flag(F.col("event_name_1").isNotNull()),
            "is_snap": own_state_flag(F.col("state_id")),
        }
    )


def prepare(sales_long: DataFrame, series: DataFrame) -> DataFrame:
    """Daily rows with classes, codes and calendar features; an unknown price change counts as zero.

    ``series`` has one row per series with all that is attached to it, so daily rows need one join.
    """
    known = sales_long.withColumn("price_change", F.coalesce("price_change", F.lit(0.0)))
    return with_calendar_features(known.join(series, ["item_id", "store_id"], "left"))


def coded_dimension(dim: DataFrame, codes: DataFrame) -> DataFrame:
    """Dimension keys with the codes of all text columns of the dimension."""
    key = dim.columns[0]
    out = dim
    for c in dim.columns:
        mapping = codes.where(F.col("column_name") == c).select(F.col("label").alias(c), F.col("code").alias(f"{c}_enc"))
        out = out.join(mapping, c, "left")
    return out.select(key, *[f"{c}_enc" for c in dim.columns])


def coded_series(labels: DataFrame, item_codes: DataFrame, store_codes: DataFrame) -> DataFrame:
    """Classes and all codes per series."""
    series = labels.select("item_id", "store_id", "abc_class", "xyz_class", "abc_xyz")
    return series.join(item_codes, "item_id", "left").join(store_codes, "store_id", "left")


def feature_columns(grain: TimeGrain = DAY) -> list[str]:
    """Model inputs in order."""
    return (
        [f"lag_{n}" for n in grain.lags]
        + [f"roll_mean_{n}" for n in grain.rolling]
        + [f"roll_std_{n}" for n in grain.rolling]
        + ["sell_price", "price_change", "price_vs_mean"]
        + ["day_of_week", "week_of_year", "month", "year", "is_weekend", "is_event", "is_snap"]
        + [f"{c}_enc" for c in ENCODED]
    )


def model_features(prepared: DataFrame, grain: TimeGrain = DAY) -> DataFrame:
    """Keys, target, category, classes and all inputs; rows without a full lag history are dropped.

    Only what a window or a model needs passes the windows.
    """
    made = {*[f"lag_{n}" for n in grain.lags], *[f"roll_{k}_{n}" for k in ("mean", "std") for n in grain.rolling], "price_vs_mean"}
    keep = ["item_id", "store_id", "date", "units_sold", "cat_id", "abc_xyz"]
    narrow = prepared.select(*keep, *[c for c in feature_columns(grain) if c not in made])
    built = with_price_vs_mean(with_rolling(with_lags(narrow, grain), grain))
    return built.dropna(subset=[f"lag_{n}" for n in grain.lags]).select(*keep, *feature_columns(grain))


def last_mean(train: DataFrame, n: int) -> DataFrame:
    """Mean demand of the last n periods of each series."""
    newest_first = Window.partitionBy("item_id", "store_id").orderBy(F.desc("date"))
    return (
        train.withColumn("age", F.row_number().over(newest_first))
        .where(F.col("age") <= n)
        .groupBy("item_id", "store_id")
        .agg(F.avg("units_sold").alias("last_mean"))
    )
