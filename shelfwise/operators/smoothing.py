"""Holt-Winters exponential smoothing with additive trend and season.

Every series is fitted on the same grid of smoothing parameters and keeps the point with
the least squared one-step error. Spark spreads the series over tasks; inside a task the
recursion runs over time once, vectorised over a batch of series and the whole grid.
"""

from __future__ import annotations

import datetime as dt
import itertools
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import clip_low
from shelfwise.params import DAY, TimeGrain

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEVEL_GRID = (0.05, 0.2, 0.5)
TREND_GRID = (0.0, 0.02, 0.1)
SEASON_GRID = (0.05, 0.2, 0.4)


def fit_batch(y: np.ndarray, grid: np.ndarray, season: int, horizon: int) -> np.ndarray:
    """Forecasts of equally long series ``y[series, time]`` over ``grid[point, 3]``."""
    n, length = y.shape
    a, b, g = (grid[:, i][None, :] for i in range(3))
    first, second = y[:, :season].mean(axis=1), y[:, season : 2 * season].mean(axis=1)
    shape = (n, len(grid))
    level = np.broadcast_to(first[:, None], shape).copy()
    trend = np.broadcast_to(((second - first) / season)[:, None], shape).copy()
    wave = np.repeat((y[:, :season] - first[:, None])[:, :, None], len(grid), axis=2)
    error = np.zeros(shape)
    for t in range(season, length):
        s = wave[:, t % season, :]
        now = y[:, t][:, None]
        error += (now - (level + trend + s)) ** 2
        raised = a * (now - s) + (1 - a) * (level + trend)
        trend = b * (raised - level) + (1 - b) * trend
        wave[:, t % season, :] = g * (now - raised) + (1 - g) * s
        level = raised
    best = error.argmin(axis=1)
    rows = np.arange(n)
    ahead = np.arange(1, horizon + 1)
    seasonal = wave[rows, :, best][:, (length + ahead - 1) % season]
    return level[rows, best][:, None] + trend[rows, best][:, None] * ahead + seasonal


def ets_forecast(
    train: DataFrame,
    val: DataFrame,
    labels: DataFrame,
    cutoff: dt.date,
    grain: TimeGrain = DAY,
    classes: Sequence[str] = ("A", "B"),
) -> DataFrame:
    """Smoothing forecasts of the A and B series, by position among the validation dates.

    Uses the most recent periods only. Too short a history gives no row; a value that is
    not finite falls back to the mean of the last periods.
    """
    key = ["item_id", "store_id"]
    grid = np.array(list(itertools.product(LEVEL_GRID, TREND_GRID, SEASON_GRID)))
    season, horizon, tail = grain.season, grain.horizon, grain.tail

    def fit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            out = np.empty(len(series), dtype=object)
            lengths = series.map(len).to_numpy()
            for length in np.unique(lengths):  # dense panels have one length
                at = np.flatnonzero(lengths == length)
                y = np.stack(series.iloc[at].to_list()).astype(float)
                ahead = fit_batch(y, grid, season, horizon)
                flat = y[:, -tail:].mean(axis=1)[:, None]
                broken = ~np.isfinite(ahead).all(axis=1)[:, None]
                for row, values in zip(at, np.clip(np.where(broken, flat, ahead), 0, None)):
                    out[row] = values
            yield pd.Series(out)

    fit_udf = F.pandas_udf(fit, "array<double>")
    since = cutoff - dt.timedelta(days=grain.recent * grain.days - 1)
    chosen = labels.where(F.col("abc_class").isin(*classes)).select(*key)
    recent = train.where(F.col("date") >= F.lit(since)).join(chosen, key, "left_semi")
    # At most `recent` values per series, so a collected list is bounded.
    histories = recent.groupBy(*key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("date", "units_sold"))), lambda r: r["units_sold"].cast("double")).alias("y")
    )
    fitted = histories.where(F.size("y") >= 2 * season).select(*key, fit_udf("y").alias("ahead"))
    # Periods are dated by their first day, which for the first one is the day after the cutoff.
    step = F.floor((F.datediff("date", F.lit(cutoff)) - 1) / grain.days + 1).cast("int")
    return (
        val.select(*key, "date", step.alias("step"))
        .join(fitted, key)
        .select(*key, "date", clip_low(F.get(F.col("ahead"), F.col("step") - 1), 0.0).alias("ets_forecast"))
    )


def fill_gaps(val: DataFrame, naive: DataFrame, ets: DataFrame | None = None) -> DataFrame:
    """Baseline frame: actual, seasonal naive, and smoothing with the naive in its gaps."""
    key = ["item_id", "store_id", "date"]
    base = val.select(*key, "cat_id", F.col("units_sold").alias("actual")).join(naive, key, "left")
    if ets is None:
        base = base.withColumn("ets_forecast", F.lit(None).cast("double"))
    else:
        base = base.join(ets, key, "left")
    return base.withColumn(
        "ets_forecast", clip_low(F.coalesce("ets_forecast", "seasonal_naive_forecast"), 0.0)
    )
