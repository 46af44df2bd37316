import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import croston, features, naive, smoothing
from shelfwise.operators.ingest import time_split
from shelfwise.params import DAY, TimeGrain

from tests.conftest import START


def recursive_croston(ts, alpha=0.1):
    """The textbook recursion, step by step."""
    hits = [i for i, v in enumerate(ts) if v > 0]
    if not hits:
        return 0.0
    if len(hits) == 1:
        return (1 - alpha / 2) * ts[hits[0]] / (hits[0] + 1)
    size, interval = float(ts[hits[0]]), (hits[-1] - hits[0]) / (len(hits) - 1)
    for before, now in itertools.pairwise(hits):
        size += alpha * (ts[now] - size)
        interval += alpha * ((now - before) - interval)
    return (1 - alpha / 2) * size / interval


def test_croston_closed_form_equals_the_recursion(spark, series):
    rng = random.Random(11)
    histories = {
        "zeros": [0] * 40,
        "one": [0, 0, 5] + [0] * 20,
        "first_only": [4] + [0] * 10,
        "leading": [0] * 30 + [1, 0, 3],
        "trailing": [2, 0, 3] + [0] * 50,
        "dense": list(range(1, 60)),
        **{f"r{k}": [rng.randint(1, 9) if rng.random() < 0.2 else 0 for _ in range(200)] for k in range(40)},
    }
    got = {r.item_id: r.croston_sba for r in croston.croston_sba(series(histories)).collect()}
    assert got.keys() == histories.keys()
    for name, ts in histories.items():
        assert got[name] == pytest.approx(recursive_croston(ts), abs=1e-10), name


def test_croston_driver_switches_at_thirty_demands(spark, series):
    histories = {"n29": [1, 0] * 29 + [0] * 28, "n30": [1, 0] * 30 + [0] * 28, "x": [3] * 88}
    panel = series(histories).withColumn("cat_id", F.lit("FOODS"))
    cutoff = START + dt.timedelta(days=59)
    train, val = time_split(panel, cutoff)
    labels = spark.createDataFrame(
        [("n29", "S1", "Z"), ("n30", "S1", "Z"), ("x", "S1", "X"), ("gone", "S1", "Z")], "item_id string, store_id string, xyz_class string"
    )
    rows = croston.croston_forecasts(train, val, labels).collect()
    by_item = {r.item_id: r.croston_sba_forecast for r in rows}
    assert set(by_item) == {"n29", "n30"}
    assert by_item["n29"] == pytest.approx(29 / 60)
    assert by_item["n30"] == pytest.approx(recursive_croston(histories["n30"][:60]))
    keys = croston.intermittent_series(labels, train).collect()
    assert sorted(r.item_id for r in keys) == ["n29", "n30"]


def test_naive_prefers_a_year_back_then_four_weeks(spark, series):
    long = list(range(1, 401))
    panel = series({"long": long, "short": [0] * 372 + long[372:], "young": [7] * 400})
    panel = panel.where("not (item_id = 'young' and date < date'2021-01-13')")  # starts on day 373
    cutoff = START + dt.timedelta(days=379)
    train, val = time_split(panel, cutoff)
    got = {(r.item_id, (r.date - START).days): r.seasonal_naive_forecast for r in naive.seasonal_naive(train, val, cutoff).collect()}
    assert got[("long", 390)] == long[390 - 364]
    assert got[("short", 390)] == 0.0  # a zero a year back is a value, not a gap
    assert got[("young", 399)] == 0.0 and got[("young", 380)] == 0.0  # neither day has a row
    assert len(got) == 60


def test_naive_never_reads_validation_rows(spark, series):
    panel = series({"a": [1] * 30 + [99] * 28 + [5]})
    cutoff = START + dt.timedelta(days=29)
    train, val = time_split(panel, cutoff)
    got = {(r.date - START).days: r.seasonal_naive_forecast for r in naive.seasonal_naive(train, val, cutoff).collect()}
    assert got[30] == 1.0 and got[58] == 0.0


def recursive_holt_winters(y, a, b, g, m, horizon):
    level = sum(y[:m]) / m
    trend = (sum(y[m : 2 * m]) / m - level) / m
    wave, sse = [v - level for v in y[:m]], 0.0
    for t in range(m, len(y)):
        s = wave[t % m]
        sse += (y[t] - level - trend - s) ** 2
        new = a * (y[t] - s) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        wave[t % m] = g * (y[t] - new) + (1 - g) * s
        level = new
    return sse, [level + (h + 1) * trend + wave[(len(y) + h) % m] for h in range(horizon)]


def test_smoothing_picks_the_best_grid_point():
    rng = random.Random(2)
    grid = list(itertools.product(smoothing.LEVEL_GRID, smoothing.TREND_GRID, smoothing.SEASON_GRID))
    ys = [[max(0, 20 + 0.1 * t + 8 * ((t % 7) == 5) + rng.gauss(0, 3)) for t in range(90)] for _ in range(5)]
    got = smoothing.fit_batch(np.array(ys), np.array(grid), 7, 28)
    for y, forecast in zip(ys, got):
        best = min((recursive_holt_winters(y, *p, 7, 28) for p in grid), key=lambda r: r[0])
        assert np.allclose(forecast, best[1])


def test_smoothing_operator_scope_and_gaps(spark, series):
    wave = [10 + 5 * (t % 7 == 6) for t in range(88)]
    panel = series({"a": wave, "c": wave, "young": wave}).withColumn("cat_id", F.lit("FOODS"))
    cutoff = START + dt.timedelta(days=59)
    panel = panel.where(~((F.col("item_id") == "young") & (F.col("date") < F.lit(cutoff - dt.timedelta(days=12)))))
    train, val = time_split(panel, cutoff)
    labels = spark.createDataFrame([("a", "S1", "A"), ("c", "S1", "C"), ("young", "S1", "B")], "item_id string, store_id string, abc_class string")
    fitted = smoothing.ets_forecast(train, val, labels, cutoff)
    rows = fitted.collect()
    assert {r.item_id for r in rows} == {"a"} and len(rows) == 28
    assert all(abs(r.ets_forecast - wave[(r.date - START).days]) < 1e-6 for r in rows)
    filled = smoothing.fill_gaps(val, naive.seasonal_naive(train, val, cutoff), fitted)
    assert filled.where("ets_forecast is null").count() == 0
    gap = filled.where("item_id = 'c'").first()
    assert gap.ets_forecast == gap.seasonal_naive_forecast


def test_rolling_features_match_pandas(spark, series):
    rng = random.Random(9)
    units = [rng.randint(0, 40) for _ in range(120)]
    grain = TimeGrain("t", 1, (3, 5), (4, 9), season=7, recent=30, tail=4, horizon=4)
    rows = features.with_rolling(features.with_lags(series({"a": units}), grain), grain).orderBy("date").toPandas()
    import pandas as pd

    lag = pd.Series(units).shift(3)
    for n in (4, 9):
        mean, std = lag.rolling(n, min_periods=1).mean(), lag.rolling(n, min_periods=1).std()
        assert np.allclose(rows[f"roll_mean_{n}"], mean, equal_nan=True)
        assert np.allclose(rows[f"roll_std_{n}"], std, equal_nan=True, atol=1e-9)
    assert "run_s" not in rows.columns


def test_validation_rows_never_feed_features(spark, series):
    base, changed = [1] * 88, [1] * 60 + [50] * 28
    cutoff = START + dt.timedelta(days=59)
    lagged = features.with_rolling(features.with_lags(series({"a": base, "b": changed})))
    rows = lagged.where((F.col("date") > F.lit(cutoff))).drop("item_id", "units_sold").groupBy("date").agg(F.countDistinct(F.struct("lag_28", "roll_mean_28", "roll_std_28")).alias("n"))
    assert rows.where("n > 1").count() == 0


def test_price_steps_need_the_week_before(spark):
    days = [(START + dt.timedelta(days=7 * w), 100 + w) for w in range(5)]
    calendar = spark.createDataFrame(days, "date date, wm_yr_wk int")
    prices = spark.createDataFrame([("a", "s", 100, 2.0), ("a", "s", 101, 2.5), ("a", "s", 103, 3.0), ("a", "s", 104, 2.0)], "item_id string, store_id string, wm_yr_wk int, sell_price double")
    got = {r.wm_yr_wk: r.price_change for r in features.price_steps(prices, calendar).collect()}
    assert got == {100: None, 101: 0.5, 103: None, 104: -1.0}


def test_last_mean_uses_the_newest_rows(spark, series):
    assert features.last_mean(series({"a": [9] * 5 + [1, 2, 3]}), 3).first().last_mean == 2.0
    assert DAY.tail == 28
