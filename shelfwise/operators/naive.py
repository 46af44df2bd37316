"""Seasonal naive forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import clip_low


def seasonal_naive(
    train: DataFrame, val: DataFrame, cutoff: dt.date, back_days: tuple[int, ...] = (364, 28)
) -> DataFrame:
    """Demand the same number of days ago, first offset that has a training row, else zero.

    One join serves all offsets: each training row is sent forward to the dates it can
    predict, and the earliest listed offset wins. Rows that land inside training are
    dropped before the shuffle.
    """
    horizon = val.select("item_id", "store_id", "date")
    forward = F.explode(
        F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(n).alias("shift")) for i, n in enumerate(back_days)])
    )
    useful = train.where(F.col("date") > F.lit(cutoff - dt.timedelta(days=max(back_days))))
    sent = useful.select("item_id", "store_id", "units_sold", F.col("date").alias("sold_on"), forward.alias("f")).select(
        "item_id", "store_id", "units_sold", "f.rank", F.date_add("sold_on", F.col("f.shift")).alias("date")
    ).where(F.col("date") > F.lit(cutoff))
    best = (
        horizon.join(sent, ["item_id", "store_id", "date"], "left")
        .groupBy("item_id", "store_id", "date")
        .agg(F.min_by("units_sold", "rank").alias("found"))
    )
    return best.select(
        "item_id",
        "store_id",
        "date",
        clip_low(F.coalesce(F.col("found").cast("double"), F.lit(0.0)), 0.0).alias("seasonal_naive_forecast"),
    )
