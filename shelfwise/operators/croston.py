"""Croston's method (SBA variant) for intermittent demand, in closed form.

The smoothing recursion over the demands x0..xm and the gaps g1..gm unrolls to weighted
sums: a term that is j demands old has weight alpha * (1 - alpha)^j, and the start value
has weight (1 - alpha)^m. So a rank and one aggregation per series replace the loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions.scalars import clip_low
from shelfwise.params import DAY, TimeGrain

ALPHA = 0.1


def croston_sba(train: DataFrame, alpha: float = ALPHA, days: int = 1) -> DataFrame:
    """Flat SBA forecast per series with the smoothed size and interval.

    ``days`` is the row spacing of the panel. A series without demand forecasts zero;
    one with a single demand spreads it over the periods up to and including it.
    """
    key = ["item_id", "store_id"]
    starts = train.groupBy(*key).agg(
        F.min("date").alias("start"),
        F.count(F.lit(1)).alias("n_periods"),
        F.avg("units_sold").alias("plain_mean"),
    )
    newest_first = Window.partitionBy(*key).orderBy(F.desc("date"))
    demands = (
        train.where(F.col("units_sold") > 0)
        .withColumn("age", F.row_number().over(newest_first) - 1)
        .withColumn("earlier", F.lead("date").over(newest_first))
        .withColumn("gap", F.datediff("date", "earlier") / days)
    )
    keep = 1.0 - alpha
    weight = F.lit(alpha) * F.pow(F.lit(keep), F.col("age"))
    later = F.col("gap").isNotNull()  # every demand but the first has a gap before it
    sums = demands.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_demands"),
        F.min_by(F.col("units_sold").cast("double"), "date").alias("first_size"),
        F.min("date").alias("first_demand"),
        F.max("date").alias("last_demand"),
        F.sum(F.when(later, weight * F.col("units_sold"))).alias("size_sum"),
        F.sum(F.when(later, weight * F.col("gap"))).alias("gap_sum"),
    )
    m = F.col("n_demands") - 1
    start_weight = F.pow(F.lit(keep), m)
    mean_gap = F.datediff("last_demand", "first_demand") / days / F.when(m > 0, m)
    first_at = F.datediff("first_demand", "start") / days + 1.0
    size = F.when(m == 0, F.col("first_size")).otherwise(start_weight * F.col("first_size") + F.col("size_sum"))
    interval = F.when(m == 0, first_at).otherwise(start_weight * mean_gap + F.col("gap_sum"))
    return (
        starts.join(sums, key, "left")
        .withColumn("n_demands", F.coalesce("n_demands", F.lit(0).cast("bigint")))
        .withColumn("demand_size", size)
        .withColumn("demand_interval", interval)
        .withColumn(
            "croston_sba",
            F.when(F.col("n_demands") == 0, 0.0).otherwise(
                clip_low((1.0 - alpha / 2.0) * F.col("demand_size") / F.col("demand_interval"), 0.0)
            ),
        )
        .select(*key, "n_periods", "n_demands", "plain_mean", "demand_size", "demand_interval", "croston_sba")
    )


def intermittent_series(labels: DataFrame, train: DataFrame) -> DataFrame:
    """Keys of Z series that also occur in the training rows."""
    wanted = labels.where(F.col("xyz_class") == "Z").select("item_id", "store_id")
    # Distinct first, so that training rows combine before they are moved.
    return wanted.intersect(train.select("item_id", "store_id").distinct())


def croston_forecasts(
    train: DataFrame, val: DataFrame, labels: DataFrame, grain: TimeGrain = DAY, alpha: float = ALPHA
) -> DataFrame:
    """Croston forecasts of the Z series on the validation rows.

    Under ``min_demands`` demands the plain mean of the series is used instead. With more,
    the closed form is finite (gaps are at least one period), so it needs no rescue value.
    """
    key = ["item_id", "store_id"]
    # The semi join already restricts to series with training rows, so no key set is built.
    z_train = train.join(labels.where(F.col("xyz_class") == "Z").select(*key), key, "left_semi")
    fits = croston_sba(z_train, alpha, grain.days)
    level = F.when(F.col("n_demands") < grain.min_demands, F.col("plain_mean")).otherwise(F.col("croston_sba"))
    flat = fits.select(*key, clip_low(level, 0.0).alias("croston_sba_forecast"))
    return val.join(flat, key).select(
        *key, "date", F.col("units_sold").alias("actual"), "croston_sba_forecast"
    )
