"""Revenue and variability classes of series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.functions.scalars import cents, from_cents
from shelfwise.operators.ordering import running_total
from shelfwise.params import ABC_CLASSES, XYZ_CLASSES


def daily_revenue(sales_long: DataFrame) -> DataFrame:
    """Revenue per row in whole cents; a missing price counts as zero revenue."""
    value = F.col("units_sold") * F.coalesce(cents(F.col("sell_price")), F.lit(0))
    return sales_long.withColumn("revenue_cents", value)


def demand_panel(sales_long: DataFrame, first, cutoff, days: int) -> DataFrame:
    """Sum demand and revenue into periods of ``days`` days laid in both directions from the cutoff.

    No period holds days of both sides. A first period that begins before ``first`` is incomplete and left out: its
    total is no period's demand. Daily rows are their own periods, so they pass through without a shuffle.
    """
    daily = daily_revenue(sales_long)
    if days == 1:
        return daily.select("item_id", "store_id", "date", "units_sold", "revenue_cents")
    period = F.floor((F.datediff("date", F.lit(cutoff)) - 1) / days).cast("int")
    start = F.date_add(F.lit(cutoff), period * days + 1)
    whole = daily.withColumn("date", start).where(F.col("date") >= F.lit(first))
    return whole.groupBy("item_id", "store_id", "date").agg(
        F.sum("units_sold").alias("units_sold"), F.sum("revenue_cents").alias("revenue_cents")
    )


def partial_totals(panel: DataFrame) -> DataFrame:
    """Sums per series of one batch of periods. They are whole numbers, so they merge exactly, in any order."""
    units = F.col("units_sold").cast("double")
    return panel.groupBy("item_id", "store_id").agg(
        F.sum("units_sold").alias("sum_units"),
        F.sum(units * units).alias("sum_squares"),
        F.count(F.lit(1)).alias("n_periods"),
        F.sum("revenue_cents").alias("revenue_cents"),
    )


def merged_totals(parts: DataFrame) -> DataFrame:
    """Series totals from partial sums of several batches."""
    merged = parts.groupBy("item_id", "store_id").agg(*[F.sum(c).alias(c) for c in ("sum_units", "sum_squares", "n_periods", "revenue_cents")])
    return merged.withColumn("total_revenue", from_cents(F.col("revenue_cents"))).drop("revenue_cents")


def series_totals(panel: DataFrame) -> DataFrame:
    """Sums per series that later steps turn into mean, spread and revenue."""
    whole = partial_totals(panel)
    return whole.withColumn("total_revenue", from_cents(F.col("revenue_cents"))).drop("revenue_cents")


class SeriesAccumulator:
    """Stored partial sums of series. Each batch of new periods is read once, when it is added; totals read the sums only.

    A batch that is added again (under its name) takes the place of what it was before.
    """

    def __init__(self, path: str):
        self.path = path

    def add(self, panel: DataFrame, batch: str) -> None:
        partial_totals(panel).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def totals(self, spark: SparkSession) -> DataFrame:
        return merged_totals(spark.read.parquet(self.path).drop("batch"))


def with_variation(totals: DataFrame) -> DataFrame:
    """Population mean, standard deviation and cv; cv is infinite when the mean is not positive."""
    mean = F.col("sum_units") / F.col("n_periods")
    variance = F.col("sum_squares") / F.col("n_periods") - F.col("mean_units") * F.col("mean_units")
    return (
        totals.withColumn("mean_units", mean)
        .withColumn("std_units", F.sqrt(F.when(variance > 0, variance).otherwise(0.0)))
        .withColumn(
            "cv",
            F.when(F.col("mean_units") > 0, F.col("std_units") / F.col("mean_units")).otherwise(
                F.lit(float("inf"))
            ),
        )
    )


def with_abc(totals: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Classes by cumulative revenue share: A to 70 %, B to 90 %, the rest C.

    Ties in revenue follow the series key. ``scope`` restarts the ranking, for example
    per store. Shares are compared in exact decimals.
    """
    order = [F.desc("total_revenue"), F.asc("item_id"), F.asc("store_id")]
    ranked = running_total(totals, order, "total_revenue", "cum_revenue", by=scope)
    cum, total = F.col("cum_revenue"), F.col("cum_revenue_total")
    share_is_upto = lambda tenths: (total > 0) & (cum * 10 <= total * tenths)
    return ranked.withColumn(
        "abc_class", F.when(share_is_upto(7), "A").when(share_is_upto(9), "B").otherwise("C")
    )


def with_xyz(df: DataFrame) -> DataFrame:
    """Classes by cv: X below 0.5, Y up to 1, the rest Z."""
    return df.withColumn(
        "xyz_class", F.when(F.col("cv") < 0.5, "X").when(F.col("cv") <= 1.0, "Y").otherwise("Z")
    )


def abc_xyz(panel: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Both classes per series."""
    classed = with_xyz(with_abc(with_variation(series_totals(panel)), scope))
    return classed.select(
        "item_id",
        "store_id",
        "total_revenue",
        "cv",
        "abc_class",
        "xyz_class",
        F.concat("abc_class", "xyz_class").alias("abc_xyz"),
    )


def segment_matrix(labels: DataFrame) -> DataFrame:
    """Series counts, classes A to C down and X to Z across, zero where empty."""
    counts = labels.agg(
        *[
            F.coalesce(F.sum((F.col("abc_xyz") == a + x).cast("bigint")), F.lit(0)).alias(a + x)
            for a in ABC_CLASSES
            for x in XYZ_CLASSES
        ]
    )
    rows = [
        F.struct(F.lit(a).alias("abc_class"), *[F.col(a + x).alias(x) for x in XYZ_CLASSES])
        for a in ABC_CLASSES
    ]
    return counts.select(F.explode(F.array(*rows)).alias("row")).select("row.*")
