"""Wide to long, price and calendar enrichment, dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import calendar_parts
from shelfwise.schemas import EVENT_COLUMNS, FLAG_COLUMNS, SALES_LONG

YEAR_PART = "sale_year"  # column by which a stored fact is split into folders


def melt_wide(wide: DataFrame, ids: Sequence[str], prefix: str = "d_") -> DataFrame:
    """One row per id and day column: ids, d, units_sold.

    ``posexplode`` of one array keeps a single projection per input row, where an
    unpivot over two thousand columns would carry two thousand.
    """
    days = [c for c in wide.columns if c.startswith(prefix)]
    labels = F.split(F.lit(",".join(days)), ",")  # one literal, however many days
    cells = F.posexplode(F.array(*days)).alias("at", "units_sold")
    return wide.select(*ids, cells).select(*ids, F.get(labels, F.col("at")).alias("d"), "units_sold")


def last_price(prices: DataFrame, arrival: str) -> DataFrame:
    """One price per item, store and week; of repeated keys the last to arrive wins."""
    return prices.groupBy("item_id", "store_id", "wm_yr_wk").agg(
        F.max_by("sell_price", arrival).alias("sell_price")
    )


def enrich_sales(sales: DataFrame, calendar: DataFrame, prices: DataFrame, on: str = "d") -> DataFrame:
    """Attach calendar (one row per day, so broadcast) and weekly price to daily sales."""
    dated = sales.join(F.broadcast(calendar), on, "left")
    return dated.join(prices, ["item_id", "store_id", "wm_yr_wk"], "left")


def as_sales_long(df: DataFrame) -> DataFrame:
    """Cast to the fixed long schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SALES_LONG.fields])


def build_dim_date(calendar: DataFrame) -> DataFrame:
    """Calendar rows with derived date parts."""
    parts = calendar_parts(F.col("date"))
    return calendar.select(
        "date",
        "d",
        F.col("wm_yr_wk").cast("int").alias("wm_yr_wk"),
        *[parts[p].alias(p) for p in ("day_of_week", "week_of_year", "month", "year")],
        *EVENT_COLUMNS,
        *[F.col(c).cast("int").alias(c) for c in FLAG_COLUMNS],
        parts["is_weekend"].alias("is_weekend"),
    )


def build_dim(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """One row per key; of differing attribute rows the smallest is kept, so reruns agree.

    The distinct comes first: it combines on the map side by hash, so the minimum, which
    needs a sort, only sees the few rows that are left.
    """
    kept = F.min(F.struct(*attributes)).alias("kept")
    return df.select(key, *attributes).distinct().groupBy(key).agg(kept).select(key, "kept.*")


def dense_sales(observed: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Every series on every day; days without a row count as zero units."""
    days = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date")
    grid = observed.select("item_id", "store_id").distinct().select("item_id", "store_id", days)
    return grid.join(
        observed.select("item_id", "store_id", "date", "units_sold"), ["item_id", "store_id", "date"], "left"
    ).withColumn("units_sold", F.coalesce("units_sold", F.lit(0).cast("bigint")))


def time_split(df: DataFrame, cutoff: dt.date) -> tuple[DataFrame, DataFrame]:
    """Training rows up to the cutoff, validation rows after it."""
    return df.where(F.col("date") <= F.lit(cutoff)), df.where(F.col("date") > F.lit(cutoff))


def on_days(fact_sales: DataFrame, days: DataFrame) -> DataFrame:
    """Sales of the given days with the columns of their day; the days are few (one row each), so they are broadcast.

    A fact that is split by year is joined on the year too: a filter on the days then reaches its folders, as a literal where the filter
    names the year and as a set found at run time where it names dates, flags or events.
    """
    if YEAR_PART not in fact_sales.columns:
        return fact_sales.join(F.broadcast(days), "date")
    dated = days.withColumn(YEAR_PART, F.year("date"))
    return fact_sales.join(F.broadcast(dated), ["date", YEAR_PART]).drop(YEAR_PART)


def attach_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of the segment labels onto any frame keyed by series."""
    return df.join(
        labels.select("item_id", "store_id", "abc_class", "xyz_class", "abc_xyz"),
        ["item_id", "store_id"],
        "left",
    )


def store_slice(sales_long: DataFrame, store_id: str) -> DataFrame:
    """One store's rows; on a table partitioned by store this prunes to its folder."""
    return sales_long.where(F.col("store_id") == store_id)
