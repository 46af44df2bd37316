"""Retail star built from an order-line model (lineitem, part, supplier, nation, region).

A supplier's region plays the store, a part's brand (or type and brand) the item, and
the ship date the day of sale.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.params import CATEGORIES
from shelfwise.session import materialize

WEEK_ORIGIN = dt.date(1994, 12, 31)  # a Saturday, so weeks run Saturday to Friday
# State of each store; any other store belongs to WI.
STORE_STATES = {"AMERICA": "CA", "AFRICA": "CA", "ASIA": "TX", "MIDDLE EAST": "TX"}
# Days of the month with a benefit payment.
FLAG_DAYS = {
    "snap_CA": (1, 2, 3, 4, 5, 6, 7, 8, 9, 10),
    "snap_TX": (1, 3, 5, 6, 7, 9, 11, 12, 13, 15),
    "snap_WI": (2, 3, 5, 6, 8, 9, 11, 12, 14, 15),
}
# Month and day, event, type.
EVENTS = (
    ("01-01", "NewYear", "National"),
    ("02-14", "ValentinesDay", "Cultural"),
    ("07-04", "IndependenceDay", "National"),
    ("10-31", "Halloween", "Cultural"),
    ("12-25", "Christmas", "National"),
)


def scan(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Pruned scan of one input table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def item_column(grain: str) -> Column:
    """Item name at brand, at type-and-brand, or at part grain; it always ends with the brand."""
    if grain == "brand":
        return F.col("p_brand")
    return F.concat_ws("_", "p_partkey" if grain == "part" else "p_type", "p_brand")


def brand_number(item: Column) -> Column:
    return F.substring_index(item, "#", -1).cast("int")


def hierarchy(item: Column) -> dict[str, Column]:
    """Category and department of an item, by its brand number."""
    number = brand_number(item)
    category = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), (number % 3 + 1).cast("int"))
    shelf = (F.lit(1) + F.floor(number / 3) % 3).cast("string")
    return {"dept_id": F.concat(category, F.lit("_"), shelf), "cat_id": category}


def state_of(store: Column) -> Column:
    chain = None
    for name, state in STORE_STATES.items():
        chain = (F if chain is None else chain).when(store == name, F.lit(state))
    return chain.otherwise("WI")


def week_of(date: Column) -> Column:
    return F.floor(F.datediff(date, F.lit(WEEK_ORIGIN)) / 7).cast("int")


def observed_sales(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """Units, and the parts of a mean price, per item, store and day with sales.

    One pass over the order lines. Region and nation are fixed at 5 and 25 rows; part and
    supplier grow with the data. The map from supplier to store is stored first: a join of three tables
    has only a guessed size, a stored one its true size, so the optimizer broadcasts it while it is
    small and shuffles, and splits a hot supplier at run time, when it is not. Amounts are whole numbers, in hundredths
    of a cent, so sums do not depend on their order.
    """
    lines = scan(spark, sf_dir, "lineitem", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate")
    parts = scan(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type", "p_retailprice")
    nations = scan(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    regions = scan(spark, sf_dir, "region", "r_regionkey", "r_name")
    stores = materialize(
        scan(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
        .join(F.broadcast(nations), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("store_id")),
        "stores",
    )
    items = parts.select(
        "p_partkey",
        item_column(grain).alias("item_id"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"),
    )
    paid_share = 100 - F.round(F.col("l_discount") * 100).cast("bigint")
    return (
        lines.join(items, F.col("l_partkey") == F.col("p_partkey"))
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("item_id", "store_id", F.to_date("l_shipdate").alias("date"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("units_sold"),
            F.sum(F.col("cents") * paid_share).alias("paid"),
            F.count(F.lit(1)).alias("n_lines"),
        )
    )


def weekly_prices(observed: DataFrame) -> DataFrame:
    """Mean price paid per item, store and week, to the cent; weeks without sales have none."""
    paid, lines = F.sum("paid"), F.sum("n_lines")
    sums = observed.groupBy("item_id", "store_id", week_of(F.col("date")).alias("wm_yr_wk")).agg(
        paid.alias("paid"), lines.alias("n")
    )
    cents = F.expr("(2 * paid + 100 * n) div (200 * n)")  # rounds half up in whole numbers
    return sums.select("item_id", "store_id", "wm_yr_wk", (cents / 100.0).cast("double").alias("sell_price"))


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Calendar rows for the days of the data, with events and benefit days."""
    date, day = F.col("date"), F.dayofmonth("date")

    def event(position: int) -> Column:
        chain = None
        for row in EVENTS:
            chain = (F if chain is None else chain).when(
                F.date_format("date", "MM-dd") == row[0], F.lit(row[position])
            )
        return chain

    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return days.select(
        date,
        week_of(date).alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        ((F.weekday(date) + 2) % 7 + 1).cast("tinyint").alias("wday"),
        F.month(date).cast("tinyint").alias("month"),
        F.year(date).cast("smallint").alias("year"),
        F.concat(F.lit("d_"), F.datediff(date, F.lit(first)) + 1).alias("d"),
        event(1).alias("event_name_1"),
        event(2).alias("event_type_1"),
        F.lit(None).cast("string").alias("event_name_2"),
        F.lit(None).cast("string").alias("event_type_2"),
        *[day.isin(*days_).cast("tinyint").alias(name) for name, days_ in FLAG_DAYS.items()],
    )
