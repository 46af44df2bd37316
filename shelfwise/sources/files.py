"""Raw files in, results out. Every read has a fixed schema; nothing is inferred."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfwise import schemas
from shelfwise.session import materialize


def scan_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide daily sales: ids as text, every ``d_n`` column as a short, by the file's header."""
    header = spark.read.text(path).first()[0].split(",")
    return spark.read.schema(schemas.wide_sales(header)).option("header", True).csv(path)


def scan_csv(spark: SparkSession, path: str, schema: StructType, **more: Column) -> DataFrame:
    """CSV with a header. Columns are matched by name, in whatever order the file has them; ``more`` may use the files' metadata."""
    header = spark.read.text(path).first()[0].split(",")
    known = {f.name: f for f in schema.fields}
    in_file = StructType([known.get(c, StructField(c, StringType())) for c in header])
    frame = spark.read.schema(in_file).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return frame.select(*[c for c in known if c in header], *[column.alias(name) for name, column in more.items()])


def scan_calendar(spark: SparkSession, path: str) -> DataFrame:
    """Calendar file with real dates."""
    return scan_csv(spark, path, schemas.CALENDAR)


def scan_prices(spark: SparkSession, path: str, by: str = "time") -> DataFrame:
    """Weekly price files with the arrival order of their rows, for keys that repeat.

    Files arrive by ``time`` of change, or by ``name`` (the whole path); the other one breaks ties. Within a file rows arrive as they stand. The number
    that Spark gives to rows follows how it packs files into tasks (the largest first), so it counts inside one split of a file only.
    """
    time, name = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    first, second = (time, name) if by == "time" else (name, time)
    arrival = F.struct(first.alias("first"), second.alias("second"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    return scan_csv(spark, path, schemas.PRICES, arrival=arrival)


def cutoff_date(calendar: DataFrame, train_end_day: str) -> dt.date:
    """Date of the last training day label; one row, so a plain lookup."""
    return calendar.where(F.col("d") == train_end_day).select("date").first()[0]


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "append") -> None:
    """Snappy Parquet. ``partition_by=("store_id",)`` lets a reader of one store skip the rest."""
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def scan_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet with a fixed schema; only selected columns are read."""
    return spark.read.schema(schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Result as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(document: DataFrame, path: str) -> None:
    """One-column frame of JSON text, one document per line."""
    document.write.mode("overwrite").text(path)


def scan_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON documents with a fixed schema."""
    return spark.read.schema(schema).json(path)


def footer_profile(spark: SparkSession, path: str) -> DataFrame:
    """Rows, non-null count, least and greatest value of every column of Parquet files, from their footers alone.

    Spark answers these aggregates from the files' statistics (``aggregatePushdown``), so no row is read. Text and timestamps have no
    usable least and greatest there and stay NULL. The settings hold while this function runs; its few rows are stored.
    """
    wanted = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return materialize(footer_aggregates(spark.read.parquet(path)), "footer-profile")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_aggregates(df: DataFrame) -> DataFrame:
    """The profile's plan; see ``footer_profile``."""
    plain = {name for name, kind in df.dtypes if kind in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date")}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count(F.col(c)).alias(f"f{i}"))
        aggs += [F.min(F.col(c)).alias(f"a{i}"), F.max(F.col(c)).alias(f"b{i}")] if c in plain else []
    text = lambda name, c: (F.col(name).cast("string") if c in plain else F.lit(None).cast("string"))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(kind).alias("data_type"), F.col("n").alias("n_rows"), F.col(f"f{i}").alias("n_known"),
            text(f"a{i}", c).alias("least"), text(f"b{i}", c).alias("greatest"),
        )
        for i, (c, kind) in enumerate(df.dtypes)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def first_rows(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in the order of a key: each task keeps n."""
    return df.orderBy(*key).limit(n)
