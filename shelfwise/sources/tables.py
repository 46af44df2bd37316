"""Catalog tables: the star schema and the result facts."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfwise.schemas import STAR_TABLES


def create_star(spark: SparkSession, database: str) -> None:
    """Create the five star tables as Parquet, empty. Facts are split by store."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in STAR_TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        split = " PARTITIONED BY (store_id)" if name.startswith("fact_") else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{split}")


def append_rows(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name and type."""
    target = df.sparkSession.table(table).schema
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])
    rows.write.insertInto(table, overwrite=False)


def create_loads(spark: SparkSession, table: str, schema: StructType) -> None:
    """A fact table whose rows come in loads, and the ledger of the loads that are complete."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, load_id STRING) USING parquet PARTITIONED BY (load_id)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_ledger (load_id STRING, loaded_at TIMESTAMP) USING parquet")


def append_once(df: DataFrame, table: str, load_id: str) -> bool:
    """Append a load unless the ledger has it; returns whether it was written.

    A load's rows are the partition of its name, which is overwritten as a whole. So a load that was cut short is repaired by
    the next try, and one that ended without its ledger entry is written over itself: rows never double.
    """
    spark = df.sparkSession
    if load_id in completed_loads(spark, table):
        return False
    target = [f for f in spark.table(table).schema.fields if f.name != "load_id"]
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
    name = f"append_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(name)
    literal = load_id.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (load_id = '{literal}') SELECT * FROM {name}")
    spark.catalog.dropTempView(name)
    spark.sql(f"INSERT INTO {table}_ledger VALUES ('{literal}', current_timestamp())")
    return True


def completed_loads(spark: SparkSession, table: str) -> set[str]:
    """Names in the ledger: one row per load."""
    return {r.load_id for r in spark.table(f"{table}_ledger").select("load_id").distinct().collect()}


def loaded_rows(spark: SparkSession, table: str) -> DataFrame:
    """Rows of complete loads; what an interrupted one has left is pruned away with its partition."""
    return spark.table(table).where(F.col("load_id").isin(*completed_loads(spark, table))).drop("load_id")


def replace_table(df: DataFrame, table: str) -> None:
    """Replace a result as a whole: write a new version beside the old one, then point the name to it.

    The name is a view, and pointing it elsewhere is one change in the catalog. Whoever reads meanwhile has the old version or the new one, never
    a gap; the version before the last stays until the next replacement, for readers that have begun.
    """
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    version = f"{table}__v{time.time_ns()}"
    df.write.format("parquet").saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")
    listed = spark.sql(f"SHOW TABLES IN {database or spark.catalog.currentDatabase()}").where(F.col("tableName").startswith(f"{name.lower()}__v"))
    for old in sorted(r.tableName for r in listed.collect())[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {database + '.' if database else ''}{old}")


def scan_in(df: DataFrame, column: str, values: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Projection and membership filter, both pushed to the scan."""
    return df.where(F.col(column).isin(*values)).select(*columns)


def with_iso_date(df: DataFrame) -> DataFrame:
    """Date as ISO text, and back again, for exchange with systems that store text."""
    return df.withColumn("date_text", F.date_format("date", "yyyy-MM-dd")).withColumn(
        "date_back", F.to_date("date_text", "yyyy-MM-dd")
    )
