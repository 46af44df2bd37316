"""Chunked appends to a fact table as a file stream that stops when it has caught up.

Each run picks up the files that arrived since the last one; the checkpoint makes sure
that a file is loaded once, also when a run is cut short and started again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def append_new_files(
    spark: SparkSession,
    schema: StructType,
    source_dir: str,
    target_dir: str,
    checkpoint_dir: str,
    partition_by: tuple[str, ...] = ("store_id",),
    files_per_batch: int = 1000,
) -> None:
    """Load new Parquet files of ``source_dir`` into a partitioned Parquet table."""
    incoming = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    )
    run = (
        incoming.writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(target_dir)
    )
    run.awaitTermination()
