"""Session defaults and the shared folder for stage tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_STAGE_DIRS: dict[str, str] = {}
_TABLES: dict[str, list[str]] = {}  # stage tables and databases by application, for drop_stages
_DATABASES: dict[str, list[str]] = {}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches. On a cluster, submit with your own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shelfwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Let joins on a series key plus a week reuse the bucketing by series key alone.

    Without it Spark moves both sides of the price join again. Results do not depend on it.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def stage_dir(spark: SparkSession) -> str:
    """Folder all executors can reach; stage tables survive the loss of any of them."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_STAGE_DIRS:
        _LOCAL_STAGE_DIRS[app] = tempfile.mkdtemp(prefix="shelfwise-")
    return _LOCAL_STAGE_DIRS[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder of this run under the shared one."""
    return f"{stage_dir(spark)}/shelfwise/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage_database(spark: SparkSession, name: str) -> str:
    """Name of a new database of this run; ``drop_stages`` removes it with its tables."""
    database = f"{name}_{uuid.uuid4().hex}"
    _DATABASES.setdefault(spark.sparkContext.applicationId, []).append(database)
    return database


def materialize(
    df: DataFrame, name: str, bucket_by: tuple[str, ...] = (), database: str | None = None, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Write a stage table once and read it back.

    Cuts the lineage, fixes values that other jobs must agree on, and gives the next
    plan real file sizes, column pruning and filter pushdown. ``bucket_by`` also keeps
    the rows hash-partitioned on disk: later windows, aggregations and joins on those
    columns then read them in place, without a shuffle. ``partition_by`` (with buckets only) splits
    each bucket into folders by columns of few values, so that a filter on them reads their folders
    alone; the columns come last. Bucketed stages are external tables
    of ``database`` (the current one if None); ``drop_stages`` removes all stages of a run.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    if not bucket_by:
        df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = (f"{database}." if database else "") + path.rpartition("/")[2].replace("-", "_")
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)
    # Shuffled by the bucket columns first, each bucket is written by one task as one file (a folder, where it is split).
    writer = df.repartition(buckets, *bucket_by).write.format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("compression", "snappy").bucketBy(buckets, *bucket_by).saveAsTable(table)
    return spark.table(table)


def drop_stages(spark: SparkSession) -> None:
    """Drop the stage tables and folders that this application has made. Frames read from them are void afterwards."""
    app = spark.sparkContext.applicationId
    for table in _TABLES.pop(app, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for database in _DATABASES.pop(app, []):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{stage_dir(spark)}/shelfwise/{app}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def listing(spark: SparkSession, folder: str, names: tuple[str, ...]) -> tuple:
    """Name, size and change time of the files of input tables: what has been read is told apart by it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        system = path.getFileSystem(conf)
        if system.exists(path):
            found += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in system.listStatus(path)]
    return tuple(found)
