"""Global order statistics without a one-task window.

A window with no partition key pulls the whole table into one task. These helpers cut
the total order into ranges instead. The range number is stored in a stage table, so
that all later reads, and retries after a lost executor, agree on it. The order must be
total (end it with the row key): then equal leading values, however many, still spread
over several ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.session import materialize

_BUCKET = "range_no"


def running_total(
    df: DataFrame, order: Sequence[Column], value: str, out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``out`` (inclusive running sum of ``value`` in ``order``) and ``out_total``.

    With ``by`` the sum restarts per group; a group may span many ranges.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    # Finding the ranges reads the input once more, so it is stored first and never computed twice.
    known = materialize(df, f"unordered-{out}")
    staged = materialize(
        known.repartitionByRange(ranges, *[F.col(c) for c in by], *order).withColumn(
            _BUCKET, F.spark_partition_id()
        ),
        f"ordered-{out}",
    )
    # One row per range and group: at most (ranges + groups) rows.
    sums = staged.groupBy(*by, _BUCKET).agg(F.sum(value).alias("range_sum"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        _BUCKET,
        F.sum("range_sum").over(earlier).alias("range_offset"),
        F.sum("range_sum").over(whole).alias(f"{out}_total"),
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most `ranges` rows
    inside = (
        Window.partitionBy(*by, _BUCKET)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        staged.withColumn(out, F.sum(value).over(inside))
        .join(offsets, [*by, _BUCKET])
        .withColumn(out, F.col(out) + F.coalesce(F.col("range_offset"), F.lit(0)))
        .drop(_BUCKET, "range_offset")
    )


def exact_quantiles(
    df: DataFrame, value: str, key: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """Exact linearly interpolated quantiles of one column: rows (p, quantile)."""
    known = df.where(F.col(value).isNotNull()).select(*key, value, F.lit(1).cast("bigint").alias("one"))
    ranked = running_total(known, [F.col(value), *[F.col(k) for k in key]], "one", "rank")
    spots = ranked.select(
        F.col(value).alias("v"),
        (F.col("rank") - 1).alias("i"),
        (F.col("rank_total") - 1).alias("last"),
        F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p"),
    ).withColumn("at", F.col("p") * F.col("last"))
    near = spots.where((F.col("i") >= F.floor("at")) & (F.col("i") <= F.ceil("at")))
    low = F.max(F.when(F.col("i") == F.floor("at"), F.col("v")))
    high = F.max(F.when(F.col("i") == F.ceil("at"), F.col("v")))
    return near.groupBy("p", "at").agg(
        (low + (high - low) * (F.col("at") - F.floor("at"))).alias("quantile")
    ).drop("at")


def median_by_counts(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median from a table of distinct values and their counts.

    For values on a coarse grid (units, cents): the count is a plain partial/final
    aggregation, and the order is made over distinct values only, never the rows.
    """
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Distinct values may grow with the data: their running count is a prefix sum over ranges, not one task's window.
    placed = running_total(counts, [F.col("v")], "n", "upto", by=by).withColumnRenamed("upto_total", "total")
    lower, upper = F.expr("(total + 1) div 2"), F.expr("total div 2 + 1")

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("upto") >= position) & (F.col("upto") - F.col("n") < position), F.col("v")))

    return placed.groupBy(*by).agg(((at(lower) + at(upper)) / 2.0).alias(out))


def label_codes(sources: dict[str, DataFrame]) -> DataFrame:
    """Sorted distinct values of each column numbered from 0: rows (column_name, label, code).

    ``sources`` names a frame per column; dimension tables serve best, as they are small.
    """
    labels = None
    for name, df in sources.items():
        one = df.select(F.lit(name).alias("column_name"), F.col(name).alias("label")).distinct()
        labels = one if labels is None else labels.unionByName(one)
    ranked = running_total(
        labels.withColumn("one", F.lit(1).cast("bigint")), [F.col("label")], "one", "rank", by=["column_name"]
    )
    return ranked.select("column_name", "label", (F.col("rank") - 1).cast("int").alias("code"))
