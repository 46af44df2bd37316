"""Extracts written once; the figures of the quality gate are gathered in the write itself."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from shelfwise.operators import quality
from shelfwise.session import materialize


@dataclass(frozen=True)
class Extract:
    """A written extract and what its write has seen.

    ``nulls`` and ``negatives`` (by column) are those of the rows as they came, before anything was filled or clipped; ``n_rows`` and
    ``matches`` (by name of a condition) are those of the rows as they were written.
    """

    rows: DataFrame
    n_rows: int
    nulls: dict[str, int]
    negatives: dict[str, int]
    matches: dict[str, int] = field(default_factory=dict)


def write_extract(
    raw: DataFrame, name: str, finish: Callable[[DataFrame], DataFrame] = quality.clean, conditions: dict[str, Column] | None = None
) -> Extract:
    """Write ``finish(raw)`` and count on the way, so that no rule has to read the extract again.

    The counts are observed metrics of the writing job. Its last stage has no shuffle above the counters, and Spark enters the counters
    of a partition when its first attempt succeeds, so retried and speculative tasks are not counted twice. Each counter is one number per
    task, however large the table; an empty table counts zero everywhere.
    """
    conditions = conditions or {}
    guarded = [c for c in raw.columns if c in quality.NON_NEGATIVE]
    came, left = Observation(f"came-{uuid.uuid4().hex}"), Observation(f"left-{uuid.uuid4().hex}")
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, c in enumerate(raw.columns)]
    negatives = [F.count_if(F.col(f"`{c}`") < 0).alias(f"negative{i}") for i, c in enumerate(guarded)]
    met = [F.count_if(condition).alias(f"met{i}") for i, condition in enumerate(conditions.values())]
    finished = finish(raw.observe(came, *nulls, *negatives)).observe(left, F.count(F.lit(1)).alias("n"), *met)
    rows = materialize(finished, f"extract-{name}")
    before, after = came.get, left.get
    return Extract(
        rows,
        after["n"],
        {c: before[f"null{i}"] for i, c in enumerate(raw.columns)},
        {c: before[f"negative{i}"] for i, c in enumerate(guarded)},
        {c: after[f"met{i}"] for i, c in enumerate(conditions)},
    )


def _per_column(spark: SparkSession, found: dict[str, dict[str, int]], name: str) -> DataFrame:
    rows = [(table, column, n) for table, columns in found.items() for column, n in columns.items()]
    return spark.createDataFrame(rows, f"table_name string, column_name string, {name} bigint")


def null_counts(spark: SparkSession, extracts: dict[str, Extract]) -> DataFrame:
    """NULLs per column as seen by the writes: (table_name, column_name, n_null)."""
    return _per_column(spark, {t: e.nulls for t, e in extracts.items()}, "n_null")


def negative_counts(spark: SparkSession, extracts: dict[str, Extract]) -> DataFrame:
    """Negative values per guarded measure as seen by the writes: (table_name, column_name, n_clipped)."""
    return _per_column(spark, {t: e.negatives for t, e in extracts.items()}, "n_clipped")


def summary(spark: SparkSession, extracts: dict[str, Extract]) -> DataFrame:
    """Rows and columns of each extract: (extract, n_rows, n_columns)."""
    rows = [(name, e.n_rows, len(e.rows.columns)) for name, e in extracts.items()]
    return spark.createDataFrame(rows, "extract string, n_rows bigint, n_columns int")


def gate_conditions(category: str = "FOODS") -> dict[str, dict[str, Column]]:
    """What the writes count besides rows, by extract, for ``row_count_checks``."""
    return {
        "dashboard": {"funded": F.col("abc_class").isin("A", "B"), "perishable": F.col("cat_id") == category},
        "newsvendor": {"foreign": F.col("cat_id") != category},
    }


def row_count_checks(series: DataFrame, extracts: dict[str, Extract], sales: DataFrame, n_scenarios: int) -> DataFrame:
    """Expected against actual sizes; only the two frames that are no extracts are read."""
    board, vendor = extracts["dashboard"], extracts["newsvendor"]
    spark = series.sparkSession
    one = lambda n: spark.range(1).select(F.lit(n).cast("bigint").alias("n"))
    return quality.union_all(
        [
            quality.expectation("dashboard_is_series", quality.count_of(series), one(board.n_rows)),
            quality.expectation("newsvendor_is_perishable", one(board.matches["perishable"]), one(vendor.n_rows)),
            quality.expectation("newsvendor_only_perishable", one(0), one(vendor.matches["foreign"])),
            quality.expectation(
                "allocation_is_scenarios_times_ab", one(board.matches["funded"] * n_scenarios), one(extracts["allocation"].n_rows)
            ),
            quality.expectation(
                "calendar_days", sales.agg(F.countDistinct("date").alias("n")), one(extracts["calendar"].n_rows), tolerance=5
            ),
        ]
    )


def report(extracts: dict[str, Extract], names: Sequence[str], checks: DataFrame, orphans: DataFrame) -> DataFrame:
    """One row per rule with the number of findings in the named extracts, from what their writes have seen."""
    found = [extracts[n] for n in names]
    spark = checks.sparkSession
    values = [
        ("null_values", sum(sum(e.nulls.values()) for e in found)),
        ("negative_values", sum(sum(e.negatives.values()) for e in found)),
        ("column_names", sum(" " in c for e in found for c in e.nulls)),
    ]
    return quality.rules(spark.createDataFrame(values, "rule string, findings bigint"), checks, orphans)
