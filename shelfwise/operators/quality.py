"""Data-quality rules and extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.functions.scalars import calendar_parts, tidy
from shelfwise.operators.policy import ALLOCATION_FACT

# Measures that may not be negative in an extract.
NON_NEGATIVE = (
    "safety_stock", "EOQ", "ROP", "DOH", "turnover", "annual_saving", "order_qty", "fulfilled", "Q_star",
)
# Columns of the main extract.
DASHBOARD = (
    "item_id", "store_id", "cat_id", "dept_id", "state_id", "abc_class", "xyz_class", "abc_xyz",
    "sell_price", "forecast_mean", "safety_stock", "EOQ", "ROP", "DOH", "turnover", "stockout_risk",
    "total_annual_cost_EOQ", "total_annual_cost_naive", "annual_saving", "annual_saving_pct", "best_model_used",
)
ERRORS = ("forecast_rmse", "forecast_bias")


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _text(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def clean_columns(df: DataFrame) -> DataFrame:
    """Column names without spaces."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def fill_nulls(df: DataFrame) -> DataFrame:
    """NULL to 0 in numbers and to UNKNOWN in text."""
    return df.na.fill(0, _numeric(df)).na.fill("UNKNOWN", _text(df))


def clean(df: DataFrame) -> DataFrame:
    """Extract form of a table."""
    return fill_nulls(clean_columns(df))


def clip_negative(df: DataFrame, columns: Sequence[str] = NON_NEGATIVE) -> DataFrame:
    """Negative values of the named measures become zero."""
    return df.withColumns(
        {c: F.when(F.col(c) < 0, F.lit(0).cast(t)).otherwise(F.col(c)) for c, t in df.dtypes if c in columns}
    )


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """NULLs per column, in one pass: (table_name, column_name, n_null)."""
    return _per_column(df, table, df.columns, lambda c: F.col(c).isNull(), "n_null")


def negative_counts(df: DataFrame, table: str, columns: Sequence[str] = NON_NEGATIVE) -> DataFrame:
    """Negative values per guarded measure: (table_name, column_name, n_clipped)."""
    return _per_column(df, table, [c for c in df.columns if c in columns], lambda c: F.col(c) < 0, "n_clipped")


def _per_column(df, table, columns, condition, name) -> DataFrame:
    sums = df.agg(*[F.coalesce(F.sum(condition(c).cast("bigint")), F.lit(0)).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias(name)) for i, c in enumerate(columns)]
    return sums.select(F.lit(table).alias("table_name"), F.explode(F.array(*rows)).alias("row")).select(
        "table_name", "row.*"
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames under each other, by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def expectation(check: str, expected: DataFrame, actual: DataFrame, tolerance: int = 0) -> DataFrame:
    """One row (check_name, expected, actual, ok) from two one-value frames."""
    both = actual.select(F.expr("*")).toDF("actual").withColumn("expected", expected.scalar())
    return both.select(
        F.lit(check).alias("check_name"),
        "expected",
        "actual",
        (F.abs(F.col("expected") - F.col("actual")) <= tolerance).cast("int").alias("ok"),
    )


def count_of(df: DataFrame) -> DataFrame:
    """Row count as a one-value frame."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def row_count_checks(
    series: DataFrame, dashboard: DataFrame, newsvendor: DataFrame, allocation: DataFrame, calendar: DataFrame,
    sales: DataFrame, n_scenarios: int, category: str = "FOODS",
) -> DataFrame:
    """Expected against actual sizes of the extracts; the calendar must have the days of the sales."""
    days = sales.agg(F.countDistinct("date").alias("n"))
    ab = dashboard.where(F.col("abc_class").isin("A", "B")).agg((F.count(F.lit(1)) * n_scenarios).alias("n"))
    return union_all(
        [
            expectation("dashboard_is_series", count_of(series), count_of(dashboard)),
            expectation("newsvendor_is_perishable", count_of(dashboard.where(F.col("cat_id") == category)), count_of(newsvendor)),
            expectation("newsvendor_only_perishable", dashboard.agg(F.lit(0).cast("bigint")), count_of(newsvendor.where(F.col("cat_id") != category))),
            expectation("allocation_is_scenarios_times_ab", ab, count_of(allocation)),
            expectation("calendar_days", days, count_of(calendar), tolerance=5),
        ]
    )


def orphan_ids(tables: dict[str, DataFrame], master: DataFrame, stores: DataFrame) -> DataFrame:
    """Items missing from the master and stores missing from the store dimension, per table.

    Every table is read once: the ids of both kinds leave it together, each task passes on only its different ones, and one join
    meets them with all known ids.
    """
    kinds = {"unknown_item": "item_id", "unexpected_store": "store_id"}
    both = F.array(*[F.struct(F.lit(kind).alias("problem"), F.col(c).alias("id")) for kind, c in kinds.items()])
    ids = union_all([df.select(F.lit(name).alias("table_name"), F.explode(both).alias("row")) for name, df in tables.items()])
    known = master.select(F.lit("unknown_item").alias("problem"), F.col("item_id").alias("id")).unionByName(
        stores.select(F.lit("unexpected_store").alias("problem"), F.col("store_id").alias("id"))
    )
    distinct = ids.select("table_name", "row.*").distinct()
    # Not an anti join: the optimizer would move it below the union and the distinct, once per table and to all rows.
    marked = distinct.join(known.distinct().withColumn("known", F.lit(True)), ["problem", "id"], "left")
    return marked.where(F.col("known").isNull()).select("table_name", "problem", "id")


def report(tables: dict[str, DataFrame], checks: DataFrame, orphans: DataFrame) -> DataFrame:
    """One row per rule with the number of findings; each table is read once for NULLs and negative values together."""
    count = lambda conditions: F.coalesce(F.sum(sum((c.cast("bigint") for c in conditions), F.lit(0))), F.lit(0))
    found = union_all(
        [
            df.agg(
                count([F.col(c).isNull() for c in df.columns]).alias("nulls"),
                count([F.coalesce(F.col(c) < 0, F.lit(False)) for c in df.columns if c in NON_NEGATIVE]).alias("negatives"),
            )
            for df in tables.values()
        ]
    )
    nulls, negatives = (found.agg(F.sum(c).alias("findings")) for c in ("nulls", "negatives"))
    spaces = checks.agg(F.lit(sum(" " in c for df in tables.values() for c in df.columns)).cast("bigint").alias("findings"))
    parts = (("null_values", nulls), ("negative_values", negatives), ("column_names", spaces))
    return rules(union_all([df.select(F.lit(rule).alias("rule"), "findings") for rule, df in parts]), checks, orphans)


def rules(values: DataFrame, checks: DataFrame, orphans: DataFrame) -> DataFrame:
    """Findings of the value rules, with the failed size checks and the stray ids under them."""
    failed = checks.agg(F.sum((F.col("ok") == 0).cast("bigint")).alias("findings"))
    strays = orphans.agg(F.count(F.lit(1)).alias("findings"))
    parts = (("row_counts", failed), ("id_consistency", strays))
    return union_all([values] + [df.select(F.lit(rule).alias("rule"), "findings") for rule, df in parts])


def label_coverage(labelled: DataFrame) -> DataFrame:
    """Share of rows that found a class."""
    return labelled.agg(
        F.count(F.lit(1)).alias("n_rows"),
        tidy(100.0 * F.avg(F.col("abc_class").isNotNull().cast("double")), 1).alias("pct_labelled"),
    )


def dashboard_columns(policy: DataFrame) -> DataFrame:
    """Columns of the main extract from a policy table that carries the forecast error."""
    return policy.select(*DASHBOARD, *ERRORS)


def dashboard_extract(policy: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Main extract: policy with forecast error, cleaned.

    The error columns come from ``stats`` when the policy table does not carry them.
    """
    if stats is None:
        return clean(dashboard_columns(policy))
    key = ["item_id", "store_id"]
    return clean(policy.select(*DASHBOARD).join(stats.select(*key, *ERRORS), key, "left"))


def calendar_extract(calendar: DataFrame) -> DataFrame:
    """Calendar with weekend, quarter and fiscal year (the calendar year), cleaned."""
    parts = calendar_parts(F.col("date"))
    return clean(
        calendar.withColumns(
            {"is_weekend": parts["is_weekend"], "quarter": parts["quarter"], "fiscal_year": parts["year"]}
        )
    )


def allocation_extract(allocation: DataFrame) -> DataFrame:
    """Allocation fact, cleaned."""
    return clean(allocation.select(*ALLOCATION_FACT))


def extract_summary(extracts: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each extract."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("extract"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
            )
            for name, df in extracts.items()
        ]
    )
