"""Every registered query: name to a function of (spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.functions.normal import norm_cdf, norm_ppf
from shelfwise.functions.scalars import calendar_parts, flag, own_state_flag, tidy
from shelfwise.operators import (
    accuracy,
    allocation,
    croston,
    extracts,
    features,
    ingest,
    inventory,
    kpi,
    newsvendor,
    ordering,
    policy,
    quality,
    reports,
    segment,
    selection,
    statistics,
    summary,
)
from shelfwise.params import DAY
from shelfwise.plans.retail import Retail
from shelfwise.schemas import STAR_TABLES
from shelfwise.session import drop_stages, listing, materialize, stage_database, stage_path
from shelfwise.sources import files, orders, tables

Builder = Callable[[Retail], DataFrame]
_BUILDERS: dict[str, Builder] = {}
_RUNS: dict[tuple, Retail] = {}
INPUTS = ("lineitem", "part", "supplier", "nation", "region")

Z98 = 2.053748910631822  # fixed value: normal quantile at 0.98


def retail(spark: SparkSession, sf_dir: str) -> Retail:
    """Stages of one data set, shared by the queries of a session. Changed input files are another data set."""
    key = (spark.sparkContext.applicationId, sf_dir, listing(spark, sf_dir, INPUTS))
    if key not in _RUNS:
        _RUNS[key] = Retail(spark, sf_dir)
    return _RUNS[key]


def forget(spark: SparkSession | None = None) -> None:
    """Forget built stages, so that the next query starts from the input tables; with a session, drop them too."""
    _RUNS.clear()
    if spark is not None:
        drop_stages(spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries by name."""
    def bind(build: Builder):
        return lambda spark, sf_dir: build(retail(spark, sf_dir))

    return {name: bind(build) for name, build in _BUILDERS.items()}


def _query(build: Builder) -> Builder:
    _BUILDERS[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison across engines."""
    return df.withColumns({c: tidy(c, digits) for c, t in df.dtypes if t == "double"})


# ---- sources, dimensions, facts ------------------------------------------------------


@_query
def scan_pruned(r):
    return orders.scan(r.spark, r.sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("units"), F.to_date("l_shipdate").alias("date")
    )


@_query
def store_slice(r):
    return ingest.store_slice(r.brand.sales_long, "AMERICA").select(
        "item_id", "cat_id", "state_id", "date", "wm_yr_wk", "units_sold", "sell_price"
    )


@_query
def dataset_profile(r):
    return statistics.dataset_profile(r.brand.fact_sales)


@_query
def footer_profile(r):
    """Profile of the order lines from file footers."""
    return files.footer_profile(r.spark, f"{r.sf_dir}/lineitem.parquet")


@_query
def sample_rows(r):
    """Five rows of the long table, in the order of its key."""
    return files.first_rows(r.brand.fact_sales.select("item_id", "store_id", "date", "units_sold"), ["item_id", "store_id", "date"])


@_query
def dim_date(r):
    return r.brand.dim_date


@_query
def dim_item(r):
    return r.fine.dim_item


@_query
def dim_store(r):
    return r.fine.dim_store


@_query
def price_scan_in(r):
    return tables.scan_in(
        r.fine.fact_prices, "store_id", ["AMERICA", "EUROPE"], ["item_id", "store_id", "wm_yr_wk", "sell_price"]
    )


@_query
def melt_wide_sales(r):
    """All days as columns and back: a wide table is stored from the fact, then melted."""
    first, last = r.brand.span
    history = F.sort_array(F.collect_list(F.struct("date", "units_sold")))["units_sold"]  # one per day
    series = r.brand.fact_sales.groupBy("item_id", "store_id").agg(history.alias("y"))
    days = [f"y[{n}] AS d_{n + 1}" for n in range((last - first).days + 1)]
    wide = materialize(series.selectExpr("item_id", "store_id", *days), "wide")
    return ingest.melt_wide(wide, ["item_id", "store_id"])


@_query
def calendar_features(r):
    parts = calendar_parts(F.col("date"))
    return r.brand.calendar.select(
        "date", *[p.alias(n) for n, p in parts.items()], parts["year"].alias("fiscal_year"),
        flag(F.col("event_name_1").isNotNull()).alias("is_event"),
    )


@_query
def state_flag(r):
    return r.brand.sales_dated.select(
        "item_id", "store_id", "date", "state_id", own_state_flag(F.col("state_id")).alias("is_snap")
    )


@_query
def date_iso(r):
    return tables.with_iso_date(r.brand.fact_sales).groupBy("date_text", "date_back").agg(
        F.sum("units_sold").alias("units_sold")
    )


@_query
def label_encode(r):
    return r.fine.codes


@_query
def sales_long(r):
    return r.brand.sales_long.select(
        "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "date", "wm_yr_wk", "weekday",
        F.col("wday").cast("int").alias("wday"), "event_name_1", "event_type_1", "units_sold", "sell_price",
    )


@_query
def time_split(r):
    train, val = ingest.time_split(r.brand.fact_sales, r.brand.cutoff)
    side = lambda df, name: df.groupBy("item_id", "store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("units_sold").alias("units"),
    ).withColumn("side", F.lit(name))
    return side(train, "train").unionByName(side(val, "val"))


@_query
def training_range(r):
    return kpi.training_range(r.brand.dim_date, (r.brand.cutoff - r.brand.first_date).days + 1)


# ---- files and tables: written to the stage folder, read back -------------------------


@_query
def csv_wide_scan(r):
    """Wide sales file and back to rows."""
    first, last = r.brand.span
    history = F.sort_array(F.collect_list(F.struct("date", "units_sold")))["units_sold"]  # one per day
    ids = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    series = r.brand.sales_with_ids.groupBy(*ids).agg(history.alias("y"))
    days = [f"y[{n}] AS d_{n + 1}" for n in range((last - first).days + 1)]
    path = stage_path(r.spark, "wide-csv")
    files.write_csv(series.selectExpr("concat(item_id, '_', store_id) AS id", *ids, *days), path)
    return ingest.melt_wide(files.scan_wide_csv(r.spark, path), ids).withColumn("units_sold", F.col("units_sold").cast("bigint"))


@_query
def csv_calendar_scan(r):
    path = stage_path(r.spark, "calendar-csv")
    files.write_csv(r.brand.calendar, path)
    calendar = files.scan_calendar(r.spark, path)
    return calendar.withColumns({c: F.col(c).cast("int") for c, t in calendar.dtypes if t in ("tinyint", "smallint")})


@_query
def csv_price_last(r):
    """Price file in which every key stands twice; the row that arrives last wins."""
    prices, path = r.brand.fact_prices, stage_path(r.spark, "price-csv")
    twice = prices.withColumn("turn", F.lit(1)).union(prices.withColumn("sell_price", F.lit(-1.0)).withColumn("turn", F.lit(0)))
    # Both rows of a key go to one file, in order: arrival is only defined within a file.
    ordered = twice.repartition("item_id", "store_id", "wm_yr_wk").sortWithinPartitions("turn", "item_id", "store_id", "wm_yr_wk")
    files.write_csv(ordered.select("store_id", "item_id", "wm_yr_wk", "sell_price"), path)
    return ingest.last_price(files.scan_prices(r.spark, path), "arrival")


@_query
def csv_price_arrivals(r):
    """Price files in three arrivals, the largest first and the right one last: Spark reads them by size, the last arrival wins."""
    prices, path = r.brand.fact_prices.select("store_id", "item_id", "wm_yr_wk", "sell_price"), stage_path(r.spark, "price-arrivals")
    wrong = prices.withColumn("sell_price", F.lit(-1.0))
    older = prices.where(F.pmod(F.xxhash64("item_id", "store_id", "wm_yr_wk"), F.lit(2)) == 0).withColumn("sell_price", F.lit(-2.0))
    for number, arrival in enumerate((wrong.union(wrong).union(wrong), older, prices)):
        files.write_csv(arrival, f"{path}/arrival={number}")
    return ingest.last_price(files.scan_prices(r.spark, f"{path}/*", by="name"), "arrival")


@_query
def parquet_by_store(r):
    """Parquet split by store, and a scan with the fixed schema."""
    path = stage_path(r.spark, "by-store")
    files.write_parquet(r.brand.fact_sales, path, partition_by=("store_id",))
    return files.scan_parquet(r.spark, path, STAR_TABLES["fact_sales"])


@_query
def star_tables(r):
    """Star tables created, filled in two appends, and joined."""
    star, database = r.brand, stage_database(r.spark, "star")
    tables.create_star(r.spark, database)
    for name in ("dim_date", "dim_item", "dim_store", "fact_prices"):
        tables.append_rows(getattr(star, name), f"{database}.{name}")
    half = F.col("date") <= F.lit(star.cutoff)
    for part in (half, ~half):
        tables.append_rows(star.fact_sales.where(part), f"{database}.fact_sales")
    read = lambda name: r.spark.table(f"{database}.{name}")
    rows = read("fact_sales").join(read("dim_date"), "date").join(read("dim_item"), "item_id").join(read("dim_store"), "store_id")
    rows = rows.join(read("fact_prices"), ["item_id", "store_id", "wm_yr_wk"], "left")
    return rows.select("item_id", "dept_id", "cat_id", "store_id", "state_id", "date", "wm_yr_wk", "units_sold", "sell_price")


@_query
def result_table(r):
    """A result table written twice: the second write replaces the first."""
    database = stage_database(r.spark, "results")
    r.spark.sql(f"CREATE DATABASE {database}")
    codes = r.fine.codes
    for df in (codes.where(F.col("code") == 0), codes):
        tables.replace_table(df, f"{database}.codes")
    return r.spark.table(f"{database}.codes")


@_query
def fact_loads(r):
    """Facts appended in two loads, of which the first is tried twice and a third is cut short before its ledger entry."""
    star, database = r.brand, stage_database(r.spark, "loads")
    r.spark.sql(f"CREATE DATABASE {database}")
    name, sales = f"{database}.fact_sales", star.fact_sales.select("item_id", "store_id", "date", "units_sold")
    tables.create_loads(r.spark, name, sales.schema)
    early = F.col("date") <= F.lit(star.cutoff)
    tables.append_once(sales.where(early), name, "early")
    tables.append_once(sales.where(early), name, "early")
    sales.where(early).limit(10).createOrReplaceTempView("cut_short")
    r.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (load_id = 'late') SELECT * FROM cut_short")
    tables.append_once(sales.where(~early), name, "late")
    r.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (load_id = 'unfinished') SELECT * FROM cut_short")
    r.spark.catalog.dropTempView("cut_short")
    return tables.loaded_rows(r.spark, name)


@_query
def csv_result(r):
    path = stage_path(r.spark, "result-csv")
    files.write_csv(r.fine.codes, path)
    return files.scan_csv(r.spark, path, r.fine.codes.schema)


@_query
def json_result(r):
    path = stage_path(r.spark, "result-json")
    files.write_json(r.fine.codes.select(F.to_json(F.struct("*")).alias("value")), path)
    return files.scan_json(r.spark, path, r.fine.codes.schema)


@_query
def long_schema(r):
    """The long table cast to its fixed schema; small integers are widened again for comparison."""
    rows = ingest.as_sales_long(r.brand.sales_long)
    return rows.withColumns({c: F.col(c).cast("int") for c, t in rows.dtypes if t in ("tinyint", "smallint")})


# ---- SQL reports ---------------------------------------------------------------------


def _star(r, *names):
    return [getattr(r.fine, n) for n in names]


@_query
def sales_by_category_month(r):
    return reports.sales_by_category_month(*_star(r, "fact_sales", "dim_date", "dim_item", "fact_prices"))


@_query
def zero_sales_percentage(r):
    return reports.zero_sales_percentage(r.fine.fact_sales)


@_query
def top_items_revenue(r):
    return reports.top_items_revenue(*_star(r, "fact_sales", "dim_date", "dim_item", "fact_prices"))


@_query
def snap_impact(r):
    return reports.snap_impact(*_star(r, "fact_sales", "dim_date", "dim_item", "dim_store"))


def _last_full_year(r):
    """The fact split by year, and the days of the last year that the data hold as a whole."""
    year = r.fine.span[1].year - 1
    return r.fine.fact_sales_by_year, r.fine.dates_of_year(year)


@_query
def category_months_of_year(r):
    """Units and revenue by category and month of one year: one year of the fact is read."""
    return reports.sales_by_category_month(*_last_full_year(r), *_star(r, "dim_item", "fact_prices"))


@_query
def snap_impact_of_year(r):
    """Benefit-day uplift of one year: one year of the fact is read."""
    return reports.snap_impact(*_last_full_year(r), *_star(r, "dim_item", "dim_store"))


@_query
def event_day_sales(r):
    """Units and revenue by category and month of the national holidays since the last full year: years are found at run time."""
    since = r.fine.span[1].replace(month=1, day=1) - dt.timedelta(days=365)
    days = r.fine.dim_date.where((F.col("event_type_1") == "National") & (F.col("date") >= F.lit(since)))
    return reports.sales_by_category_month(r.fine.fact_sales_by_year, days, *_star(r, "dim_item", "fact_prices"))


@_query
def price_trend(r):
    return reports.price_trend(*_star(r, "fact_prices", "dim_date", "dim_item"))


@_query
def fc_mae_by_category(r):
    return rounded(reports.forecast_mae_by_category(r.weekly.fact, r.brand.dim_item))


@_query
def fc_count_by_segment(r):
    return reports.forecast_count_by_segment(r.weekly.fact)


@_query
def fc_worst_series(r):
    return rounded(reports.worst_series(r.weekly.fact))


@_query
def policy_avg_by_abc(r):
    return reports.policy_avg_by_abc(r.inventory.fact_policy)


@_query
def risk_by_category(r):
    return reports.risk_by_category(r.inventory.fact_policy)


@_query
def cost_by_category(r):
    return reports.cost_by_category(r.inventory.fact_policy)


@_query
def newsvendor_summary(r):
    return reports.newsvendor_summary(r.inventory.fact_newsvendor)


@_query
def lp_fill_rate(r):
    return reports.fill_rate_by_scenario(r.inventory.fact_allocation)


@_query
def fact_row_counts(r):
    return reports.row_counts(
        {
            "fact_inventory_policy": r.inventory.fact_policy,
            "fact_newsvendor": r.inventory.fact_newsvendor,
            "fact_allocation": r.inventory.fact_allocation,
            "fact_forecasts": r.weekly.fact,
        }
    )


# ---- exploratory statistics and classes ----------------------------------------------


@_query
def basic_stats(r):
    return statistics.basic_stats(r.fine.sales_dated)


@_query
def dataset_overview(r):
    return statistics.dataset_overview(r.fine.sales_dated)


@_query
def zero_share_over_40(r):
    return statistics.zero_share_over(r.fine.sales_dated)


@_query
def zero_share_hist(r):
    return statistics.zero_share_hist(r.fine.sales_dated)


@_query
def seasonality_dow(r):
    return statistics.seasonality(r.fine.sales_dated, "day_of_week")


@_query
def seasonality_month(r):
    return statistics.seasonality(r.fine.sales_dated, "month")


@_query
def snap_lift_overall(r):
    return statistics.snap_lift_overall(r.fine.sales_dated)


@_query
def series_cv(r):
    return rounded(segment.with_variation(segment.series_totals(r.daily_fine.valued)).drop("total_revenue"), 6)


@_query
def series_cv_merged(r):
    """Variability from stored partial sums: three batches of days, the second added twice."""
    panel, cutoff = r.daily_fine.valued, r.fine.cutoff
    sums = segment.SeriesAccumulator(stage_path(r.spark, "series-sums"))
    days = F.datediff(F.col("date"), F.lit(cutoff))
    for batch, use in (("old", days <= -365), ("year", (days > -365) & (days <= 0)), ("year", (days > -365) & (days <= 0)), ("new", days > 0)):
        sums.add(panel.where(use), batch)
    return rounded(segment.with_variation(sums.totals(r.spark)).drop("total_revenue"), 6)


@_query
def abc_class(r):
    ranked = segment.with_abc(segment.series_totals(r.daily_fine.valued))
    return ranked.select(
        "item_id", "store_id", F.col("total_revenue").cast("double").alias("total_revenue"),
        tidy(F.col("cum_revenue").cast("double") / F.col("cum_revenue_total").cast("double"), 6).alias("cum_share"),
        "abc_class",
    )


@_query
def abc_class_by_store(r):
    ranked = segment.with_abc(segment.series_totals(r.daily_fine.valued), scope=["store_id"])
    return ranked.select("item_id", "store_id", "abc_class")


@_query
def abc_xyz(r):
    return rounded(r.weekly.labels.withColumn("total_revenue", F.col("total_revenue").cast("double")), 6)


@_query
def abc_xyz_matrix(r):
    return segment.segment_matrix(r.weekly.labels)


@_query
def method_assignment(r):
    return statistics.method_assignment(r.weekly.labels)


@_query
def segment_method_map(r):
    return statistics.segment_methods(r.weekly.labels)


@_query
def dq_label_coverage(r):
    return quality.label_coverage(ingest.attach_labels(r.brand.fact_sales, r.weekly.labels))


# ---- features ------------------------------------------------------------------------


@_query
def lag_features(r):
    return features.with_lags(r.brand.fact_sales)


@_query
def rolling_features(r):
    lagged = features.with_lags(r.brand.fact_sales)
    return rounded(features.with_rolling(lagged).drop(*[f"lag_{n}" for n in DAY.lags]))


@_query
def price_vs_mean(r):
    return rounded(features.with_price_vs_mean(r.brand.sales_long).select("item_id", "store_id", "date", "price_vs_mean"))


@_query
def price_change(r):
    return rounded(features.prepare(r.brand.sales_with_change, r.weekly.series).select("item_id", "store_id", "date", "price_change"))


@_query
def model_features(r):
    return rounded(r.daily.features.select("item_id", "store_id", "date", "units_sold", *features.feature_columns()))


@_query
def last28_mean(r):
    return rounded(features.last_mean(r.daily_fine.train, DAY.tail))


# ---- forecasts -----------------------------------------------------------------------


@_query
def seasonal_naive(r):
    return r.daily.naive


@_query
def seasonal_naive_weekly(r):
    return r.weekly.naive


@_query
def ets_forecast(r):
    return rounded(r.daily.ets)


@_query
def croston_sba(r):
    return rounded(croston.croston_sba(r.daily_fine.train).drop("plain_mean"), 6)


@_query
def zclass_series(r):
    return croston.intermittent_series(r.weekly.labels, r.weekly.train)


@_query
def croston_forecasts(r):
    return rounded(r.daily_fine.croston, 6)


@_query
def gbt_forecast(r):
    return rounded(r.daily.trees)


@_query
def gbt_forecast_check(r):
    """What SQL can decide about the tree forecasts: rows, actuals, and that every value is a usable one."""
    value = F.col("gbt_forecast")
    return r.daily.trees.select(
        "item_id", "store_id", "date", "cat_id", "abc_xyz", "actual",
        flag(value.isNotNull() & ~F.isnan(value) & (value < float("inf"))).alias("is_finite"), flag(value >= 0).alias("is_not_negative"),
    )


@_query
def gbt_beats_naive(r):
    """Per scope, whether the trees have a lower error than the seasonal naive forecast."""
    return r.daily.tree_improvement.select("scope", flag(F.col("improvement_pct") > 0).alias("improves"))


@_query
def improvement_trees(r):
    return rounded(r.daily.tree_improvement)


@_query
def gbt_importance(r):
    return rounded(r.daily.importance, 6)


@_query
def gbt_importance_check(r):
    """Fifteen known inputs, by falling gain, none negative."""
    ordered = Window.partitionBy(F.lit(0)).orderBy(F.desc("gain"), "feature")  # fifteen rows
    return r.daily.importance.select(
        F.row_number().over(ordered).alias("place"), flag(F.col("feature").isin(*features.feature_columns())).alias("is_input"),
        flag(F.col("gain") >= 0).alias("is_not_negative"), flag(F.col("gain") <= F.lag("gain", 1, 1.0).over(ordered)).alias("is_ordered"),
    )


@_query
def accuracy_by_category(r):
    return rounded(r.weekly.metrics_long)


@_query
def model_comparison(r):
    return r.weekly.comparison


@_query
def model_comparison_all(r):
    return r.daily.all_models


@_query
def fact_forecasts_all(r):
    """The fact with all four models; of the tree values, what SQL can decide."""
    fact = r.daily.fact_all
    near = lambda a, b: flag(F.abs(a - b) <= 1e-9 * (1 + F.abs(b)))
    error = F.col("best_forecast") - F.col("actual_units")
    return rounded(
        fact.select(
            "item_id", "store_id", "date", "actual_units", "seasonal_naive_forecast", "ets_forecast", "croston_forecast",
            flag(F.col("gbt_forecast").isNotNull() & (F.col("gbt_forecast") >= 0)).alias("has_trees"),
            near(F.col("forecast_error"), error).alias("error_fits"), near(F.col("abs_error"), F.abs(error)).alias("abs_error_fits"),
            "abc_class", "xyz_class", "abc_xyz",
        )
    )


@_query
def best_forecast_all(r):
    """Which model was chosen, and that the chosen value is that model's."""
    chosen = F.when(F.col("best_model_used") == "Croston_SBA", F.col("croston_forecast")).otherwise(F.col("gbt_forecast"))
    return r.daily.best_all.select("item_id", "store_id", "date", "abc_xyz", "best_model_used", flag(F.col("best_forecast") == chosen).alias("is_chosen"))


@_query
def metric_display(r):
    return accuracy.metric_display(r.weekly.comparison)


@_query
def improvement_pct(r):
    return rounded(r.weekly.improvement)


@_query
def forecast_wide(r):
    return rounded(r.weekly.wide)


@_query
def best_forecast(r):
    return rounded(
        r.weekly.best.select("item_id", "store_id", "date", "abc_xyz", "best_forecast", "best_model_used")
    )


@_query
def fact_forecasts(r):
    return rounded(r.weekly.fact)


@_query
def forecast_error_stats(r):
    return rounded(r.inventory.error_stats)


@_query
def item_price_median(r):
    return rounded(selection.median_price(r.fine.fact_prices))


@_query
def item_forecast_stats(r):
    return rounded(r.inventory.stats)


@_query
def error_std_quantiles(r):
    stats = r.inventory.costs
    return rounded(
        ordering.exact_quantiles(stats, "forecast_error_std", ["item_id", "store_id"], [0, 0.25, 0.5, 0.75, 1])
    )


@_query
def bias_summary(r):
    return statistics.bias_summary(r.inventory.costs)


# ---- inventory -----------------------------------------------------------------------


@_query
def service_level_map(r):
    return r.inventory.costs.select("item_id", "store_id", "abc_class", inventory.service_level().alias("service_level"))


@_query
def normal_ppf(r):
    """Normal score of each series' cumulative revenue share; the last share is 1 and has none."""
    ranked = segment.with_abc(segment.series_totals(r.daily_fine.valued))
    share = F.col("cum_revenue").cast("double") / F.col("cum_revenue_total").cast("double")
    scored = ranked.withColumn("share", share)
    return rounded(
        scored.select("item_id", "store_id", norm_ppf(F.col("share")).alias("z"), norm_ppf(F.col("share"), 100.0, 15.0).alias("scaled"))
    )


@_query
def normal_cdf(r):
    """Probability that a series' demand stays below every observed weekly value."""
    totals = segment.with_variation(segment.series_totals(r.weekly.valued)).select("item_id", "store_id", "mean_units", "std_units")
    rows = r.weekly.panel.join(totals, ["item_id", "store_id"])
    below = norm_cdf(F.col("units_sold").cast("double"), F.col("mean_units"), F.col("std_units"))
    return rounded(rows.select("item_id", "store_id", "date", below.alias("probability")), 6)


@_query
def safety_stock(r):
    return rounded(
        r.inventory.costs.select(
            "item_id", "store_id", "abc_class", "service_level", "Z_score", "sigma_L", "safety_stock", "ss_holding_cost",
            *[f"{c}_{v}" for v in (90, 95, 98) for c in ("safety_stock", "ss_cost")],
        )
    )


@_query
def service_level_curve(r):
    return inventory.service_level_curve(r.inventory.costs)


@_query
def safety_stock_rollups(r):
    return inventory.safety_stock_rollups(r.inventory.costs)


@_query
def top_safety_stock(r):
    return rounded(
        inventory.largest(r.inventory.costs, "safety_stock", 10).select(
            "item_id", "store_id", "cat_id", "abc_class", "xyz_class", "forecast_error_std", "safety_stock", "ss_holding_cost"
        )
    )


@_query
def eoq(r):
    return rounded(r.inventory.costs.select("item_id", "store_id", "forecast_mean", "D_annual", "sell_price", "holding_cost_per_unit", "EOQ"))


@_query
def eoq_cost(r):
    return rounded(
        r.inventory.costs.select(
            "item_id", "store_id", "annual_ordering_cost", "annual_holding_cost", "total_annual_cost_EOQ",
            "annual_ordering_cost_naive", "annual_holding_cost_naive", "total_annual_cost_naive",
            "cost_saving_vs_naive", "cost_saving_pct",
        )
    )


@_query
def eoq_by_category(r):
    return inventory.eoq_by_category(r.inventory.costs)


@_query
def top_eoq_saving(r):
    return rounded(
        inventory.largest(r.inventory.costs, "cost_saving_vs_naive", 10).select(
            "item_id", "store_id", "cat_id", "abc_class", "forecast_mean", "EOQ", "cost_saving_vs_naive", "cost_saving_pct"
        )
    )


@_query
def eoq_sensitivity(r):
    return rounded(inventory.eoq_sensitivity(r.inventory.costs))


@_query
def reorder_point(r):
    return rounded(
        r.inventory.costs.select(
            "item_id", "store_id", "demand_during_lead_time", "ROP", "naive_current_stock", "stockout_risk", "DOH", "turnover"
        )
    )


@_query
def stockout_risk_by_abc(r):
    return inventory.stockout_risk_by_abc(r.inventory.costs)


@_query
def doh_turnover_by_category(r):
    return inventory.doh_turnover_by_category(r.inventory.costs)


@_query
def a_class_at_risk(r):
    return rounded(inventory.a_class_at_risk(r.inventory.costs))


@_query
def newsvendor_orders(r):
    return rounded(
        r.inventory.newsvendor.select(
            "item_id", "store_id", "Cu", "Co", "CR", "demand_std", "Q_star", "q_difference", "q_difference_pct"
        )
    )


@_query
def newsvendor_profit(r):
    return rounded(
        r.inventory.newsvendor.select(
            "item_id", "store_id", "expected_sales", "expected_leftover", "expected_stockout",
            "expected_profit_newsvendor", "expected_profit_eoq", "profit_improvement", "profit_improvement_pct",
        ),
        3,
    )


@_query
def newsvendor_rollup(r):
    return newsvendor.newsvendor_rollup(r.inventory.newsvendor)


@_query
def top_newsvendor_gain(r):
    return rounded(
        inventory.largest(r.inventory.newsvendor, "profit_improvement", 10).select(
            "item_id", "store_id", "abc_class", "CR", "Q_star", "EOQ", "profit_improvement", "profit_improvement_pct"
        ),
        3,
    )


@_query
def budget_allocation(r):
    return rounded(r.inventory.allocation, 3)


@_query
def budget_scenarios(r):
    return allocation.budget_scenarios(r.inventory.allocation)


@_query
def policy_comparison(r):
    return rounded(
        r.inventory.costs.select(
            "item_id", "store_id", "naive_order_frequency", "naive_annual_ordering_cost", "naive_annual_holding_cost",
            "naive_stockout_cost", "naive_total_cost", "optimized_stockout_cost", "optimized_total_cost",
            "annual_saving", "annual_saving_pct",
        ),
        3,
    )


@_query
def policy_by_category(r):
    return policy.policy_rollup(r.inventory.costs, "cat_id")


@_query
def policy_by_abc(r):
    return policy.policy_rollup(r.inventory.costs, "abc_class")


@_query
def policy_components(r):
    return policy.policy_components(r.inventory.costs)


@_query
def policy_drivers(r):
    return policy.policy_drivers(r.inventory.costs)


@_query
def target_fill_rate(r):
    return policy.target_fill_rate(r.inventory.costs)


@_query
def top_saving_pct(r):
    top = inventory.largest(r.inventory.costs, "annual_saving_pct", 20)
    label = F.concat("item_id", F.lit(" @"), "store_id")
    return rounded(top.select(label.alias("label"), "annual_saving_pct"))


@_query
def fact_inventory_policy(r):
    return rounded(r.inventory.fact_policy, 3)


@_query
def policy_joined(r):
    """The policy fact put together from separate tables: the cost table has the naive cost of half of the series, and the other table a wrong one for these."""
    costs, key = r.inventory.costs, ["item_id", "store_id"]
    known, naive = F.pmod(F.xxhash64(*key), F.lit(2)) == 0, F.col("total_annual_cost_naive")
    reorder = costs.drop("annual_saving", "annual_saving_pct", "best_model_used").withColumn("total_annual_cost_naive", F.when(known, -1.0).otherwise(naive))
    gaps = costs.withColumn("total_annual_cost_naive", F.when(known, naive))
    return rounded(policy.join_policy(reorder, gaps, costs.select(*key, "best_model_used")), 3)


@_query
def summary_values(r):
    """The computable figures of the summary document as rows."""
    inv, weekly = r.inventory, r.weekly
    return summary.summary_values(inv.validated, inv.costs, inv.newsvendor, weekly.comparison, weekly.improvement)


@_query
def fact_newsvendor(r):
    return rounded(r.inventory.fact_newsvendor, 3)


@_query
def fact_allocation(r):
    return rounded(r.inventory.fact_allocation, 3)


# ---- data quality and extracts -------------------------------------------------------


EXTRACTS = ("dashboard", "policy", "newsvendor", "allocation", "calendar")
JUDGED = ("fact_forecasts", "policy", "newsvendor", "allocation", "calendar")  # whose values the quality gate judges


def _extracts(r, names):
    return {name: r.inventory.extract(name) for name in names}


def _checks(r):
    return extracts.row_count_checks(r.weekly.labels, _extracts(r, EXTRACTS), r.brand.fact_sales, len(r.inventory.params.budgets))


def _orphans(r):
    found = _extracts(r, ("policy", "newsvendor", "allocation", "fact_forecasts"))
    return quality.orphan_ids({name: e.rows for name, e in found.items()}, r.inventory.extract("dashboard").rows, r.brand.dim_store)


@_query
def dq_fill_nulls(r):
    return rounded(quality.fill_nulls(r.weekly.fact))


@_query
def dq_null_counts(r):
    seen = extracts.null_counts(r.spark, _extracts(r, JUDGED))
    return seen.unionByName(quality.null_counts(r.brand.sales_long, "sales_long"))


@_query
def dq_clip_negative(r):
    return rounded(quality.clip_negative(r.inventory.fact_policy).select("item_id", "store_id", "safety_stock", "EOQ", "ROP", "DOH", "turnover", "annual_saving"), 3)


@_query
def dq_clip_counts(r):
    return extracts.negative_counts(r.spark, _extracts(r, ("policy", "newsvendor", "allocation")))


@_query
def dq_clean_columns(r):
    return rounded(quality.clean(r.weekly.croston_metrics))


@_query
def dq_row_counts(r):
    return _checks(r)


@_query
def dq_orphan_ids(r):
    return _orphans(r)


@_query
def dq_report(r):
    return extracts.report(_extracts(r, JUDGED), JUDGED, _checks(r), _orphans(r))


@_query
def extract_dashboard(r):
    return rounded(r.inventory.extract("dashboard").rows, 3)


@_query
def extract_policy(r):
    return rounded(r.inventory.extract("policy").rows, 3)


@_query
def extract_newsvendor(r):
    return rounded(r.inventory.extract("newsvendor").rows, 3)


@_query
def extract_allocation(r):
    return rounded(r.inventory.extract("allocation").rows, 3)


@_query
def extract_calendar(r):
    calendar = r.inventory.extract("calendar").rows
    return calendar.withColumns({c: F.col(c).cast("int") for c, t in calendar.dtypes if t in ("tinyint", "smallint")})


@_query
def extract_summary(r):
    return extracts.summary(r.spark, _extracts(r, EXTRACTS))


# ---- dashboard figures ---------------------------------------------------------------


@_query
def kpi_filter(r):
    picked = kpi.kpi_filter(r.inventory.validated, ["A", "B"], ["FOODS", "HOBBIES"], "at-risk")
    return rounded(picked.select("item_id", "store_id", "cat_id", "abc_class", "stockout_risk", "ROP"))


@_query
def kpi_cost_reduction(r):
    return kpi.cost_reduction(r.inventory.validated)


@_query
def kpi_executive(r):
    return kpi.executive(r.inventory.validated)


@_query
def kpi_cost_by_category(r):
    return kpi.cost_by_category(r.inventory.validated)


@_query
def kpi_ss_by_abc(r):
    return kpi.safety_stock_by_abc(r.inventory.validated)


@_query
def kpi_segment_counts(r):
    return kpi.segment_counts(r.inventory.validated)


@_query
def kpi_policy_means(r):
    return kpi.policy_means(r.inventory.validated)


@_query
def kpi_category_abc(r):
    return kpi.category_abc(r.inventory.validated)


@_query
def kpi_item_table(r):
    return kpi.item_table(r.inventory.validated)


@_query
def kpi_at_risk(r):
    return kpi.at_risk(r.inventory.validated)


@_query
def a_class_priority(r):
    return kpi.a_class_priority(r.inventory.validated)


@_query
def kpi_risk_abc(r):
    return kpi.risk_by_abc(r.inventory.validated)


@_query
def risk_rank(r):
    return kpi.risk_rank(r.inventory.validated)


@_query
def kpi_risk_category(r):
    return kpi.risk_by_category(r.inventory.validated)


@_query
def kpi_saving_category(r):
    return kpi.saving_by_category(r.inventory.validated)


@_query
def kpi_cost_summary(r):
    return kpi.cost_summary(r.inventory.validated)


@_query
def kpi_scenarios(r):
    return kpi.scenarios(r.inventory.allocation)


@_query
def ss_error_slope(r):
    return kpi.error_slope(r.inventory.validated, r.inventory.costs)


@_query
def ss_error_trend(r):
    return kpi.error_trend(r.inventory.validated, r.inventory.costs)


@_query
def insight_error_vs_raw(r):
    return kpi.error_vs_raw(r.inventory.costs, r.inventory.params.lead_time, Z98)


@_query
def inventory_stats(r):
    return kpi.inventory_stats(r.inventory.validated)


@_query
def croston_coverage(r):
    return kpi.croston_coverage(r.inventory.validated)


@_query
def summary_document(r):
    inv = r.inventory
    return summary.summary_document(
        inv.validated, inv.costs, inv.newsvendor,
        kpi.training_range(r.brand.dim_date, (r.brand.cutoff - r.brand.first_date).days + 1),
        r.weekly.comparison, r.weekly.improvement,
        kpi.error_vs_raw(inv.costs, inv.params.lead_time, Z98), inv.params,
        r.daily.tree_metrics, r.daily.tree_improvement,
    )
