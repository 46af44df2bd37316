"""The pipeline from order lines to inventory decisions.

Each stage is a lazily built frame. Stages that several later ones read are written once
as stage tables: the observed sales and the two facts (the load step), the series classes
and the policy frame, which are tiny beside the facts. Everything else stays a plan.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators import (
    accuracy,
    allocation,
    croston,
    extracts,
    features,
    ingest,
    inventory,
    naive,
    newsvendor,
    ordering,
    policy,
    quality,
    segment,
    selection,
    smoothing,
    trees,
)
from shelfwise.params import DAY, SERIES_KEY, WEEK, WEEKLY_POLICY, PolicyParams, TimeGrain
from shelfwise.session import materialize, tune
from shelfwise.sources import orders


class Star:
    """Star schema of one item grain: three dimensions, two facts, and the long table."""

    def __init__(self, spark: SparkSession, sf_dir: str, grain: str = "brand"):
        self.spark, self.sf_dir, self.grain = tune(spark), sf_dir, grain

    @cached_property
    def observed(self) -> DataFrame:
        return materialize(orders.observed_sales(self.spark, self.sf_dir, self.grain), "observed")

    @cached_property
    def span(self) -> tuple[dt.date, dt.date]:
        """First and last day: one row for the driver, so that cutoffs are literals in every plan."""
        row = self.observed.agg(F.min("date"), F.max("date")).first()
        return row[0], row[1]

    @property
    def first_date(self) -> dt.date:
        return self.span[0]

    @property
    def cutoff(self) -> dt.date:
        """Last training day; the 28 days after it are for validation."""
        return self.span[1] - dt.timedelta(days=DAY.horizon)

    @cached_property
    def calendar(self) -> DataFrame:
        return orders.calendar(self.spark, *self.span)

    @cached_property
    def dim_date(self) -> DataFrame:
        return ingest.build_dim_date(self.calendar)

    @cached_property
    def dim_item(self) -> DataFrame:
        rows = self.observed.select("item_id").withColumns(orders.hierarchy(F.col("item_id")))
        return ingest.build_dim(rows, "item_id", ["dept_id", "cat_id"])

    @cached_property
    def dim_store(self) -> DataFrame:
        rows = self.observed.select("store_id", orders.state_of(F.col("store_id")).alias("state_id"))
        return ingest.build_dim(rows, "store_id", ["state_id"])

    @cached_property
    def fact_sales_by_year(self) -> DataFrame:
        """Stored in buckets by series, as nearly every later step works per series, and in folders by year, for reports on a period."""
        rows = ingest.dense_sales(self.observed, *self.span).withColumn(ingest.YEAR_PART, F.year("date"))
        return materialize(rows, "fact_sales", SERIES_KEY, partition_by=(ingest.YEAR_PART,))

    @property
    def fact_sales(self) -> DataFrame:
        return self.fact_sales_by_year.drop(ingest.YEAR_PART)

    def dates_of_year(self, year: int) -> DataFrame:
        return self.dim_date.where(F.col("year") == year)

    @cached_property
    def fact_prices(self) -> DataFrame:
        return materialize(orders.weekly_prices(self.observed), "fact_prices", SERIES_KEY)

    @cached_property
    def sales_with_ids(self) -> DataFrame:
        """Daily sales with item and store hierarchy."""
        item = orders.hierarchy(F.col("item_id"))
        return self.fact_sales.withColumns({**item, "state_id": orders.state_of(F.col("store_id"))})

    @cached_property
    def sales_dated(self) -> DataFrame:
        """Daily sales with hierarchy and calendar, for results that need no price."""
        return self.sales_with_ids.join(F.broadcast(self.calendar), "date", "left")

    @cached_property
    def sales_long(self) -> DataFrame:
        """Daily sales with hierarchy, calendar and price."""
        return ingest.enrich_sales(self.sales_with_ids, self.calendar, self.fact_prices, on="date")

    @cached_property
    def sales_with_change(self) -> DataFrame:
        """The long table with the weekly price change."""
        steps = features.price_steps(self.fact_prices, self.calendar)
        return ingest.enrich_sales(self.sales_with_ids, self.calendar, steps, on="date")

    @cached_property
    def codes(self) -> DataFrame:
        """Label codes of the text columns, from the dimensions."""
        dims = {c: self.dim_item for c in ("item_id", "dept_id", "cat_id")}
        dims.update({c: self.dim_store for c in ("store_id", "state_id")})
        return materialize(ordering.label_codes(dims), "codes")

    def coded(self, series: DataFrame) -> DataFrame:
        """Codes per series; the coded dimensions are stored, so their sizes are known."""
        items = materialize(features.coded_dimension(self.dim_item, self.codes), "item_codes")
        stores = materialize(features.coded_dimension(self.dim_store, self.codes), "store_codes")
        return features.coded_series(series, items, stores)


class Forecasting:
    """Classes, features and models at one time grain."""

    def __init__(self, star: Star, grain: TimeGrain = WEEK):
        self.star, self.grain = star, grain

    @cached_property
    def valued(self) -> DataFrame:
        """Demand and revenue per period. Daily rows stay a plan; coarser periods are stored."""
        panel = segment.demand_panel(self.star.sales_long, self.star.first_date, self.star.cutoff, self.grain.days)
        return panel if self.grain.days == 1 else materialize(panel, f"panel-{self.grain.name}")

    @cached_property
    def panel(self) -> DataFrame:
        """Demand per period with its category; models need no price."""
        demand = self.star.fact_sales if self.grain.days == 1 else self.valued.drop("revenue_cents")
        return demand.withColumn("cat_id", orders.hierarchy(F.col("item_id"))["cat_id"])

    @cached_property
    def labels(self) -> DataFrame:
        return materialize(segment.abc_xyz(self.valued), "labels")

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return ingest.time_split(self.panel, self.star.cutoff)

    @property
    def train(self) -> DataFrame:
        return self.split[0]

    @property
    def val(self) -> DataFrame:
        return self.split[1]

    @cached_property
    def naive(self) -> DataFrame:
        return naive.seasonal_naive(self.train, self.val, self.star.cutoff)

    @cached_property
    def croston(self) -> DataFrame:
        return croston.croston_forecasts(self.train, self.val, self.labels, self.grain)

    @cached_property
    def ets(self) -> DataFrame:
        return smoothing.ets_forecast(self.train, self.val, self.labels, self.star.cutoff, self.grain)

    @cached_property
    def base(self) -> DataFrame:
        """Baselines: the smoothing model, with the naive forecast in its gaps, beside the naive one.

        Stored, as accuracy, comparison, fact and error statistics all read it.
        """
        return materialize(smoothing.fill_gaps(self.val, self.naive, self.ets), f"baselines-{self.grain.name}")

    @cached_property
    def series(self) -> DataFrame:
        """Classes and codes per series, in the buckets of the facts: the daily rows are not moved to meet them."""
        return materialize(self.star.coded(self.labels), "series", SERIES_KEY)

    @cached_property
    def prepared(self) -> DataFrame:
        return features.prepare(self.star.sales_with_change, self.series)

    @cached_property
    def features(self) -> DataFrame:
        return features.model_features(self.prepared, self.grain)

    @cached_property
    def feature_table(self) -> DataFrame:
        """Stored features: boosting reads them once per round."""
        return materialize(self.features, "features")

    @cached_property
    def tree_model(self):
        """Fitted once; forecasts, importance and comparison share it."""
        return trees.train_trees(self.feature_table, self.star.cutoff, self.grain)

    @cached_property
    def trees(self) -> DataFrame:
        found = trees.tree_forecasts(self.tree_model, self.feature_table, self.star.cutoff, self.grain)
        return materialize(found, "tree-forecasts")

    @cached_property
    def importance(self) -> DataFrame:
        return trees.feature_importance(self.tree_model, self.feature_table, self.grain)

    @cached_property
    def wide(self) -> DataFrame:
        """The three models that SQL can compute too; ``wide_all`` has the trees as well."""
        return selection.forecast_wide(self.base, self.croston)

    @cached_property
    def wide_all(self) -> DataFrame:
        return selection.forecast_wide(self.base, self.croston, self.trees)

    @cached_property
    def best(self) -> DataFrame:
        """Forecast rows with the chosen model: stored, as the fact and the error statistics read it."""
        labelled = ingest.attach_labels(self.wide, self.labels)
        return materialize(selection.with_best_forecast(labelled), "best")

    @cached_property
    def fact(self) -> DataFrame:
        return selection.fact_forecasts(self.best)

    @cached_property
    def best_all(self) -> DataFrame:
        """Choice among all four models, and the forecast fact that comes of it."""
        labelled = ingest.attach_labels(self.wide_all, self.labels)
        return materialize(selection.with_best_forecast(labelled), "best-all")

    @cached_property
    def fact_all(self) -> DataFrame:
        return selection.fact_forecasts(self.best_all)

    @cached_property
    def z_rows(self) -> DataFrame:
        """Croston and naive forecasts on the same intermittent rows."""
        row = ["item_id", "store_id", "date"]
        hierarchy = orders.hierarchy(F.col("item_id"))
        return self.croston.join(self.naive, row, "left").withColumn("cat_id", hierarchy["cat_id"])

    @cached_property
    def metrics_long(self) -> DataFrame:
        models = {"Seasonal Naive": "seasonal_naive_forecast", "ETS": "ets_forecast"}
        return accuracy.accuracy_long(self.base, models)

    @cached_property
    def croston_metrics(self) -> DataFrame:
        models = {"Croston SBA": "croston_sba_forecast", "Seasonal Naive": "seasonal_naive_forecast"}
        return accuracy.accuracy_long(self.z_rows, models, metrics=("RMSE", "MAE", "Bias"))

    @cached_property
    def comparison(self) -> DataFrame:
        return accuracy.model_comparison(
            [
                accuracy.to_wide(self.metrics_long, "Seasonal Naive", "Seasonal Naive"),
                accuracy.to_wide(self.metrics_long, "ETS", "ETS"),
                accuracy.to_wide(self.croston_metrics, "Croston SBA", "Croston SBA (Z-class)"),
            ]
        )

    @cached_property
    def tree_metrics(self) -> DataFrame:
        return materialize(accuracy.accuracy_long(self.trees, {"GBT": "gbt_forecast"}), "tree-metrics")

    @cached_property
    def tree_improvement(self) -> DataFrame:
        """Trees against the naive forecast, per category, pooled and as the mean of categories."""
        rows = self.trees.join(self.naive, ["item_id", "store_id", "date"])
        return accuracy.improvement_by_scope(rows, "seasonal_naive_forecast", "gbt_forecast")

    @cached_property
    def all_models(self) -> DataFrame:
        """Comparison of all four models; each is scored on the rows it forecasts."""
        long = materialize(quality.clean_columns(self.metrics_long), "baseline_metrics")
        tree_long = self.tree_metrics
        return accuracy.model_comparison(
            [
                accuracy.to_wide(long, "Seasonal_Naive", "Seasonal Naive"),
                accuracy.to_wide(long, "ETS", "ETS"),
                accuracy.to_wide(self.croston_metrics, "Croston SBA", "Croston SBA (Z-class)"),
                accuracy.to_wide(tree_long, "GBT", "GBT"),
            ]
        )

    @cached_property
    def improvement(self) -> DataFrame:
        return accuracy.improvement_by_scope(self.z_rows, "seasonal_naive_forecast", "croston_sba_forecast")


class Inventory:
    """Forecast error to stock policy, cost and extracts."""

    def __init__(self, forecasting: Forecasting, params: PolicyParams = WEEKLY_POLICY):
        self.forecasting, self.params = forecasting, params
        self._written: dict[str, extracts.Extract] = {}

    @cached_property
    def error_stats(self) -> DataFrame:
        return selection.error_stats(self.forecasting.best)

    @cached_property
    def stats(self) -> DataFrame:
        star = self.forecasting.star
        priced = selection.attach_price(
            self.error_stats, self.forecasting.labels, star.fact_prices, star.dim_item, star.dim_store
        )
        return selection.item_forecast_stats(materialize(priced, "priced"))

    @cached_property
    def costs(self) -> DataFrame:
        """One row per series with every policy column; a stored stage, as all reports read it."""
        reorder = inventory.inventory_policy(self.stats, self.params)
        return materialize(policy.with_policy_cost(reorder, self.params), "policy")

    @cached_property
    def newsvendor(self) -> DataFrame:
        return materialize(newsvendor.newsvendor(self.costs, self.params), "newsvendor")

    @cached_property
    def allocation(self) -> DataFrame:
        return materialize(allocation.allocate(self.costs, self.params), "allocation")

    @cached_property
    def fact_policy(self) -> DataFrame:
        return self.costs.select(*policy.INVENTORY_FACT)

    @cached_property
    def fact_newsvendor(self) -> DataFrame:
        return self.newsvendor.select(*policy.NEWSVENDOR_FACT)

    @cached_property
    def fact_allocation(self) -> DataFrame:
        return self.allocation.select(*policy.ALLOCATION_FACT)

    @cached_property
    def dashboard(self) -> DataFrame:
        """Main extract before validation."""
        return quality.dashboard_extract(self.costs)

    @cached_property
    def validated(self) -> DataFrame:
        """Main extract after validation; the dashboard reads this one."""
        return quality.clip_negative(self.dashboard)

    def extract(self, name: str) -> extracts.Extract:
        """An extract by name, written on first use together with the figures of the quality gate."""
        if name not in self._written:
            calendar = self.forecasting.star.calendar
            raw, finish = {
                "fact_forecasts": (lambda: self.forecasting.fact, quality.clean),
                "dashboard": (lambda: quality.dashboard_columns(self.costs), lambda df: quality.clip_negative(quality.clean(df))),
                "policy": (lambda: self.fact_policy, quality.clean),
                "newsvendor": (lambda: self.fact_newsvendor, quality.clean),
                "allocation": (lambda: self.fact_allocation, quality.clean),
                "calendar": (lambda: calendar, quality.calendar_extract),
            }[name]
            self._written[name] = extracts.write_extract(raw(), name, finish, extracts.gate_conditions().get(name))
        return self._written[name]


class Retail:
    """All stages of one data set, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def brand(self) -> Star:
        return Star(self.spark, self.sf_dir, "brand")

    @cached_property
    def fine(self) -> Star:
        return Star(self.spark, self.sf_dir, "fine")

    @cached_property
    def weekly(self) -> Forecasting:
        return Forecasting(self.brand, WEEK)

    @cached_property
    def daily(self) -> Forecasting:
        return Forecasting(self.brand, DAY)

    @cached_property
    def daily_fine(self) -> Forecasting:
        return Forecasting(self.fine, DAY)

    @cached_property
    def inventory(self) -> Inventory:
        return Inventory(self.weekly, WEEKLY_POLICY)
