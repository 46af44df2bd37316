"""Boosted trees: when the fit ends, and that it does not depend on the units."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import features, trees
from shelfwise.params import DAY

CUTOFF = dt.date(2020, 5, 29)


@pytest.fixture(scope="module")
def rows(spark):
    """A smooth signal with a holdout error far above ten units."""
    columns = features.feature_columns(DAY)
    days = spark.range(1500).select("id", F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 150).cast("int")).alias("date"))
    out = days.select("date", *[((F.col("id") * (k + 7)) % 101).cast("double").alias(c) for k, c in enumerate(columns)])
    return out.withColumn("units_sold", F.col(columns[0]) * 3 + F.col(columns[1])).coalesce(1)


def forecasts(model, rows):
    return [r.prediction for r in model.transform(trees._numeric(rows, features.feature_columns(DAY))).orderBy(*features.feature_columns(DAY)).collect()]


def test_the_first_batch_does_not_end_a_fit_that_still_gains(spark, rows):
    """With the constants of production."""
    model = trees.train_trees(rows, CUTOFF, DAY, most_rounds=40, depth=3)
    assert model.stages[-1].getNumTrees > 30


def test_units_do_not_switch_the_model(spark, rows):
    one = trees.train_trees(rows, CUTOFF, DAY, most_rounds=6, depth=3)
    many = trees.train_trees(rows.withColumn("units_sold", F.col("units_sold") * 64), CUTOFF, DAY, most_rounds=6, depth=3)
    assert one.stages[-1].getNumTrees == many.stages[-1].getNumTrees
    assert one.stages[-1].featureImportances.size == len(features.feature_columns(DAY))
    assert forecasts(many, rows) == pytest.approx([64 * x for x in forecasts(one, rows)])


def test_boosting_goes_on_where_it_paused(spark, rows, monkeypatch):
    """Chunks fit each round once, and end with the error of one fit without a pause."""
    fitted, errors = [], []
    fit, evaluate = trees.GBTRegressor.fit, trees.GBTRegressionModel.evaluateEachIteration

    def counted(self, df):
        model = fit(self, df)
        fitted.append([t.numNodes() for t in model._java_obj.trees()])
        return model

    def noted(self, df, loss):
        errors.append(evaluate(self, df, loss))
        return errors[-1]

    monkeypatch.setattr(trees.GBTRegressor, "fit", counted)
    monkeypatch.setattr(trees.GBTRegressionModel, "evaluateEachIteration", noted)
    trees.train_trees(rows, CUTOFF, DAY, most_rounds=24, depth=3, chunk=24)
    (whole,), (at_once,) = fitted, errors
    fitted.clear(), errors.clear()
    trees.train_trees(rows, CUTOFF, DAY, most_rounds=24, depth=3, chunk=8)
    assert [len(f) for f in fitted] == [8, 8, 8]
    assert [f[0] for f in fitted[1:]] == [1, 1] and all(n > 1 for f in fitted for n in f[1:])
    assert len(whole) == len(at_once) == sum(map(len, errors)) == 24
    model = trees.train_trees(rows, CUTOFF, DAY, most_rounds=24, depth=3, chunk=8)
    one = trees.train_trees(rows, CUTOFF, DAY, most_rounds=24, depth=3, chunk=24)
    held = trees._numeric(rows.where(F.col("date") <= F.lit(CUTOFF)), features.feature_columns(DAY))
    mae = lambda m: m.transform(held).agg(F.avg(F.abs(F.col("prediction") - F.col("units_sold")))).first()[0]
    assert mae(model) == pytest.approx(mae(one), rel=0.15)  # other subsamples


def test_residuals_of_one_side_only_end_in_a_constant(spark, rows):
    """No far residual balances the others: the pause moves all forecasts by one constant, and boosting goes on."""
    flat = rows.withColumn("units_sold", F.when(F.col("units_sold") > 390, 1000.0).otherwise(5.0))
    model = trees.train_trees(flat, CUTOFF, DAY, most_rounds=9, depth=2, chunk=3)
    assert 1 <= model.stages[-1].getNumTrees <= 9
