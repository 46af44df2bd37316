"""One boosted-tree regressor over all series."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, functions as F

from shelfwise.functions.scalars import clip_low
from shelfwise.operators.features import feature_columns
from shelfwise.params import DAY, TimeGrain
from shelfwise.session import materialize

SEED = 42
MOST_ROUNDS, PATIENCE, CHUNK, STEP = 1000, 50, 20, 0.05  # the holdout ends the fit, the ceiling hardly ever
SMALL, LEAST_GAIN = 1e-6, 1e-9  # units of a later chunk's labels, and the gain that a split needs: see ``_continued``
NULLABLE = ("sell_price", "price_change", "price_vs_mean")


def _numeric(features: DataFrame, columns: list[str]) -> DataFrame:
    return features.withColumns({c: F.col(c).cast("double") for c in columns})


def train_trees(
    features: DataFrame,
    cutoff: dt.date,
    grain: TimeGrain = DAY,
    most_rounds: int = MOST_ROUNDS,
    patience: int = PATIENCE,
    depth: int = 6,
    loss: str = "absolute",
    chunk: int = CHUNK,
) -> PipelineModel:
    """Fit on rows up to the cutoff.

    The last horizon *inside* training decides when to stop: boosting goes on, ``chunk`` rounds at a time, until
    ``patience`` rounds have not lowered the holdout error, and the best number of rounds is kept. (The learner's
    own validation stops at the first round that does not help.) A chunk begins where the one before ended, so no round is fitted twice.
    The scored rows are never seen. Trees need complete vectors, so missing prices and deviations take the median.

    The absolute loss fits trees to signs, so a round moves a forecast by at most the step, whatever the units. Labels are
    therefore learned in units of their own mean deviation: forecasts of k times the sales are k times the forecasts.
    """
    columns = feature_columns(grain)
    holdout = cutoff - dt.timedelta(days=grain.horizon * grain.days)
    rows = _numeric(features.where(F.col("date") <= F.lit(cutoff)), columns + ["units_sold"]).select(
        *columns, F.col("units_sold").alias("label"), (F.col("date") > F.lit(holdout)).alias("is_holdout")
    )
    nullable = [*NULLABLE, *[f"roll_std_{n}" for n in grain.rolling]]
    nulls = Imputer(inputCols=nullable, outputCols=[f"{c}_full" for c in nullable], strategy="median")
    vectors = VectorAssembler(inputCols=[f"{c}_full" if c in nullable else c for c in columns], outputCol="features")
    prepared = Pipeline(stages=[nulls, vectors]).fit(rows)
    ready = materialize(prepared.transform(rows).select("features", "label", "is_holdout"), "tree-rows")
    mean = ready.where("not is_holdout").agg(F.avg("label")).first()[0]
    scale = ready.where("not is_holdout").agg(F.avg(F.abs(F.col("label") - F.lit(mean)))).first()[0] or 1.0
    ready = ready.withColumn("label", F.col("label") / F.lit(scale))
    learner = GBTRegressor(
        maxDepth=depth, stepSize=STEP, lossType=loss, subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=20, seed=SEED
    )
    boosted, errors = None, []
    while True:
        if boosted is None:
            model = learner.setMaxIter(min(chunk, most_rounds)).fit(ready.where("not is_holdout"))
            boosted = Boosted(list(model._java_obj.trees()), list(model.treeWeights))
            errors = model.evaluateEachIteration(ready.where("is_holdout"), loss)
        else:
            more, later = _continued(boosted, learner, ready, min(chunk, most_rounds - len(errors)), loss)
            boosted = Boosted(boosted.trees + more.trees, boosted.weights + more.weights)
            errors = [*errors, *later]
        best = min(range(len(errors)), key=errors.__getitem__) + 1
        if len(errors) >= min(best + patience, most_rounds):
            break
    return PipelineModel(stages=[*prepared.stages, boosted.model(best, scale)])


@dataclass
class Boosted:
    """Fitted trees and their weights, in the order of rounds."""

    trees: list
    weights: list[float]

    def model(self, rounds: int | None = None, scale: float = 1.0) -> GBTRegressionModel:
        """The model of the first rounds, its predictions times ``scale``."""
        rounds, context = len(self.trees) if rounds is None else rounds, SparkContext._active_spark_context
        jvm, array = context._jvm, context._gateway.new_array
        trees, weights = array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds), array(jvm.double, rounds)
        for k, (tree, weight) in enumerate(zip(self.trees[:rounds], self.weights)):
            trees[k], weights[k] = tree, weight * scale
        return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"boosted_{rounds}", trees, weights, self.trees[0].numFeatures()))


def _continued(boosted: Boosted, learner: GBTRegressor, ready: DataFrame, rounds: int, loss: str) -> tuple[Boosted, list[float]]:
    """Further rounds on what the rounds so far leave open, and the holdout error after each of them.

    The learner fits its first tree to the labels themselves, with full weight, and all later ones to the signs of what is left. Here the first tree
    must change nothing, and the others must be what boosting would have fitted without the pause:

    * Labels and step are made small (``SMALL``), so that no split of the first tree gains enough to be made: it is the mean. Signs have no
      units, so the other trees are the same.
    * The mean is nought: a residual that all rounds of the chunk together can't use up keeps its sign whatever its size, so those
      far ones (of the side that is too light) are moved further out until the sides weigh the same. What the subsample leaves of the mean is one
      constant for all forecasts; the tree stays in the model, and the next ones know of it. (The mean of the residuals is that constant
      where one side has no far ones.)
    """
    left = boosted.model().transform(ready).select("features", (F.col("label") - F.col("prediction")).alias("left"), "is_holdout")
    learned = left.where("not is_holdout")
    reach = STEP * rounds
    far = F.when(F.col("left") > reach, 1.0).when(F.col("left") < -reach, -1.0).otherwise(0.0)
    near = F.when(far == 0, F.col("left")).otherwise(far * reach)
    known = learned.select(far.alias("far"), near.alias("near")).agg(
        F.sum("near").alias("total"), F.count(F.when(F.col("far") > 0, 1)).alias("above"), F.count(F.when(F.col("far") < 0, 1)).alias("below")
    ).first()
    side, count = (-1.0, known.below) if known.total > 0 else (1.0, known.above)
    outward = abs(known.total) / count if count else 0.0
    label = near + F.when(far == side, side * outward).otherwise(0.0)
    widest = max(reach + outward, 1.0)
    small = SMALL / widest  # so that the variance of all labels is below SMALL squared
    own = learner.copy({learner.maxIter: rounds, learner.stepSize: STEP * small, learner.minInfoGain: LEAST_GAIN, learner.seed: SEED + len(boosted.trees)})
    model = own.fit(learned.select("features", (label * small).alias("label")))
    errors = model.evaluateEachIteration(left.where("is_holdout").select("features", (F.col("left") * small).alias("label")), loss)
    trees, weights = list(model._java_obj.trees()), [w / small for w in model.treeWeights]
    return Boosted(trees, weights), [e / small for e in errors]


def tree_forecasts(
    model: PipelineModel, features: DataFrame, cutoff: dt.date, grain: TimeGrain = DAY
) -> DataFrame:
    """Predictions on the rows after the cutoff, never negative."""
    scored = model.transform(
        _numeric(features.where(F.col("date") > F.lit(cutoff)), feature_columns(grain))
    )
    return scored.select(
        "item_id",
        "store_id",
        "date",
        "cat_id",
        "abc_xyz",
        F.col("units_sold").alias("actual"),
        clip_low(F.col("prediction"), 0.0).alias("gbt_forecast"),
    )


def feature_importance(model: PipelineModel, sample: DataFrame, grain: TimeGrain = DAY, n: int = 15) -> DataFrame:
    """The n most useful inputs (24 numbers in all, so the driver holds them)."""
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(c, float(v)) for c, v in zip(feature_columns(grain), gains)]
    frame = sample.sparkSession.createDataFrame(rows, "feature string, gain double")
    return frame.orderBy(F.desc("gain"), "feature").limit(n)
