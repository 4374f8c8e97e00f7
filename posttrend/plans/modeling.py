"""Building a model: search, hold-out metrics, the model on all rows, its alert threshold and a list to review."""

from __future__ import annotations

import datetime as dt
import posixpath
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.operators import evaluate, models
from posttrend.operators.features import fill_features, time_features
from posttrend.operators.splits import stored_folds
from posttrend.schema import LINEAR_FEATURES, TREE_FEATURES
from posttrend.session import cut_lineage
from posttrend.sources import registry

SCORE = "predict_proba_1"


class Kind(NamedTuple):
    """A family of models: how one is fitted, what it is fitted on, the share of posts below its alert threshold."""

    suffix: str
    features: list[str]
    stage_of: Callable[[dict, int], object]
    params: dict
    staged: str | None
    quantile: float
    weights: Callable[[SparkSession, PipelineModel], DataFrame]


# The chosen parameters and quantiles of the two families.
KINDS = {
    "lr": Kind(
        "LR", LINEAR_FEATURES, lambda p, n: models.logistic_stage(n, p["C"]), {"C": 0.25}, None, 0.975, models.coef_table
    ),
    "gbt": Kind(
        "GBM", TREE_FEATURES, lambda p, n: models.boosted_stage(**p),
        {"learning_rate": 0.01, "max_depth": 3, "min_samples_leaf": 1, "n_estimators": 50}, "n_estimators", 0.99,
        models.feature_importance,
    ),
}


class Built(NamedTuple):
    model: PipelineModel
    name: str
    threshold: float
    params: dict


def holdout_metrics(scored: DataFrame, y: str = "target") -> DataFrame:
    """One row: areas under the precision-recall curve, and precision and recall of the top 2 %."""
    whole = evaluate.auc_pr(scored, SCORE, y)
    upper = evaluate.auc_pr(scored, SCORE, y, min_quantile=0.95).withColumnRenamed("aucpr", "top5Pctaucpr")
    top = evaluate.top_share_metrics(scored, SCORE, y).select(
        F.col("threshold").alias("top2PctThreshold"), F.col("precision").alias("top2PctPrecision"),
        F.col("recall").alias("top2PctRecall"),
    )
    # One row each.
    for other in (upper, top):
        whole = whole.withColumn("_one", F.lit(1)).join(F.broadcast(other.withColumn("_one", F.lit(1))), "_one").drop("_one")
    return whole


def build_model(
    training: DataFrame, kind: str, models_root: str, output: str, grid: dict[str, list] | None = None, n_splits: int = 10,
    at: dt.datetime | None = None, key: str = "postId", y: str = "target", measure: str = "mean_top5Pctaucpr",
) -> Built:
    """Fits a model of ``kind`` on a training table and stores it under ``models_root``, its reports under ``output``.

    With a ``grid`` its combinations are searched on ``n_splits`` splits first and the best by ``measure`` is taken;
    ``search`` then holds the summary.  ``holdout`` has the metrics of a fit on four fifths of the rows, measured on
    the rest.  The model itself is fitted on all rows; ``weights`` has its coefficients or importances, ``threshold``
    the quantile of its scores above which posts are alerted, ``review`` the positives and false positives at it.  The
    model is stored last, so one that can be found has its reports.
    """
    spark, family = training.sparkSession, KINDS[kind]
    rows = time_features(fill_features(training)).select(
        *dict.fromkeys([key, y, "createdTSUTC", "subreddit", *family.features])
    )
    folds = stored_folds(rows, y, key, n=n_splits if grid else 1)
    fitter = models.ml_fitter(family.stage_of, family.features, y)
    at_output = lambda name: posixpath.join(output, name)
    params = family.params
    if grid:
        found = models.grid_search(folds, fitter, grid, staged=family.staged)
        summary = cut_lineage(models.cv_summary(found, list(grid)))
        models.leaderboard(summary, list(grid), measure, len(models.expand_grid(grid))).write.mode("overwrite").parquet(at_output("search"))
        # Parameters are stored as doubles; counts are whole numbers again.
        best = models.best_params(summary, list(grid), measure)
        params = {**params, **{k: type(params.get(k, v))(v) for k, v in best.items()}}
    held_out = fitter(folds.train(0), params, folds.sizes[0])(folds.test(0), None)
    holdout_metrics(held_out, y).write.mode("overwrite").parquet(at_output("holdout"))

    model = models.refit(folds.rows, family.stage_of, params, family.features, y)
    name = registry.model_name(family.suffix, at)
    family.weights(spark, model).write.mode("overwrite").parquet(at_output("weights"))
    scored = cut_lineage(models.score_model(folds.rows, model))
    value = evaluate.quantiles(scored, SCORE, [family.quantile])
    value.select(F.lit(name).alias("modelName"), "q", F.col("value").alias("threshold")).write.mode("overwrite").parquet(at_output("threshold"))
    threshold = read_threshold(spark, output, name)
    review = evaluate.review_list(scored, SCORE, y, threshold, family.features)
    evaluate.review_order(review).write.mode("overwrite").parquet(at_output("review"))
    registry.save_model(model, models_root, name)
    return Built(model, name, threshold, params)


def read_threshold(spark: SparkSession, output: str, name: str) -> float:
    """The stored alert threshold of a model."""
    row = spark.read.parquet(posixpath.join(output, "threshold")).where(F.col("modelName") == name).first()
    if row is None:
        raise ValueError(f"no threshold of {name} in {output}")
    return row["threshold"]
