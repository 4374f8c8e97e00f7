"""Training, inspecting, searching and applying classifiers with pyspark.ml."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import NamedTuple

import pandas as pd
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posttrend.operators.evaluate import above_counts, area_under_curve, running_scores
from posttrend.operators.logistic import PenalisedLogistic, fit_together
from posttrend.operators.splits import Folds
from posttrend.session import cut_lineage, fresh_path

VECTOR = "_features"
# The largest gradient that is no more than rounding.
ROUNDING = 1e-12


def logistic_stage(rows: int, c: float = 0.25, max_iter: int = 1000, y: str = "target") -> PenalisedLogistic:
    """L2 logistic regression whose strength is given as C on the summed loss.

    pyspark.ml averages the loss, so C over ``rows`` rows is regParam 1 / (C * rows);
    features are not rescaled inside the penalty.
    """
    return PenalisedLogistic(
        featuresCol=VECTOR,
        labelCol=y,
        regParam=1.0 / (c * rows),
        elasticNetParam=0.0,
        standardization=False,
        fitIntercept=True,
        maxIter=max_iter,
        tol=1e-8,
    )


def boosted_stage(
    learning_rate: float = 0.01,
    max_depth: int = 3,
    min_samples_leaf: int = 1,
    n_estimators: int = 50,
    seed: int = 0,
    y: str = "target",
) -> GBTClassifier:
    """Gradient-boosted trees; features are binned, so scores are comparable to, not equal to, exact splits."""
    return GBTClassifier(
        featuresCol=VECTOR,
        labelCol=y,
        stepSize=learning_rate,
        maxDepth=int(max_depth),
        minInstancesPerNode=int(min_samples_leaf),
        maxIter=int(n_estimators),
        seed=seed,
    )


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=VECTOR, handleInvalid="error")


def _fit(df: DataFrame, features: list[str], stage, y: str) -> PipelineModel:
    return Pipeline(stages=[_assembler(features), stage]).fit(df.select(*features, y))


def fit_lr(
    df: DataFrame, features: list[str], c: float = 0.25, max_iter: int = 1000, y: str = "target",
    tolerance: float | None = 1e-4,
) -> PipelineModel:
    """The penalised optimum; raises if the fit stopped where the gradient is above ``tolerance`` (see ``lr_gradient``).

    Gradients below ``ROUNDING`` do not count, whatever their share: the penalty keeps a weight within its gradient of
    the optimum, and the weight of a column that says nothing is rounding alone.
    """
    model = _fit(df, features, logistic_stage(df.count(), c, max_iter, y), y)
    if tolerance is not None:
        pulls = lr_gradient(df, *linear_weights(model), c, y)
        worst = pulls.agg(F.max(F.when(F.abs("gradient") <= ROUNDING, 0.0).otherwise(F.col("share")))).first()[0]
        if worst > tolerance:
            raise ValueError(f"the fit is no optimum: a gradient of {worst:.2g} of its parts is left")
    return model


def lr_gradient(df: DataFrame, weights: dict[str, float], intercept: float, c: float = 0.25, y: str = "target") -> DataFrame:
    """The gradient of 0.5 |w|^2 + c * (summed log-loss) at the given weights, one row per feature.

    ``gradient`` is the sum of what the penalty and the rows pull, ``share`` its part of the sum of their sizes: 0 at
    the optimum, which is the only one, 1 where all pulls go one way.  One pass over the rows, combined on the map side.
    """
    # Labels all alike leave an intercept without end.
    z = " + ".join([f"double('{float(intercept)!r}')", *[f"{float(w)!r} * cast(`{f}` AS double)" for f, w in weights.items()]])
    pulls = df.selectExpr(f"1 / (1 + exp(-({z}))) - cast(`{y}` AS double) AS _e", *[f"cast(`{f}` AS double) AS `{f}`" for f in weights])
    sums, rows = [], []
    for i, (name, w) in enumerate([*weights.items(), ("intercept", None)]):
        part = "_e" if w is None else f"_e * `{name}`"
        sums += [F.expr(f"sum({part}) AS g{i}"), F.expr(f"sum(abs({part})) AS a{i}")]
        pull = 0.0 if w is None else float(w)
        total = f"({pull!r}D + {float(c)!r}D * g{i})"
        rows.append(f"struct('{name}' AS feature, {total} AS gradient, coalesce(try_divide(abs({total}), {abs(pull)!r}D + {float(c)!r}D * a{i}), 0D) AS share)")
    return pulls.agg(*sums).selectExpr(f"inline(array({', '.join(rows)}))")


def fit_gbt(df: DataFrame, features: list[str], y: str = "target", **params) -> PipelineModel:
    return _fit(df, features, boosted_stage(y=y, **params), y)


def score_model(df: DataFrame, model: PipelineModel, out: str = "predict_proba_1") -> DataFrame:
    """Probability of the positive class, computed by the model on the executors."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def score_foreign(df: DataFrame, model, features: list[str] | None = None, out: str = "predict_proba_1") -> DataFrame:
    """Scores of a model from outside Spark: anything picklable with ``predict_proba`` on a pandas frame.

    The model travels with the function (Spark broadcasts it if it is large) and sees
    Arrow batches of its features, in the order it names them itself unless
    ``features`` is given.
    """
    names = list(model.feature_names_in_ if features is None else features)

    @F.pandas_udf("double")
    def positive(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(model.predict_proba(batch[names])[:, 1])

    return df.withColumn(out, positive(F.struct(*names)))


def _parts(model: PipelineModel) -> tuple[list[str], Model]:
    assembler, fitted = model.stages
    return assembler.getInputCols(), fitted


def coef_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Coefficients and intercept, each with its share of the summed absolute size."""
    features, fitted = _parts(model)
    rows = [(i, name, float(w)) for i, (name, w) in enumerate(zip(features, fitted.coefficients))]
    rows.append((len(rows), "intercept", float(fitted.intercept)))
    table = spark.createDataFrame(rows, "position int, feature string, coef double")
    share = F.try_divide(F.abs("coef"), F.sum(F.abs("coef")).over(Window.partitionBy()))
    return table.select("position", "feature", "coef", share.alias("coefPct"))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    features, fitted = _parts(model)
    rows = [(name, float(v)) for name, v in zip(features, fitted.featureImportances.toArray())]
    table = spark.createDataFrame(rows, "featureName string, featureImportance double")
    return table.orderBy(F.col("featureImportance").desc(), "featureName")


def split_gains(df: DataFrame, features: list[str], y: str = "target") -> DataFrame:
    """What a first tree of depth 1 gains by each 0/1 column, exactly: one row per feature, from one aggregate.

    Labels count as -1 and 1.  ``gain`` is the variance of all labels less the weighted variance of the two sides,
    ``below`` and ``above`` are the sides' means, which are the tree's leaves; both are NULL where a side is empty.
    The tree splits at the largest gain, of equal ones at the feature named first; it has all the importance then.
    """
    label = f"(2 * cast(`{y}` AS double) - 1)"
    sums = [F.expr(f"sum({label}) AS s"), F.expr("count(*) AS n")]
    rows = []
    for i, name in enumerate(features):
        side = f"cast(`{name}` AS double) > 0.5"
        sums += [F.expr(f"sum(CASE WHEN {side} THEN {label} END) AS s{i}"), F.expr(f"count(CASE WHEN {side} THEN 1 END) AS n{i}")]
        # Labels are -1 or 1, so a side's variance is 1 less its squared mean.
        below, above = f"try_divide(s - coalesce(s{i}, 0), n - n{i})", f"try_divide(s{i}, n{i})"
        gain = f"((n - n{i}) * pow({below}, 2) + n{i} * pow({above}, 2)) / n - pow(s / n, 2)"
        rows.append(f"struct({i} AS position, '{name}' AS feature, n - n{i} AS n_below, n{i} AS n_above, {below} AS below, {above} AS above, {gain} AS gain)")
    return df.agg(*sums).where("n > 0").selectExpr(f"inline(array({', '.join(rows)}))")


def linear_weights(model: PipelineModel) -> tuple[dict[str, float], float]:
    """Weights and intercept of a fitted logistic model, for ``score_linear``."""
    features, fitted = _parts(model)
    return {name: float(w) for name, w in zip(features, fitted.coefficients)}, float(fitted.intercept)


def attribution_rows(df: DataFrame, weights: dict[str, float], keep: list[str]) -> DataFrame:
    """Contribution of every feature to every row's log-odds: weight times distance from the mean."""
    means = df.agg(*[F.expr(f"avg(`{f}`) AS `{f}`") for f in weights]).select(F.struct("*")).scalar()
    parts = [f"{float(w)!r}D * (cast(`{f}` AS double) - _means.`{f}`) AS `{f}`" for f, w in weights.items()]
    packed = df.withColumn("_means", means).selectExpr(*keep, *parts)
    return packed.unpivot(keep, list(weights), "feature", "attribution")


def linear_attribution(df: DataFrame, weights: dict[str, float], by: str = "target") -> DataFrame:
    """Mean and maximum absolute contribution per feature and cohort."""
    size = F.abs("attribution")
    return (
        attribution_rows(df, weights, [by])
        .groupBy(by, "feature")
        .agg(F.avg(size).alias("mean_abs"), F.max(size).alias("max_abs"))
    )


def expand_grid(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _fold_metrics(scored: DataFrame, by: list[str], y: str, q: float, top: float) -> DataFrame:
    """Area under the PR curve, the same for the top scores, and precision and recall above quantile ``q``."""
    measures = running_scores(scored, "predict_proba_1", y, by).groupBy(*by).agg(
        area_under_curve("aucpr"),
        area_under_curve("top5Pctaucpr", top),
        *above_counts(q, "_up"),
        F.sum("tp").alias("_all"),
    )
    return measures.selectExpr(
        *by,
        "aucpr",
        "top5Pctaucpr",
        "try_divide(tp_up, n_up) AS top2PctPrecision",
        "try_divide(tp_up, _all) AS top2PctRecall",
    )


# Scores rows by a fitted model, or by what it was after so many of its trees.
FittedScorer = Callable[[DataFrame, int | None], DataFrame]


def first_trees(model: PipelineModel, n: int) -> PipelineModel:
    """The boosted model as it was after its first ``n`` trees: the model a fit of ``n`` trees would have given, as
    trees are added one by one with the same seed."""
    assembler, boosted = model.stages
    if not 0 < n <= boosted.getNumTrees:
        raise ValueError(f"{n} of {boosted.getNumTrees} trees asked for")
    java, context = boosted._java_obj, SparkSession.active().sparkContext
    kind = context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees = context._gateway.new_array(kind, n)
    weights = context._gateway.new_array(context._jvm.double, n)
    for i, tree in enumerate(list(java.trees())[:n]):
        trees[i], weights[i] = tree, float(java.treeWeights()[i])
    shorter = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(java.uid(), trees, weights)
    out = GBTClassificationModel(shorter)
    out._resetUid(boosted.uid)
    # A model made by hand knows only defaults; the columns it reads and writes are those of the whole one.
    for param in boosted.extractParamMap():
        if boosted.isSet(param) and param.name != "maxIter":
            out._set(**{param.name: boosted.getOrDefault(param)})
    out._transfer_params_to_java()
    return PipelineModel([assembler, out])


class MlFitter(NamedTuple):
    """Fits a pyspark.ml classifier; ``stage_of(params, train_rows)`` returns it unfitted."""

    stage_of: Callable[[dict, int], object]
    features: list[str]
    y: str

    def __call__(self, rows: DataFrame, params: dict, n: int) -> FittedScorer:
        return self._scorer(_fit(rows, self.features, self.stage_of(params, n), self.y))

    def together(self, folds: Folds, combos: list[dict]) -> dict[tuple[int, int], FittedScorer]:
        """The scorers of all (combination, split) if their fits can share passes over the rows, else none."""
        splits = sorted(folds.cuts)
        jobs = [(i, at) for i in range(len(combos)) for at in range(len(splits))]
        fits = [(at, self.stage_of(combos[i], folds.sizes[splits[at]])) for i, at in jobs]
        if not all(isinstance(stage, PenalisedLogistic) for _, stage in fits):
            return {}
        assembler = _assembler(self.features)
        found = fit_together(assembler.transform(folds.rows), [folds.is_train(split) for split in splits], fits)
        return {(i, splits[at]): self._scorer(PipelineModel([assembler, model])) for (i, at), model in zip(jobs, found)}

    def _scorer(self, model: PipelineModel) -> FittedScorer:
        return lambda df, trees: score_model(df, model if trees is None else first_trees(model, trees))


def ml_fitter(stage_of: Callable[[dict, int], object], features: list[str], y: str = "target") -> MlFitter:
    return MlFitter(stage_of, features, y)


def _one_fit_each(combos: list[dict], staged: str | None) -> list[tuple[dict, list[tuple[int, int | None]]]]:
    """The fits that serve all combinations: what to fit, and (combination, trees) to score with it.  Combinations
    that differ in ``staged`` alone share the fit with most trees."""
    shared: dict[tuple, list[int]] = {}
    for i, combo in enumerate(combos):
        shared.setdefault(tuple((k, v) for k, v in combo.items() if k != staged), []).append(i)
    fits = []
    for members in shared.values():
        largest = max(members, key=lambda i: combos[i][staged]) if staged else members[0]
        fits.append((combos[largest], [(i, int(combos[i][staged]) if staged else None) for i in members]))
    return fits


def grid_search(
    folds: Folds,
    fitter: Callable[[DataFrame, dict, int], FittedScorer],
    grid: dict[str, list],
    q: float = 0.98,
    top: float = 0.95,
    parallelism: int = 4,
    staged: str | None = None,
) -> DataFrame:
    """Fit every parameter combination on every split and score its test rows.

    ``fitter(train_rows, params, number_of_rows)`` returns a scorer (see ``ml_fitter``).  ``staged`` names the
    parameter that counts the steps of an ensemble: only the longest is fitted and the others are scored as its
    beginnings.  Logistic fits are made together, and a split's test rows are scored by all of them at once; other
    fits are submitted from a few threads, each stores the scored test rows of all its combinations.  All are then
    measured together, one group per (combination, split).
    """
    combos = expand_grid(grid)
    spark, y = folds.rows.sparkSession, folds.y
    store = fresh_path(spark, "grid-scores")
    fits = _one_fit_each(combos, staged)

    fitted = fitter.together(folds, [params for params, _ in fits]) if isinstance(fitter, MlFitter) else {}

    def run(job: tuple[list[int], int]) -> None:
        numbers, split = job
        test = folds.test(split).withColumn(y, F.col(y).cast("int"))
        # Each member's scores beside the row, then one row per member.
        names = {combo: f"_p{combo}" for number in numbers for combo, _ in fits[number][1]}
        scored = test
        for number in numbers:
            params, members = fits[number]
            scorer = fitted.get((number, split)) or fitter(folds.train(split), params, folds.sizes[split])
            for combo, trees in members:
                scored = scorer(scored, trees).withColumnRenamed("predict_proba_1", names[combo])
        pairs = F.array(*[F.struct(F.lit(c).alias("combo"), F.col(name).alias("predict_proba_1")) for c, name in names.items()])
        scored.select(y, F.inline(pairs)).write.mode("overwrite").parquet(f"{store}/fit={numbers[0]}/split={split}")

    shared = [list(range(len(fits)))] if fitted else [[number] for number in range(len(fits))]
    jobs = [(numbers, split) for numbers in shared for split in sorted(folds.cuts)]
    with ThreadPoolExecutor(parallelism) as pool:
        list(pool.map(run, jobs))
    layout = f"`{y}` int, combo int, predict_proba_1 double, fit int, split int"
    scored = spark.read.schema(layout).parquet(store)
    # A few rows per fit, read by every summary made of them.
    metrics = cut_lineage(_fold_metrics(scored, ["combo", "split"], y, q, top))
    params = spark.createDataFrame(
        [(i, *[float(v) for v in c.values()]) for i, c in enumerate(combos)],
        "combo int, " + ", ".join(f"`{name}` double" for name in grid),
    )
    return metrics.join(F.broadcast(params), "combo")


MEASURES = ["aucpr", "top5Pctaucpr", "top2PctPrecision", "top2PctRecall"]


def cv_summary(folds: DataFrame, params: list[str]) -> DataFrame:
    """Mean and population deviation of each measure over the splits, per parameter combination."""
    measures: list[Column] = []
    for m in MEASURES:
        measures += [F.avg(m).alias(f"mean_{m}"), F.stddev_pop(m).alias(f"std_{m}")]
    return folds.groupBy(*params).agg(F.count(F.lit(1)).alias("splits"), *measures)


def leaderboard(summary: DataFrame, params: list[str], measure: str = "mean_aucpr", n: int = 5) -> DataFrame:
    """The best combinations; equal ones by their parameters, so that a cut is the same in every run."""
    return summary.orderBy(F.col(measure).desc_nulls_last(), *params).limit(n)


def best_params(summary: DataFrame, params: list[str], measure: str = "mean_top5Pctaucpr") -> dict:
    """The combination to refit on all rows."""
    row = leaderboard(summary, params, measure, 1).select(*params).first()
    return row.asDict() if row else {}


def refit(df: DataFrame, stage_of: Callable[[dict, int], object], params: dict, features: list[str], y: str = "target"):
    """The final model: the chosen combination fitted on all rows."""
    return _fit(df, features, stage_of(params, df.count()), y)


def grid_long(summary: DataFrame, params: list[str], measure: str) -> DataFrame:
    """One row per (parameter, value, combination) with a measure, as the search plots need it."""
    return summary.select(*params, measure).unpivot([measure], params, "param", "param_value")
