"""Penalised logistic regression by Newton steps: any number of fits share each pass over the rows."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.session import cut_lineage

# Part of the loss that is rounding, and the shortest part of a step that is tried.
ROUNDING, SHORTEST = 1e-12, 1e-9


class PenalisedLogistic(LogisticRegression):
    """pyspark.ml's logistic regression of 0/1 labels with an intercept, an L2 penalty on unscaled weights and
    another solver.

    Its own solver takes hundreds of passes, or gives up before the optimum, where columns are almost constant: the
    penalty then differs by many powers of ten between them.  Newton steps take some ten passes in any scale.
    """

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        return fit_together(dataset, [F.lit(True)], [(0, self)])[0]

    def model_of(self, weights: np.ndarray, intercept: float) -> LogisticRegressionModel:
        context = SparkSession.active().sparkContext
        java = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
            self.uid, _py2java(context, Vectors.dense(weights)), float(intercept)
        )
        return self._copyValues(LogisticRegressionModel(java))


def fit_together(df: DataFrame, members: list[Column], fits: list[tuple[int, PenalisedLogistic]]) -> list[LogisticRegressionModel]:
    """The model of every (number of a member condition, stage), each fitted on the rows that meet its condition.

    Stages share their columns and differ in their penalty.  The rows are stored once, with their conditions worked
    out; a pass over them brings loss, slope and curvature of all fits that are not at rest yet, (features + 2)^2 / 2
    numbers a fit, summed within tasks first.
    """
    stage = fits[0][1]
    stored = cut_lineage(
        df.select(
            F.col(stage.getFeaturesCol()).alias("x"), F.col(stage.getLabelCol()).cast("double").alias("y"),
            F.array(*members).alias("member"),
        )
    )
    scale, sizes, positives = _facts(stored, len(members))
    rows = stored.select(vector_to_array("x").alias("x"), "y", "member")
    return [
        stage.model_of(*scale.outside(at))
        for (_, stage), at in zip(fits, _newton(rows, scale, sizes, positives, fits))
    ]


class Scale(NamedTuple):
    """Mean and deviation of the columns over all rows.  Steps are taken in such units, which changes no optimum.

    The deviation of a constant column is inf: in such units it is 0 in all rows, and its weight is exactly 0, as it is
    at the optimum, where the intercept stands for it.
    """

    mean: np.ndarray
    deviation: np.ndarray

    def outside(self, at: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and intercept for columns as they are."""
        weights = at[:-1] / self.deviation
        return weights, at[-1] - float(weights @ self.mean)


def _facts(stored: DataFrame, members: int) -> tuple[Scale, np.ndarray, np.ndarray]:
    """The scale, and rows and positives per member condition."""
    inside = [F.col("member")[i] for i in range(members)]
    found = stored.agg(
        Summarizer.metrics("mean", "std").summary(F.col("x")).alias("scale"),
        F.count_if(~F.coalesce(F.col("y").isin(0.0, 1.0), F.lit(False))).alias("other"),
        F.array(*[F.count_if(c) for c in inside]).alias("sizes"),
        F.array(*[F.count_if(c & (F.col("y") == 1)) for c in inside]).alias("positives"),
    ).first()
    if found["other"]:
        raise ValueError(f"{found['other']} labels are neither 0 nor 1")
    sizes = np.array(found["sizes"], float)
    if not sizes.all():
        raise ValueError("no rows to fit a model on")
    mean, deviation = found["scale"]["mean"].toArray(), found["scale"]["std"].toArray()
    # A column that varies by rounding alone is constant.
    return Scale(mean, np.where(deviation > 1e-12 * abs(mean), deviation, np.inf)), sizes, np.array(found["positives"], float)


def _newton(
    rows: DataFrame, scale: Scale, sizes: np.ndarray, positives: np.ndarray, fits: list[tuple[int, PenalisedLogistic]]
) -> list[np.ndarray]:
    """Weights and intercept of every fit in units of ``scale``.  Steps that do not lower the loss are halved; a fit is at rest
    where the next one would lower it by no more than tol^2 of it."""
    width = len(scale.mean) + 1
    trial = [np.zeros(width) for _ in fits]
    active, stuck = [], 0
    for i, (m, _) in enumerate(fits):
        share = positives[m] / sizes[m]
        if 0 < share < 1:
            trial[i][-1] = np.log(share / (1 - share))
            active.append(i)
        else:
            # Labels all alike: no weights, and an intercept without end, as pyspark.ml has it.
            trial[i][-1] = np.inf if share else -np.inf
    most = max(stage.getMaxIter() for _, stage in fits)
    pull = np.append(scale.deviation**-2.0, 0.0)
    best: dict[int, tuple[np.ndarray, float, np.ndarray, float]] = {}
    part: dict[int, float] = {}
    for _ in range(most):
        if not active:
            break
        sums = _sums(rows, scale, np.array([trial[i] for i in active]), [fits[i][0] for i in active])
        for i, (loss, slope, curve) in zip(list(active), sums):
            m, stage = fits[i]
            at, penalty = trial[i], stage.getRegParam() * pull
            loss = loss / sizes[m] + 0.5 * penalty @ at**2
            if i in best:
                was_at, was, step, gain = best[i]
                if not loss <= was - 1e-4 * part[i] * gain + ROUNDING * was:
                    part[i] /= 2
                    trial[i] = was_at - part[i] * step
                    if part[i] < SHORTEST:
                        active.remove(i)
                        stuck += 1
                    continue
            step = _solved(curve / sizes[m] + np.diag(penalty), slope / sizes[m] + penalty * at)
            gain = float(step @ (slope / sizes[m] + penalty * at))
            best[i], part[i] = (at, loss, step, gain), 1.0
            trial[i] = at - step
            # This last step is still taken.
            if gain <= stage.getTol() ** 2 * loss:
                active.remove(i)
    if active or stuck:
        warnings.warn(f"{len(active) + stuck} of {len(fits)} fits ended before they were at rest", stacklevel=2)
    return trial


def _solved(curve: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """curve^-1 slope by way of a unit diagonal, as sizes differ by many powers of ten; 0 where there is no curvature."""
    bent = np.diag(curve) > 0
    unit = np.sqrt(np.diag(curve)[bent])
    step = np.zeros(len(slope))
    step[bent] = np.linalg.pinv(curve[np.ix_(bent, bent)] / np.outer(unit, unit), hermitian=True) @ (slope[bent] / unit) / unit
    return step


def _sums(
    rows: DataFrame, scale: Scale, at: np.ndarray, member: list[int]
) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """Summed loss, its slope and its curvature for each row of ``at``, over the rows that meet its member condition."""
    width = at.shape[1]
    mean, deviation = scale
    one, two = np.triu_indices(width)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(at), 1 + width + len(one)))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, inside = (batch.column(i) for i in range(3))
            x = (x.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1) - mean) / deviation
            x = np.column_stack([x, np.ones(len(y))])
            y = y.to_numpy(zero_copy_only=False)[:, None]
            inside = inside.flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)[:, member]
            # Log-odds of the other label: no digits are lost where the right one is all but sure.
            side = 1 - 2 * y
            z = side * (x @ at.T)
            small = np.exp(-abs(z))
            total[:, 0] += np.where(inside, np.maximum(z, 0) + np.log1p(small), 0).sum(axis=0)
            total[:, 1 : width + 1] += np.where(inside, side * np.where(z >= 0, 1, small) / (1 + small), 0).T @ x
            total[:, width + 1 :] += np.where(inside, small / (1 + small) ** 2, 0).T @ (x[:, one] * x[:, two])
        fit, place = np.indices(total.shape, np.int32).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(fit), pa.array(place), pa.array(total.ravel())], ["fit", "place", "part"])

    parts = rows.mapInArrow(summed, "fit int, place int, part double")
    sums = np.zeros((len(at), 1 + width + len(one)))
    # As many rows as fits have sums, whatever the data.
    for fit, place, total in parts.groupBy("fit", "place").agg(F.sum("part")).collect():
        sums[fit, place] = total
    for row in sums:
        curve = np.zeros((width, width))
        curve[one, two] = curve[two, one] = row[width + 1 :]
        yield row[0], row[1 : width + 1], curve
