import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from posttrend.operators import models, sketches
from posttrend.operators.evaluate import quantiles

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(5)
    rows = [(DAY + dt.timedelta(days=int(d)), float(v)) for d, v in zip(rng.integers(0, 12, 30_000), rng.beta(1, 6, 30_000))]
    return spark.createDataFrame([*rows, (DAY, None)], "day date, p double"), np.array([v for _, v in rows]), [d for d, _ in rows]


def test_merged_days_are_as_close_as_stated(spark, scores, tmp_path):
    frame, values, _ = scores
    path, qs = str(tmp_path / "s"), [0.01, 0.5, 0.95, 0.975, 0.99]
    # A small sketch, so that it has to leave values out.
    sketches.store_sketches(sketches.day_sketches(frame, "p", "day", size=256), path)
    found = sketches.sketched_quantiles(sketches.read_sketches(spark, path), qs)
    error = sketches.rank_error(256)
    for r in found.collect():
        assert r.n == 30_000 and abs((values <= r.value).mean() - r.q) <= error
    checked = sketches.with_rank_check(found, frame, "p", error).collect()
    assert [r.q for r in checked] == qs and all(r.within for r in checked)
    wrong = found.withColumn("value", F.lit(0.9))
    assert not any(r.within for r in sketches.with_rank_check(wrong, frame, "p", error).where("q < 0.96").collect())
    # Large enough, the sketch holds every value of a day.
    exact = {r.q: r.value for r in quantiles(frame, "p", qs).collect()}
    fine = sketches.sketched_quantiles(sketches.day_sketches(frame, "p", "day"), qs)
    assert all(abs(r.value - exact[r.q]) < 0.01 for r in fine.collect())


def test_days_are_replaced_and_chosen(spark, scores, tmp_path):
    frame, values, days = scores
    path = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        sketches.read_sketches(spark, path)
    sketches.store_sketches(sketches.day_sketches(frame, "p", "day"), path)
    sketches.store_sketches(sketches.day_sketches(frame.where(F.col("day") == F.lit(DAY)), "p", "day"), path)
    assert sketches.read_sketches(spark, path).agg(F.sum("n")).first()[0] == 30_000
    some = sketches.read_sketches(spark, path, DAY + dt.timedelta(days=2), DAY + dt.timedelta(days=3))
    inside = [v for v, d in zip(values, days) if 2 <= (d - DAY).days <= 3]
    row = sketches.sketched_quantiles(some, [0.5]).first()
    assert row.n == len(inside) and abs((np.array(inside) <= row.value).mean() - 0.5) <= sketches.rank_error()
    assert sketches.sketched_quantiles(some.where("n < 0"), [0.5]).count() == 0


def test_first_tree_of_depth_one_in_closed_form(spark):
    rng = np.random.default_rng(8)
    flags = rng.integers(0, 2, (600, 3))
    target = (rng.random(600) < 0.2 + 0.5 * flags[:, 1]).astype(int)
    rows = [(f"p{i}", *map(int, f), 0, int(t)) for i, (f, t) in enumerate(zip(flags, target))]
    frame = spark.createDataFrame(rows, "postId string, a int, b int, c int, never int, target int")
    names = ["a", "b", "c", "never"]
    gains = {r.feature: r for r in models.split_gains(frame, names).collect()}
    label = 2.0 * target - 1
    for j, name in enumerate("abc"):
        low, high = label[flags[:, j] == 0], label[flags[:, j] == 1]
        want = label.var() - (len(low) * low.var() + len(high) * high.var()) / 600
        r = gains[name]
        assert (r.n_below, r.n_above) == (len(low), len(high)) and r.gain == pytest.approx(want)
        assert (r.below, r.above) == (pytest.approx(low.mean()), pytest.approx(high.mean()))
    assert gains["never"].gain is None and gains["never"].above is None
    # The fitted tree is the one with the largest gain; its leaves and importance follow.
    model = models.fit_gbt(frame, names, n_estimators=1, max_depth=1)
    assert {r.featureName: r.featureImportance for r in models.feature_importance(spark, model).collect()} == {"a": 0, "b": 1, "c": 0, "never": 0}
    for r in models.score_model(frame, model).collect():
        leaf = gains["b"].above if r.b else gains["b"].below
        assert r.predict_proba_1 == pytest.approx(1 / (1 + np.exp(-2 * leaf)))
    assert models.split_gains(frame.where("a > 1"), names).count() == 0
