import datetime as dt
import sys
import warnings

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from posttrend.catalog import QUERIES
from posttrend.operators import logistic, models
from posttrend.operators.evaluate import auc_pr
from posttrend.operators.scoring import score_linear
from posttrend.operators.splits import stored_folds, stratified_splits
from posttrend.session import cut_lineage
from posttrend.sources import registry

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2)) * [1.0, 3.0]
    y = (rng.random(400) < 1 / (1 + np.exp(1.0 - 1.5 * x[:, 0] + 0.2 * x[:, 1]))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(f"k{i}", float(a), float(b), int(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return cut_lineage(spark.createDataFrame(rows, "postId string, a double, b double, target int"))


@pytest.fixture(scope="module")
def lr(frame):
    return models.fit_lr(frame, FEATURES, c=0.25)


def penalised_optimum(x, y, c):
    """Newton steps on C * sum(log loss) + |w|^2 / 2 with a free intercept."""
    design = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = c * design.T @ (p - y) + penalty @ w
        hessian = c * (design.T * (p * (1 - p))) @ design + penalty
        w -= np.linalg.solve(hessian, gradient)
    return w


def test_logistic_strength_means_the_same_as_c(lr, data):
    weights, intercept = models.linear_weights(lr)
    assert [*weights.values(), intercept] == pytest.approx(list(penalised_optimum(*data, 0.25)), abs=1e-5)


def test_model_scores_equal_plain_weights(lr, frame):
    by_model = models.score_model(frame, lr)
    assert by_model.columns == [*frame.columns, "predict_proba_1"]
    both = by_model.join(score_linear(frame, *models.linear_weights(lr), out="q"), "postId")
    assert both.agg(F.max(F.abs(F.col("predict_proba_1") - F.col("q")))).first()[0] < 1e-12


def test_gradient_is_the_loss_slope_and_vanishes_at_the_optimum(frame, data, lr):
    x, y = data
    w = np.array([0.3, -0.2, 0.1])
    z = np.hstack([x, np.ones((len(x), 1))])
    e = 1 / (1 + np.exp(-(z @ w))) - y
    pull = np.array([*w[:2], 0.0])
    want = pull + 0.5 * z.T @ e
    size = abs(pull) + 0.5 * abs(z * e[:, None]).sum(axis=0)
    got = models.lr_gradient(frame, {"a": 0.3, "b": -0.2}, 0.1, c=0.5).collect()
    assert [r.feature for r in got] == ["a", "b", "intercept"]
    assert [r.gradient for r in got] == pytest.approx(list(want))
    assert [r.share for r in got] == pytest.approx(list(abs(want) / size))
    assert max(r.share for r in models.lr_gradient(frame, *models.linear_weights(lr), c=0.25).collect()) < 1e-5


def test_a_fit_that_stops_early_is_an_error(frame):
    with pytest.raises(ValueError, match="no optimum"):
        models.fit_lr(frame, FEATURES, c=100.0, max_iter=1)
    assert models.fit_lr(frame, FEATURES, c=100.0, max_iter=1, tolerance=None) is not None


def test_coefficient_table(spark, lr):
    table = {r.feature: r for r in models.coef_table(spark, lr).collect()}
    assert set(table) == {"a", "b", "intercept"}
    assert sum(r.coefPct for r in table.values()) == pytest.approx(1.0)


@pytest.fixture(scope="module")
def lopsided():
    """Columns that hold one value but for a few rows, beside large ones: what maxima over very many snapshots are."""
    rng = np.random.default_rng(1)
    n = 1000
    large = rng.gumbel(4000, 500, size=(n, 2)).round()
    ratio, growth = np.full((n, 2), 0.99), np.zeros(n)
    ratio[rng.random((n, 2)) < 0.003] = 0.98
    growth[rng.random(n) < 0.004] = 1 / 98
    flags = (rng.integers(0, 4, n)[:, None] == [0, 1, 2]).astype(float)
    x = np.column_stack([large, 99 - (ratio[:, ::-1] < 0.99), ratio, large[:, 1] / large[:, 0] - 1, growth, flags])
    y = (rng.random(n) < 1 / (1 + np.exp(11 - 0.0012 * large.sum(axis=1)))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def lopsided_frame(spark, lopsided):
    x, y = lopsided
    rows = [(f"k{i}", *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    names = "".join(f", f{j} double" for j in range(x.shape[1]))
    return cut_lineage(spark.createDataFrame(rows, f"postId string{names}, target int"))


def scaled_optimum(x, y, c):
    """``penalised_optimum`` in units of the columns' deviations, by Newton steps from the log-odds of the labels."""
    mean, size = x.mean(axis=0), x.std(axis=0)
    design = np.hstack([(x - mean) / size, np.ones((len(x), 1))])
    penalty = np.append(size**-2.0, 0.0)
    w = np.zeros(design.shape[1])
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        hessian = c * (design.T * (p * (1 - p))) @ design + np.diag(penalty)
        unit = np.sqrt(np.diag(hessian))
        w -= np.linalg.solve(hessian / np.outer(unit, unit), (c * design.T @ (p - y) + penalty * w) / unit) / unit
    return np.append(w[:-1] / size, w[-1] - (w[:-1] / size) @ mean)


def test_almost_constant_columns_have_an_optimum(spark, lopsided, lopsided_frame):
    x, y = lopsided
    names = [f"f{j}" for j in range(x.shape[1])]
    table = models.coef_table(spark, models.fit_lr(lopsided_frame, names, tolerance=1e-10)).orderBy("position").collect()
    assert [r.feature for r in table] == [*names, "intercept"]
    assert [r.coef for r in table] == pytest.approx(list(scaled_optimum(x, y, 0.25)), rel=1e-6)


def test_almost_constant_columns_are_scored_at_the_optimum(lopsided, lopsided_frame):
    x, y = lopsided
    model = models.fit_lr(lopsided_frame, [f"f{j}" for j in range(x.shape[1])])
    got = {r.postId: r.predict_proba_1 for r in models.score_model(lopsided_frame, model).collect()}
    w = scaled_optimum(x, y, 0.25)
    want = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert got == pytest.approx({f"k{i}": p for i, p in enumerate(want)}, abs=1e-9)


def test_constant_columns_weigh_nothing(lopsided, lopsided_frame):
    x, y = lopsided
    names = [f"f{j}" for j in range(x.shape[1])]
    fixed = {"most": 99.0, "ratio": 0.99, "nought": 0.0}
    rows = lopsided_frame.withColumns({name: F.lit(value) for name, value in fixed.items()})
    weights, intercept = models.linear_weights(models.fit_lr(rows, [*names[:6], *fixed, *names[6:]], tolerance=1e-10))
    assert [weights[name] for name in fixed] == [0.0] * len(fixed)
    assert [*[weights[name] for name in names], intercept] == pytest.approx(list(scaled_optimum(x, y, 0.25)), rel=1e-6)


def test_rows_far_from_the_border_come_to_rest(spark):
    """Labels that one column tells apart, over many powers of ten."""
    x = np.random.default_rng(39).lognormal(0, 4, (20, 2))
    y = x[:, 0] >= np.sort(x[:, 0])[-2]
    rows = [(*map(float, r), int(t)) for r, t in zip(x, y)]
    frame = cut_lineage(spark.createDataFrame(rows, "a double, b double, target int"))
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message=".*before they were at rest")
        model = models.fit_lr(frame, FEATURES, max_iter=50)
    got = models.score_model(frame, model).select("target", "predict_proba_1").collect()
    assert all((r.predict_proba_1 > 0.5) == r.target for r in got)


def test_labels_all_alike_are_scored(frame):
    for label in (0, 1):
        alike = frame.withColumn("target", F.lit(label))
        scored = models.score_model(alike, models.fit_lr(alike, FEATURES))
        assert [tuple(r) for r in scored.select("predict_proba_1").distinct().collect()] == [(float(label),)]


def test_labels_all_alike_leave_an_intercept(frame):
    for label in (0, 1):
        alike = frame.withColumn("target", F.lit(label))
        weights, intercept = models.linear_weights(models.fit_lr(alike, FEATURES, tolerance=None))
        assert (list(weights.values()), intercept) == ([0.0, 0.0], np.inf if label else -np.inf)
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        models.fit_lr(frame.withColumn("target", F.lit(2)), FEATURES)


def test_boosted_trees_learn(spark, frame):
    model = models.fit_gbt(frame, FEATURES, n_estimators=5, learning_rate=0.1)
    scored = models.score_model(frame, model)
    assert auc_pr(scored, "predict_proba_1", "target").first().aucpr > 0.7
    importance = models.feature_importance(spark, model).collect()
    assert importance[0].featureName == "a"
    assert sum(r.featureImportance for r in importance) == pytest.approx(1.0)


def test_attribution(frame, data):
    x, y = data
    weights = {"a": 0.5, "b": -2.0}
    got = {(r.target, r.feature): r for r in models.linear_attribution(frame, weights).collect()}
    for j, f in enumerate(FEATURES):
        parts = np.abs(weights[f] * (x[:, j] - x[:, j].mean()))
        for t in (0, 1):
            assert got[(t, f)].mean_abs == pytest.approx(parts[y == t].mean())
            assert got[(t, f)].max_abs == pytest.approx(parts[y == t].max())
    total = models.attribution_rows(frame, weights, ["postId"]).agg(F.sum("attribution")).first()[0]
    assert total == pytest.approx(0.0, abs=1e-6)


def test_grid_search_measures_every_fold(frame, data):
    folds = stored_folds(frame, "target", "postId", n=2)
    fitter = models.ml_fitter(lambda params, n: models.logistic_stage(n, params["C"]), FEATURES)
    results = models.grid_search(folds, fitter, {"C": [1.0, 0.01]}, q=0.9, top=0.8)
    rows = results.collect()
    assert sorted((r.C, r.split) for r in rows) == [(0.01, 0), (0.01, 1), (1.0, 0), (1.0, 1)]

    # One fold again by hand.
    x, y = data
    train = {r.postId for r in folds.train(1).collect()}
    inside = np.array([f"k{i}" in train for i in range(len(y))])
    w = penalised_optimum(x[inside], y[inside], 1.0)
    p = 1 / (1 + np.exp(-(np.hstack([x[~inside], np.ones((sum(~inside), 1))]) @ w)))
    up, yt = p >= np.quantile(p, 0.9), y[~inside]
    fold = next(r for r in rows if r.C == 1.0 and r.split == 1)
    assert fold.top2PctPrecision == pytest.approx(yt[up].mean())
    assert fold.top2PctRecall == pytest.approx(yt[up].sum() / yt.sum())

    summary = models.cv_summary(results, ["C"])
    c1 = [r.aucpr for r in rows if r.C == 1.0]
    row = summary.where("C = 1.0").first()
    assert (row.splits, row.mean_aucpr, row.std_aucpr) == (2, pytest.approx(np.mean(c1)), pytest.approx(np.std(c1)))
    assert models.leaderboard(summary, ["C"], n=1).count() == 1
    assert models.best_params(summary, ["C"])["C"] in (1.0, 0.01)
    assert models.grid_long(summary, ["C"], "mean_aucpr").columns == ["mean_aucpr", "param", "param_value"]


def test_search_shares_its_passes_and_fits_each_split(lopsided, lopsided_frame, monkeypatch):
    x, _ = lopsided
    names = [f"f{j}" for j in range(x.shape[1])]
    folds = stored_folds(lopsided_frame, "target", "postId", n=3)
    grid = {"C": [1.0, 0.01, 0.00001]}
    fitter = models.ml_fitter(lambda params, n: models.logistic_stage(n, params["C"]), names)
    passes, sums = [], logistic._sums
    monkeypatch.setattr(logistic, "_sums", lambda *args: passes.append(len(args[2])) or sums(*args))
    together = models.grid_search(folds, fitter, grid, q=0.9, top=0.8)
    assert max(passes) == 9 and len(passes) <= 15
    alone = models.grid_search(folds, lambda rows, params, n: fitter(rows, params, n), grid, q=0.9, top=0.8)
    order = ["split", "C"]
    rows = lambda df: [tuple(r) for r in df.select(*order, *models.MEASURES).orderBy(*order).collect()]
    assert len(rows(together)) == 9
    for a, b in zip(rows(together), rows(alone)):
        assert a == pytest.approx(b, abs=1e-9)

    # All fits end at their optimum.
    for (i, split), scorer in fitter.together(folds, models.expand_grid(grid)).items():
        inside = np.array([r._in for r in lopsided_frame.select("postId", folds.is_train(split).alias("_in")).collect()])
        w = scaled_optimum(x[inside], lopsided[1][inside], grid["C"][i])
        got = np.array([r.predict_proba_1 for r in scorer(lopsided_frame, None).collect()])
        assert got == pytest.approx(1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))), abs=1e-9)


def test_folds_are_the_stratified_splits(frame):
    folds = stored_folds(frame, "target", "postId", n=3)
    want = stratified_splits(frame, "target", "postId", n=3).collect()
    for split in range(3):
        train = {r.postId for r in want if r.split == split and r.is_train}
        assert {r.postId for r in folds.train(split).collect()} == train
        assert {r.postId for r in folds.test(split).collect()} == {r.postId for r in want} - train
        assert folds.sizes[split] == len(train)


def test_beginnings_of_an_ensemble_are_the_shorter_fits(frame):
    whole = models.fit_gbt(frame, FEATURES, n_estimators=6, max_depth=2, learning_rate=0.1)
    for n in (2, 6):
        shorter = models.fit_gbt(frame, FEATURES, n_estimators=n, max_depth=2, learning_rate=0.1)
        want = {r.postId: r.predict_proba_1 for r in models.score_model(frame, shorter).collect()}
        got = {r.postId: r.predict_proba_1 for r in models.score_model(frame, models.first_trees(whole, n)).collect()}
        assert got == pytest.approx(want, abs=1e-12)
    with pytest.raises(ValueError):
        models.first_trees(whole, 7)


def test_beginning_of_an_ensemble_can_be_stored(spark, frame, tmp_path):
    short = models.first_trees(models.fit_gbt(frame, FEATURES, n_estimators=4, max_depth=2), 2)
    registry.save_model(short, str(tmp_path), registry.model_name("GBM"))
    loaded, _ = registry.load_latest(spark, str(tmp_path))
    score = lambda m: sorted((r.postId, r.predict_proba_1) for r in models.score_model(frame, m).collect())
    assert score(loaded) == score(short)


def test_staged_search_fits_once_and_measures_alike(frame):
    folds = stored_folds(frame, "target", "postId", n=2)
    grid = {"n_estimators": [2, 4], "learning_rate": [0.1], "min_samples_leaf": [1, 5], "max_depth": [2]}
    fitted = []

    def counted(rows, params, n):
        fitted.append(params)
        return models.ml_fitter(lambda p, _: models.boosted_stage(**p), FEATURES)(rows, params, n)

    staged = models.grid_search(folds, counted, grid, staged="n_estimators", q=0.9, top=0.8)
    assert sorted((p["n_estimators"], p["min_samples_leaf"]) for p in fitted) == [(4, 1), (4, 1), (4, 5), (4, 5)]
    plain = models.grid_search(folds, counted, grid, q=0.9, top=0.8)
    assert len(fitted) == 4 + 8
    order = ["split", *grid]
    rows = lambda df: [tuple(r) for r in df.select(*order, *models.MEASURES).orderBy(*order).collect()]
    assert len(rows(staged)) == 8
    for a, b in zip(rows(staged), rows(plain)):
        assert a == pytest.approx(b, abs=1e-9)

    # The combination with the best upper part of the curve is fitted on all rows.
    summary = models.cv_summary(staged, list(grid))
    best = models.best_params(summary, list(grid))
    top = max(summary.collect(), key=lambda r: (r.mean_top5Pctaucpr, *[-r[k] for k in grid]))
    assert best == {k: top[k] for k in grid}
    model = models.refit(frame, lambda p, _: models.boosted_stage(**p), best, FEATURES)
    assert model.stages[1].getNumTrees == best["n_estimators"]


def test_equal_combinations_have_an_order(spark):
    rows = [(c, 0.5, 1.0) for c in (3.0, 1.0, 2.0)] + [(4.0, None, 2.0)]
    summary = spark.createDataFrame(rows, "C double, mean_aucpr double, mean_top5Pctaucpr double")
    assert [r.C for r in models.leaderboard(summary, ["C"], n=2).collect()] == [1.0, 2.0]
    assert models.best_params(summary, ["C"])["C"] == 4.0


def test_registered_searches_are_whole(spark, sf_small, monkeypatch):
    asked = []

    def search(folds, fitter, grid, **options):
        asked.append((grid, len(folds.cuts), options))
        rows = [(i % 2, *map(float, c.values()), 0.5, 0.5, 0.5, 0.5) for i, c in enumerate(models.expand_grid(grid))]
        names = [f"{c} double" for c in [*grid, *models.MEASURES]]
        return spark.createDataFrame(rows, "split int, " + ", ".join(names))

    monkeypatch.setattr(models, "grid_search", search)
    assert QUERIES["cv_summary"](spark, sf_small).count() == 8
    assert QUERIES["cv_summary_trees"](spark, sf_small).count() == 108
    assert asked[0] == ({"C": [1, 0.5, 0.25, 0.1, 0.01, 0.001, 0.0001, 0.00001]}, 10, {})
    assert asked[1][1:] == (10, {"staged": "n_estimators"})


def test_grid_expansion():
    grid = {"n": [50, 100, 150], "rate": [0.1, 0.01, 0.001], "leaf": [1, 3, 5, 7], "depth": [2, 3, 4]}
    assert len(models.expand_grid(grid)) == 108


class Foreign:
    feature_names_in_ = np.array(["b", "a"])

    def predict_proba(self, batch):
        assert list(batch.columns) == ["b", "a"]
        p = 1 / (1 + np.exp(-batch["a"].to_numpy()))
        return np.column_stack([1 - p, p])


def test_model_from_outside(frame):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    scored = models.score_foreign(frame, Foreign())
    worst = scored.agg(F.max(F.abs(F.col("predict_proba_1") - 1 / (1 + F.exp(-F.col("a")))))).first()[0]
    assert worst < 1e-12


def test_refit_uses_all_rows(frame, data):
    model = models.refit(frame, lambda params, n: models.logistic_stage(n, params["C"]), {"C": 0.25}, FEATURES)
    weights, intercept = models.linear_weights(model)
    assert [*weights.values(), intercept] == pytest.approx(list(penalised_optimum(*data, 0.25)), abs=1e-5)


def test_newest_model_wins(spark, lr, frame, tmp_path):
    root = str(tmp_path)
    old = registry.model_name("LR", dt.datetime(2031, 2, 3, 4, 5, 6))
    new = registry.model_name("GBM", dt.datetime(2031, 2, 7, 8, 9, 10))
    assert new == "post_model_20310207-080910_GBM"
    for name in (new, old):
        registry.save_model(lr, root, name)
    model, name = registry.load_latest(spark, root)
    assert name == new
    assert models.linear_weights(model) == models.linear_weights(lr)
    assert models.score_model(frame, model).count() == 400
    assert models.linear_weights(registry.load_model(root, old)) == models.linear_weights(lr)


def test_no_model_is_an_error(spark, tmp_path):
    (tmp_path / "other").mkdir()
    with pytest.raises(FileNotFoundError):
        registry.load_latest(spark, str(tmp_path))
