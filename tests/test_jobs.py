"""The command-line jobs, chained from landed items to a report."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from posttrend.__main__ import main
from posttrend.operators import models
from posttrend.operators.features import fill_features, time_features
from posttrend.plans.modeling import build_model, read_threshold
from posttrend.schema import FEATURES, LISTING
from posttrend.sources import registry
from posttrend.sources.tables import read_scored, read_snapshots, read_training
from posttrend.streaming.collect import run_collect
from posttrend.streaming.features import stream_listing

T0 = dt.datetime(2024, 1, 1, 9, 0)
EPOCH = dt.datetime(1970, 1, 1)
POSTS = 12


def items():
    """Twelve posts followed for an hour; the later a post, the better it does; three become hot."""
    out = []
    for minute in (10, 30, 50):
        at = T0 + dt.timedelta(minutes=minute)
        for n in range(POSTS):
            out.append(("pics", "rising", n, False, (T0 - EPOCH).total_seconds(), f"p{n:02d}", "t", n * minute, n, 0.5, {}, 9, 1, at))
    for n in (9, 10, 11):
        at = T0 + dt.timedelta(hours=5)
        out.append(("pics", "hot", n, False, (T0 - EPOCH).total_seconds(), f"p{n:02d}", "t", 20000, n, 0.9, {}, 9, 1, at))
    return out


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("jobs")
    spark.createDataFrame(items(), LISTING).coalesce(1).write.json(str(path / "landed"))
    return path


def test_jobs_in_order(spark, root):
    at = lambda name: str(root / name)
    main(["collect", "--listing", at("landed"), "--rising", at("rising"), "--hot", at("hot")])
    assert read_snapshots(spark, at("rising")).count() == 3 * POSTS
    assert read_snapshots(spark, at("hot")).count() == 3

    main(["training", "--rising", at("rising"), "--hot", at("hot"), "--output", at("train"), "--start", "2024-01-01"])
    train = read_training(spark, at("train"))
    assert {r.postId for r in train.where("target = 1").collect()} == {"p09", "p10", "p11"}

    fit = ["fit", "--training", at("train"), "--kind", "lr", "--models", at("models"), "--output", at("fitted")]
    main([*fit, "--grid", '{"C": [1.0, 0.001]}', "--splits", "2", "--at", "2024-01-01"])
    assert spark.read.parquet(at("fitted/search")).count() == 2
    assert spark.read.parquet(at("fitted/holdout")).columns == [
        "aucpr", "top5Pctaucpr", "top2PctThreshold", "top2PctPrecision", "top2PctRecall",
    ]
    model, name = registry.load_latest(spark, at("models"))
    assert name == registry.model_name("LR", dt.datetime(2024, 1, 1))
    rows = time_features(fill_features(train))
    scores = sorted(r.predict_proba_1 for r in models.score_model(rows, model).collect())
    threshold = read_threshold(spark, at("fitted"), name)
    assert threshold == pytest.approx(np.quantile(scores, 0.975))
    weights = {r.feature: r.coef for r in spark.read.parquet(at("fitted/weights")).collect()}
    assert weights == {**models.linear_weights(model)[0], "intercept": models.linear_weights(model)[1]}
    review = spark.read.parquet(at("fitted/review")).collect()
    assert {r.postId for r in review} >= {"p09", "p10", "p11"}
    with pytest.raises(ValueError):
        read_threshold(spark, at("fitted"), "another")

    score = ["score", "--rising", at("rising"), "--models", at("models"), "--threshold", "0.5", "--scored", at("scored")]
    score += ["--alerts", at("alerts"), "--as-of", "2024-01-01T10:00:00"]
    main(score)
    main(score)  # repeating a run replaces it
    scored = read_scored(spark, at("scored"))
    assert scored.count() == POSTS
    assert {r.postId for r in scored.where("stepUp = 1").collect()} == {"p09", "p10", "p11"}
    assert spark.read.parquet(at("alerts")).count() == 3

    own = [x if x not in ("--threshold", "0.5") else {"--threshold": "--reports", "0.5": at("fitted")}[x] for x in score]
    own[own.index(at("scored"))], own[own.index(at("alerts"))] = at("scored-own"), at("alerts-own")
    main(own)
    above = {r.postId for r in read_scored(spark, at("scored-own")).where("stepUp = 1").collect()}
    assert above == {r.postId for r in models.score_model(rows, model).where(F.col("predict_proba_1") >= threshold).collect()}

    main(["report", "--scored", at("scored"), "--hot", at("hot"), "--output", at("report"), "--as-of", "2024-01-02T09:00:00"])
    row = spark.read.parquet(at("report")).first()
    assert (row.recall_hotPost10k, row.precision_hotPost10k) == (1.0, 1.0)


def test_streamed_collect_equals_the_batch_job(spark, root, tmp_path):
    paths = {view: str(tmp_path / view) for view in ("rising", "hot")}
    stream = stream_listing(spark, str(root / "landed"))
    run_collect(stream, paths, str(tmp_path / "state"), cadence=None).awaitTermination()
    assert read_snapshots(spark, paths["rising"], latest_only=True).count() == 3 * POSTS
    assert read_snapshots(spark, paths["hot"], latest_only=True).count() == 3


def test_trees_are_built_with_a_search(spark, tmp_path):
    rows = [(f"p{i}", "t", "pics", T0 + dt.timedelta(minutes=i), 40, int(i % 4 == 0), 10 * (i % 4 == 0) + i % 3) for i in range(80)]
    layout = "postId string, title string, subreddit string, createdTSUTC timestamp, timeElapsedMin int, target int, v int"
    frame = spark.createDataFrame(rows, layout)
    frame = frame.select("*", *[(F.col("v") * 1.0).cast(f.dataType).alias(f.name) for f in FEATURES.fields if f.name.startswith("max")])
    grid = {"n_estimators": [1, 3], "learning_rate": [0.1], "min_samples_leaf": [1], "max_depth": [1]}
    built = build_model(frame, "gbt", str(tmp_path / "models"), str(tmp_path / "out"), grid, n_splits=2, at=T0)
    search = spark.read.parquet(str(tmp_path / "out" / "search")).collect()
    assert len(search) == 2 and built.params["n_estimators"] in (1, 3) and isinstance(built.params["n_estimators"], int)
    assert built.name == registry.model_name("GBM", T0) and built.model.stages[1].getNumTrees == built.params["n_estimators"]
    assert spark.read.parquet(str(tmp_path / "out" / "holdout")).first().aucpr == pytest.approx(1.0)
    weights = spark.read.parquet(str(tmp_path / "out" / "weights"))
    assert weights.agg(F.sum("featureImportance")).first()[0] == pytest.approx(1.0)
