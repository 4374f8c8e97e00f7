import datetime as dt

import pytest
from pyspark.sql import functions as F

from posttrend.operators.features import post_features
from posttrend.operators.intake import dedupe_latest
from posttrend.operators.scoring import score_linear
from posttrend.schema import FEATURES, SNAPSHOT
from posttrend.sources.tables import read_scored
from posttrend.streaming.features import drop_aged, drop_repeats, stream_listing, stream_snapshots
from posttrend.streaming.scoring import run_scoring, write_feature_updates, write_final_features

T0 = dt.datetime(2024, 1, 1, 10, 0)


def snap(post, age, score, created=T0):
    load = created + dt.timedelta(minutes=age)
    return (
        load.date(), load.strftime("%H:%M:%S"), load, post, "pics", 1, 1, "t", created, age, score, 1, 0.5, 0,
    )


@pytest.fixture
def feed(spark, tmp_path):
    """Write snapshot files one at a time; each becomes one micro-batch."""
    path = str(tmp_path / "in")

    def write(*rows):
        spark.createDataFrame(list(rows), SNAPSHOT).coalesce(1).write.mode("append").parquet(path)

    write.path = path
    write.stream = lambda: stream_snapshots(spark, path, files_per_batch=1)
    return write


def test_updates_add_up_to_the_batch_result(spark, feed, tmp_path):
    feed(snap("a", 10, 5), snap("b", 15, 1))
    feed(snap("a", 30, 9), snap("a", 50, 20))
    feed(snap("b", 45, 7), snap("c", 5, 2, T0 + dt.timedelta(minutes=30)))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write_feature_updates(feed.stream(), out, state, cadence=None).awaitTermination()
    log = spark.read.parquet(out)
    assert log.where("postId = 'a'").count() == 2
    latest = dedupe_latest(log, ["postId"], "batch").select(*FEATURES.names)
    batch = post_features(spark.read.schema(SNAPSHOT).parquet(feed.path)).select(*FEATURES.names)
    assert latest.exceptAll(batch).count() == 0 and batch.exceptAll(latest).count() == 0


def test_append_emits_final_posts_and_late_rows_are_dropped(spark, feed, tmp_path, rows):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: write_final_features(feed.stream(), out, state, cadence=None).awaitTermination()
    feed(snap("a", 10, 5))
    run()
    feed(snap("a", 50, 9))
    run()
    assert spark.read.schema(FEATURES).parquet(out).count() == 0
    feed(snap("z", 1, 1, T0 + dt.timedelta(hours=3)))  # moves the watermark past a
    run()
    feed(snap("a", 55, 99), snap("z", 2, 3, T0 + dt.timedelta(hours=3)))  # a is final by now
    run()
    got = rows(spark.read.schema(FEATURES).parquet(out), "postId", "maxScore20m", "maxScore41_60m")
    assert got == [("a", 5, 9)]


def test_aged_rows_never_count(spark, rows):
    data = spark.createDataFrame([snap("a", 60, 1), snap("b", 61, 1), snap("c", 1445, 1)], SNAPSHOT)
    assert rows(drop_aged(data), "postId") == [("a",)]


def test_repeats_are_dropped_once(spark, feed, tmp_path):
    feed(snap("a", 10, 5), snap("a", 10, 5))
    feed(snap("a", 10, 5), snap("a", 11, 6))
    out = str(tmp_path / "out")
    writer = drop_repeats(feed.stream()).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.schema(SNAPSHOT).parquet(out).count() == 2


def test_listing_stream_has_the_raw_schema(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    frame = stream_listing(spark, str(tmp_path / "raw"))
    assert frame.isStreaming and "gildings" in frame.columns


def test_streamed_scoring_alerts_once(spark, feed, tmp_path, rows):
    paths = {part: str(tmp_path / part) for part in ("scored", "alerts", "checkpoint")}
    scorer = lambda df: score_linear(df, {"maxScore41_60m": 0.1}, -5.0)
    run = lambda: run_scoring(feed.stream(), scorer, "m", 0.5, paths, cadence=None).awaitTermination()
    feed(snap("a", 45, 10), snap("b", 45, 90))
    run()
    assert rows(spark.read.parquet(paths["alerts"]), "postId") == [("b",)]
    feed(snap("a", 50, 80), snap("b", 50, 95))
    run()
    (a, a_batch), (b, b_batch) = rows(spark.read.parquet(paths["alerts"]), "postId", "batch")
    assert (a, b) == ("a", "b") and a_batch > b_batch
    stored = rows(read_scored(spark, paths["scored"]), "postId", "stepUp", "maxScore41_60m")
    assert stored == [("a", 1, 80), ("b", 1, 90)]  # b alerted already, so its newer row is not stored
    before = spark.read.parquet(paths["alerts"]).count()
    run()
    assert spark.read.parquet(paths["alerts"]).count() == before
    assert spark.read.parquet(paths["scored"]).agg(F.max("batch")).first()[0] == a_batch


def test_scoring_on_a_new_checkpoint_loses_nothing_and_alerts_nothing_again(spark, feed, tmp_path, rows):
    paths = {part: str(tmp_path / part) for part in ("scored", "alerts", "checkpoint")}
    scorer = lambda df: score_linear(df, {"maxScore41_60m": 0.1}, -5.0)
    run = lambda: run_scoring(feed.stream(), scorer, "m", 0.5, paths, cadence=None).awaitTermination()
    feed(snap("a", 45, 10), snap("b", 45, 90))
    feed(snap("c", 45, 80))
    run()
    stored = rows(read_scored(spark, paths["scored"]), "postId", "stepUp")
    assert stored == [("a", 0), ("b", 1), ("c", 1)]
    paths["checkpoint"] = str(tmp_path / "another")
    run()  # all events come again
    assert rows(read_scored(spark, paths["scored"]), "postId", "stepUp") == stored
    assert rows(spark.read.parquet(paths["alerts"]), "postId") == [("b",), ("c",)]
