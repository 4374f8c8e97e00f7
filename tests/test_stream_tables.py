"""Streams over several micro-batches: repeats, late rows, fetches in parts, and the scored log behind them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from posttrend.operators.features import post_features
from posttrend.operators.intake import dedupe_latest
from posttrend.operators.scoring import mark_step_up, with_model_name
from posttrend.plans.collect import FEED_DEPTH, collect_parts, collect_put, feed_snapshots
from posttrend.schema import FEATURES, LISTING, SCORED, SNAPSHOT
from posttrend.sources import scored as log
from posttrend.sources.files import Files
from posttrend.sources.tables import read_snapshots, snapshot_table
from posttrend.streaming import late
from posttrend.streaming.collect import run_collect
from posttrend.streaming.features import latest_rows, stream_listing, stream_snapshots
from posttrend.streaming.scoring import write_updates

T0 = dt.datetime(2024, 1, 1, 10, 0)
EPOCH = dt.datetime(1970, 1, 1)


def snap(post, age, score, created=T0):
    load = created + dt.timedelta(minutes=age)
    return (load.date(), load.strftime("%H:%M:%S"), load, post, "pics", 1, 1, "t", created, age, score, 1, 0.5, 0)


@pytest.fixture
def feed(spark, tmp_path):
    path = str(tmp_path / "in")

    def write(*rows):
        spark.createDataFrame(list(rows), SNAPSHOT).coalesce(1).write.mode("append").parquet(path)

    write.path = path
    write.stream = lambda: stream_snapshots(spark, path, files_per_batch=1)
    return write


# ---------------------------------------------------------------- newest rows


def test_newest_rows_over_batches_equal_the_batch_result(spark, feed, tmp_path, rows):
    feed(snap("a", 10, 5), snap("a", 12, 4), snap("b", 15, 1))
    feed(snap("a", 11, 99), snap("b", 40, 7))  # the row of a is older than the newest one
    feed(snap("b", 40, 6), snap("c", 1, 1))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    newest = latest_rows(feed.stream(), ["loadTSUTC", "score"]).select("postId", "loadTSUTC", "score")
    write_updates(newest, out, state, cadence=None).awaitTermination()
    got = rows(dedupe_latest(spark.read.parquet(out), ["postId"], "batch"), "postId", "score")
    batch = dedupe_latest(spark.read.schema(SNAPSHOT).parquet(feed.path), ["postId"], "loadTSUTC", ["score"])
    assert got == rows(batch, "postId", "score") == [("a", 4), ("b", 7), ("c", 1)]


def test_newest_row_is_final_once_its_time_is_over(spark, feed, tmp_path, rows):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        newest = latest_rows(feed.stream(), ["loadTSUTC"]).select("postId", "score")
        writer = newest.writeStream.outputMode("append").format("parquet").option("path", out)
        writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

    feed(snap("a", 10, 5))
    feed(snap("a", 30, 6))
    run()
    assert spark.read.schema("postId string, score int").parquet(out).count() == 0
    feed(snap("z", 1, 1, T0 + dt.timedelta(hours=3)))
    run()
    feed(snap("a", 40, 7), snap("z", 2, 2, T0 + dt.timedelta(hours=3)))  # too late for a
    run()
    assert rows(spark.read.schema("postId string, score int").parquet(out)) == [("a", 6)]


# ---------------------------------------------------------------- late rows


def test_late_rows_go_aside_and_are_filled_in(spark, feed, tmp_path, rows):
    path, state = str(tmp_path / "split"), str(tmp_path / "state")
    run = lambda: late.split_late(feed.stream(), path, state, cadence=None).awaitTermination()
    feed(snap("a", 10, 5), snap("old", 1, 1, T0 - dt.timedelta(hours=9)))  # nothing was seen before, so none is late
    feed(snap("z", 1, 1, T0 + dt.timedelta(hours=3)), snap("a", 12, 6))
    feed(snap("a", 50, 90), snap("z", 45, 4, T0 + dt.timedelta(hours=3)), snap("y", 5, 1, T0 + dt.timedelta(minutes=90)))
    run()
    kept, gone = (late.read_side(spark, path, side, SNAPSHOT) for side in ("kept", "late"))
    assert rows(gone, "postId", "score") == [("a", 90)]
    assert kept.count() + gone.count() == 7
    told = late.marks(spark, path)
    assert [(m["kept"], m["late"]) for m in told] == [(2, 0), (2, 0), (2, 1)]
    assert told[0]["seen"] == (T0 - EPOCH) // dt.timedelta(microseconds=1)

    # A repeated batch starts from the mark before it and replaces what it wrote.
    files = Files(spark, state)
    files.delete(f"{state}/commits/2")
    run()
    assert late.marks(spark, path) == told and late.read_side(spark, path, "late", SNAPSHOT).count() == 1

    kept, gone = (late.read_side(spark, path, side, SNAPSHOT) for side in ("kept", "late"))

    # The back-fill gives the posts the features that all their rows would have given.
    stored = str(tmp_path / "table")
    snapshot_table(spark, stored).put(kept)
    filled = late.backfill(gone, stored).select(*FEATURES.names)
    want = post_features(spark.read.schema(SNAPSHOT).parquet(feed.path)).where("postId = 'a'").select(*FEATURES.names)
    assert rows(filled) == rows(want) and read_snapshots(spark, stored).count() == 7


# ---------------------------------------------------------------- fetches in parts


def item(feed, view, rank, post, at, stickied=False, score=1):
    return (feed, view, rank, stickied, (at - EPOCH).total_seconds() - 600, post, "t", score, 1, 0.5, {"g": 1}, 9, 1, at)


def landing():
    """Three fetches of the hot view: more items than are kept, a pinned one at the top."""
    out = []
    for n, at in enumerate((T0, dt.datetime(2024, 1, 2))):
        out += [item("pics", "hot", r, f"p{n}{r}", at, stickied=r == 0) for r in range(8)]
        out += [item("news", "hot", r, f"q{n}{r}", at) for r in range(2)]
        out += [item("pics", "rising", r, f"p{n}{r}", at) for r in range(4)]
    return out


@pytest.mark.parametrize("cut", [lambda i: i % 2, lambda i: -i // 11])
def test_fetches_in_parts_are_ranked_as_a_whole(spark, tmp_path, rows, cut):
    items = landing()
    whole = spark.createDataFrame(items, LISTING)
    paths = {view: str(tmp_path / view) for view in ("hot", "rising")}
    kept = str(tmp_path / "items")
    for part in sorted({cut(i) for i in range(len(items))}):
        batch = spark.createDataFrame([x for i, x in enumerate(items) if cut(i) == part], LISTING)
        collect_parts(batch, paths, kept)
    collect_parts(batch, paths, kept)  # a repeat changes nothing
    for view, path in paths.items():
        want = feed_snapshots(whole, view, FEED_DEPTH[view])
        assert rows(read_snapshots(spark, path), "postId", "loadTSUTC") == rows(want, "postId", "loadTSUTC")


def test_parts_collected_as_a_stream(spark, tmp_path, rows):
    items = landing()
    for part in range(3):
        spark.createDataFrame(items[part::3], LISTING).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    paths = {"hot": str(tmp_path / "hot")}
    stream = stream_listing(spark, str(tmp_path / "in"))
    run_collect(stream, paths, str(tmp_path / "state"), cadence=None, items=str(tmp_path / "items")).awaitTermination()
    want = feed_snapshots(spark.createDataFrame(items, LISTING), "hot")
    assert rows(read_snapshots(spark, paths["hot"]), "postId") == rows(want, "postId")


def test_collected_again_snapshots_replace_themselves(spark, tmp_path, rows):
    paths = {"hot": str(tmp_path / "hot")}
    collect_put(spark.createDataFrame([item("pics", "hot", 1, "a", T0)], LISTING), paths)
    collect_put(spark.createDataFrame([item("pics", "hot", 1, "a", T0, score=7), item("pics", "hot", 2, "b", T0)], LISTING), paths)
    assert rows(read_snapshots(spark, paths["hot"]), "postId", "score") == [("a", 7), ("b", 1)]


# ---------------------------------------------------------------- the scored log


@pytest.fixture
def batch(spark):
    def build(*posts):
        """(post, score, creation day) triples as scored rows."""
        made = [(p, "pics", "t", dt.datetime(2024, 1, day, 3), 40, float(s)) for p, s, day in posts]
        frame = spark.createDataFrame(made, "postId string, subreddit string, title string, createdTSUTC timestamp, timeElapsedMin int, s double")
        for f in FEATURES.fields[5:]:
            frame = frame.withColumn(f.name, F.lit(0).cast(f.dataType))
        frame = mark_step_up(frame.withColumn("predict_proba_1", F.col("s")), 0.5)
        return with_model_name(frame, "m").select(*SCORED.names)

    return build


def current(spark, path, rows, **options):
    return rows(log.read_scored(spark, path, **options), "postId", "predict_proba_1")


def test_attempts_count_once_committed(spark, tmp_path, batch, rows):
    path = str(tmp_path / "scored")
    with pytest.raises(FileNotFoundError):
        log.read_scored(spark, path)
    log.append_scored(batch(("a", 0.1, 1)), path, 1)
    lost = log.write_attempt(batch(("a", 0.9, 1), ("b", 0.9, 1)), path, 2)
    assert current(spark, path, rows) == [("a", 0.1)]
    again = log.write_attempt(batch(("b", 0.2, 2)), path, 2)
    log.commit(spark, path, again)
    assert current(spark, path, rows) == [("a", 0.1), ("b", 0.2)]
    assert lost.folder.split("/")[-1] not in Files(spark, path).names(f"{path}/run=jobs/batch=2")
    log.commit(spark, path, log.write_attempt(batch(), path, 2))
    assert current(spark, path, rows) == [("a", 0.1)] and log.read_scored_batch(spark, path, 2).count() == 0


def test_folding_keeps_what_readers_see(spark, tmp_path, batch, rows):
    path = str(tmp_path / "scored")
    log.append_scored(batch(("a", 0.1, 1), ("b", 0.2, 2)), path, 1)
    log.append_scored(batch(("a", 0.3, 1), ("c", 0.4, 3)), path, 2)
    log.append_scored(batch(("d", 0.5, 3)), path, 3, run="other")
    before = current(spark, path, rows)
    head = log.compact(spark, path, before=3)
    assert head.upto == 2 and [a.batch for a in log.committed(spark, path)] == [3]
    assert current(spark, path, rows) == before == [("a", 0.3), ("b", 0.2), ("c", 0.4), ("d", 0.5)]
    assert current(spark, path, rows, since=dt.date(2024, 1, 3)) == [("c", 0.4), ("d", 0.5)]
    # The next fold leaves the days it has no rows for as they are.
    days = log.base_table(spark, path).manifest().days
    log.append_scored(batch(("c", 0.9, 3)), path, 4)
    log.compact(spark, path)
    after = log.base_table(spark, path).manifest().days
    assert days["2024-01-01"] == after["2024-01-01"] and days["2024-01-03"] != after["2024-01-03"]
    assert current(spark, path, rows) == [("a", 0.3), ("b", 0.2), ("c", 0.9), ("d", 0.5)]
    assert log.compact(spark, path) == log.head(spark, path)
    # What stands before the last folded batch can no longer be told apart.
    assert current(spark, path, rows, before_batch=9) == current(spark, path, rows)
    with pytest.raises(ValueError, match="folded"):
        log.read_scored(spark, path, before_batch=2)


def test_a_fold_that_breaks_off_is_harmless(spark, tmp_path, batch, rows, monkeypatch):
    path = str(tmp_path / "scored")
    log.append_scored(batch(("a", 0.1, 1)), path, 1)
    log.append_scored(batch(("a", 0.7, 1), ("b", 0.2, 1)), path, 2)
    want = current(spark, path, rows)
    delete = Files.delete
    monkeypatch.setattr(Files, "delete", lambda self, name: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        log.compact(spark, path)
    monkeypatch.setattr(Files, "delete", delete)
    assert log.committed(spark, path) == [] and current(spark, path, rows) == want
    log.append_scored(batch(("a", 0.3, 1)), path, 3)
    log.compact(spark, path)
    assert current(spark, path, rows) == [("a", 0.3), ("b", 0.2)]
