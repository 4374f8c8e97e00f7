import datetime as dt
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from posttrend.operators import intake
from posttrend.plans.collect import collect, feed_snapshots
from posttrend.schema import LANDED, LISTING, SNAPSHOT
from posttrend.sources.tables import (
    append_snapshots,
    read_landed_csv,
    read_listing,
    read_snapshots,
    replace_days,
    rewrite_without,
)

NOW = dt.datetime(2024, 3, 1, 12, 0, 0, 750000)
EPOCH = dt.datetime(1970, 1, 1)


def item(id_, age_seconds, rank, view="rising", stickied=False, gildings=None, fetched=NOW, subreddit="pics"):
    created = (fetched.replace(microsecond=0) - EPOCH).total_seconds() - age_seconds
    return (
        subreddit, view, rank, stickied, created, id_, f"title {id_}", 10, 2, 0.5, gildings or {}, 100, 5, fetched,
    )


def listing(spark, items):
    return spark.createDataFrame(items, LISTING)


@pytest.mark.parametrize(
    "top_n, view, time_filter",
    [(26, "rising", None), (5, "new", None), (5, "top", None), (5, "top", "decade")],
)
def test_bad_feed_requests(top_n, view, time_filter):
    with pytest.raises(ValueError):
        intake.check_feed_request(top_n, view, time_filter)


def test_good_feed_requests():
    intake.check_feed_request(25, "rising")
    intake.check_feed_request(5, "top", "week")


def test_age_edges_of_the_rising_feed(spark, rows):
    ages = {"a": 20 * 60, "b": 60 * 60, "c": 60 * 60 + 59, "d": 61 * 60, "e": 86400 + 60, "f": 25 * 3600}
    frame = listing(spark, [item(k, s, i) for i, (k, s) in enumerate(ages.items())])
    got = rows(intake.normalize_listing(frame, "rising"), "postId", "timeElapsedMin")
    assert got == [("a", 20), ("b", 60), ("c", 60)]


def test_hot_keeps_old_posts_and_wraps_the_minute_of_day(spark, rows):
    frame = listing(spark, [item("old", 25 * 3600, 0, view="hot")])
    assert rows(intake.normalize_listing(frame, "hot"), "postId", "timeElapsedMin") == [("old", 60)]
    aged = intake.with_age(frame, F.col("fetched_at"), F.col("created_utc"))
    assert rows(aged, "timeElapsedMin", "ageDays") == [(60, 1)]


def test_post_from_the_future_has_negative_days(spark, rows):
    frame = listing(spark, [item("x", -30, 0)])
    aged = intake.with_age(frame, F.date_trunc("second", "fetched_at"), F.col("created_utc"))
    assert rows(aged, "timeElapsedMin", "ageDays") == [(1439, -1)]


def test_stickies_use_up_only_the_slack(spark, rows):
    pinned = [item(f"s{i}", 60, i, stickied=True) for i in range(2)]
    frame = listing(spark, pinned + [item(f"p{i}", 60, 2 + i) for i in range(4)])
    assert rows(intake.normalize_listing(frame, "rising", 3), "postId") == [("p0",), ("p1",), ("p2",)]
    # A third pinned item falls outside the slack and costs a place.
    frame = listing(spark, [item("s9", 60, -1, stickied=True)] + pinned + [item(f"p{i}", 60, 2 + i) for i in range(4)])
    assert rows(intake.normalize_listing(frame, "rising", 3), "postId") == [("p0",), ("p1",)]


def test_each_fetch_of_each_feed_has_its_own_top(spark):
    later = NOW + dt.timedelta(minutes=1)
    items = [
        item(f"{sub}{i}", 60, i, fetched=at, subreddit=sub) for sub in ("pics", "news") for at in (NOW, later) for i in range(5)
    ]
    got = intake.normalize_listing(listing(spark, items), "rising", 2)
    assert {tuple(r) for r in got.groupBy("subreddit", "loadTSUTC").count().select("count").collect()} == {(2,)}
    assert got.count() == 8


def test_normalized_columns_and_values(spark):
    frame = listing(spark, [item("g", 60, 0, gildings={"gold": 2, "silver": 3})])
    out = intake.normalize_listing(frame, "rising")
    assert out.columns == SNAPSHOT.names
    row = out.first()
    assert row.numGildings == 5
    assert row.loadTSUTC == NOW.replace(microsecond=0)
    assert row.loadTimeUTC == "12:00:00"
    assert row.createdTSUTC == NOW.replace(microsecond=0) - dt.timedelta(minutes=1)


def test_empty_map_sums_to_zero(spark):
    assert intake.normalize_listing(listing(spark, [item("g", 60, 0)]), "rising").first().numGildings == 0


def test_dedupe_keeps_the_later_load(spark, rows):
    day = dt.datetime(2023, 5, 4)
    frame = spark.createDataFrame(
        [("a", day.replace(hour=5, minute=3, second=44), 1), ("a", day.replace(hour=5, minute=6, second=44), 2)],
        "postId string, loadTSUTC timestamp, n int",
    )
    assert rows(intake.dedupe_latest(frame, ["postId"], "loadTSUTC"), "n") == [(2,)]


def test_dedupe_ties_fall_to_the_tiebreak(spark, rows):
    frame = spark.createDataFrame([("a", 1, 7), ("a", 1, 9), ("a", 1, 8), ("b", 1, 1)], "k string, t int, n int")
    assert rows(intake.dedupe_latest(frame, ["k"], "t", ["n"])) == [("a", 1, 9), ("b", 1, 1)]


def test_of_repeats_in_a_feed_the_last_listed_stays(spark, rows):
    twice = [item("a", 60, 0), item("a", 120, 5), item("b", 60, 1)]
    got = rows(feed_snapshots(listing(spark, twice), "rising"), "postId", "timeElapsedMin")
    assert got == [("a", 2), ("b", 1)]


def test_dedupe_limits_before_the_shuffle(spark, plan):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(intake.dedupe_latest(frame, ["k"], "t"))
    assert text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def landed(**changes):
    base = dict(
        loadDateUTC="2023-05-04", loadTimeUTC="02:20:21", loadTSUTC="2023-05-04 02:20:21", postId="a", subreddit="pics",
        subscribers="10000000", activeUsers="10000", title="T", createdTSUTC="2023-05-04 02:05:17", timeElapsedMin="15",
        score="3", numComments="1", upvoteRatio="0.97", numGildings="0",
    )
    return tuple({**base, **changes}[c] for c in LANDED.names)


def test_typed_and_rejected_snapshots(spark, rows):
    frame = spark.createDataFrame(
        [landed(), landed(postId="b", score="many"), landed(postId="c", loadTSUTC="yesterday"), landed(postId="d", score=None)],
        LANDED,
    )
    odd = [landed(postId="e", createdTSUTC="2023-05-04"), landed(postId="f", loadTimeUTC="25:00:00")]
    odd.append(landed(postId="g", loadTSUTC="2023-5-4 2:20:21", loadTimeUTC="2:20:21"))
    got = rows(intake.typed_snapshots(spark.createDataFrame(odd, LANDED)), "postId", "loadTSUTC", "loadTimeUTC")
    assert got == [("g", dt.datetime(2023, 5, 4, 2, 20, 21), "02:20:21")]
    good = intake.typed_snapshots(frame)
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in SNAPSHOT]
    assert rows(good, "postId", "score") == [("a", 3), ("d", None)]
    assert rows(intake.rejected_snapshots(frame), "postId", "badColumns") == [("b", "score"), ("c", "loadTSUTC")]


def test_stale_is_strictly_over_an_hour(spark, rows):
    created = dt.datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [(s, created, created + dt.timedelta(seconds=s)) for s in (3599, 3600, 3601)],
        "s int, createdTSUTC timestamp, loadTSUTC timestamp",
    )
    assert rows(intake.stale_rows(frame), "s") == [(3601,)]


def test_collect_writes_and_reads_back(spark, tmp_path):
    raw = tmp_path / "raw"
    frame = listing(spark, [item("a", 60, 0), item("a", 60, 1), item("b", 60, 2), item("h", 60, 0, view="hot")])
    frame.write.json(str(raw))
    paths = {view: str(tmp_path / view) for view in ("rising", "hot")}
    collect(read_listing(spark, str(raw)), paths)
    rising = read_snapshots(spark, paths["rising"])
    assert rising.count() == 2
    assert read_snapshots(spark, paths["hot"]).count() == 1
    append_snapshots(rising, paths["rising"])
    assert read_snapshots(spark, paths["rising"]).count() == 4
    assert read_snapshots(spark, paths["rising"], latest_only=True).count() == 2


def test_snapshot_reads_prune_days_and_columns(spark, tmp_path, plan):
    path = str(tmp_path / "rising")
    base = feed_snapshots(listing(spark, [item("a", 60, 0)]), "rising")
    append_snapshots(base, path)
    append_snapshots(base.withColumn("loadDateUTC", F.date_add("loadDateUTC", 1)), path)
    text = plan(read_snapshots(spark, path).where("loadDateUTC = DATE '2024-03-01'").select("postId"))
    assert "PartitionFilters: [isnotnull(loadDateUTC" in text
    assert "ReadSchema: struct<postId:string>" in text


def test_replace_days_leaves_other_days_alone(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    day = lambda n: dt.date(2024, 1, n)
    make = lambda data: spark.createDataFrame(data, "id int, day date")
    replace_days(make([(1, day(1)), (2, day(2))]), path, "day")
    replace_days(make([(3, day(2))]), path, "day")
    assert rows(spark.read.parquet(path), "id") == [(1,), (3,)]


def test_snapshot_written_again_replaces_the_first(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    base = feed_snapshots(listing(spark, [item("a", 60, 0), item("b", 60, 1)]), "rising")
    append_snapshots(base, path)
    time.sleep(1.1)  # file times have a resolution
    append_snapshots(base.where("postId = 'a'").withColumn("score", F.lit(3)), path)
    assert rows(read_snapshots(spark, path, latest_only=True), "postId", "score") == [("a", 3), ("b", 10)]


def test_rewrite_without_stale_rows(spark, tmp_path, rows):
    hot = intake.normalize_listing(listing(spark, [item("old", 7200, 0, "hot"), item("new", 60, 1, "hot")]), "hot")
    rewrite_without(hot, intake.stale_rows(hot), str(tmp_path / "t"))
    assert rows(read_snapshots(spark, str(tmp_path / "t")), "postId") == [("new",)]


def test_csv_with_its_own_column_order(spark, tmp_path):
    names = ["postId", "score"] + [c for c in LANDED.names if c not in ("postId", "score")]
    values = dict(zip(LANDED.names, landed()))
    path = tmp_path / "s.csv"
    lines = [",".join(f'"{c}"' for c in names), ",".join(f'"{values[c]}"' for c in names)]
    path.write_text("\n".join(lines))
    row = intake.typed_snapshots(read_landed_csv(spark, str(path), names)).first()
    assert (row.postId, row.score, row.timeElapsedMin) == ("a", 3, 15)
    assert row.upvoteRatio == pytest.approx(0.97, abs=1e-6)
    assert isinstance(row, Row)
