import datetime as dt

import pytest
from pyspark.sql import functions as F

from posttrend.operators import features, scans
from posttrend.operators.labels import label_members
from posttrend.plans.live import live_features
from posttrend.plans.training import build_training, training_table
from posttrend.schema import FEATURES, SNAPSHOT, TRAINING, feature_columns
from posttrend.sources.tables import read_training

CREATED = dt.datetime(2023, 5, 4, 2, 5, 17)


def snap(post, age, score=0, comments=0, ratio=0.5, gild=0, created=CREATED, title="T", subreddit="pics"):
    load = created + dt.timedelta(minutes=age or 0)
    return (
        load.date(), load.strftime("%H:%M:%S"), load, post, subreddit, 10, 1, title, created, age, score, comments,
        ratio, gild,
    )


def frame(spark, data):
    return spark.createDataFrame(data, SNAPSHOT)


# Three posts at ages 15, 35 and 55: scores, comments and upvote ratios.
THREE = {
    "p1": ([0, 0, 21], [0, 0, 1], [0.0, 0.0, 0.97]),
    "p2": ([10, 29, 67], [1, 6, 9], [0.95, 0.95, 0.94]),
    "p3": ([10, 29, 150], [1, 6, 20], [0.95, 0.95, 0.94]),
}


def three(spark):
    return frame(
        spark,
        [snap(p, age, s[i], c[i], r[i]) for p, (s, c, r) in THREE.items() for i, age in enumerate((15, 35, 55))],
    )


def test_worked_feature_rows(spark):
    got = {r.postId: r for r in features.post_features(three(spark)).collect()}
    assert got["p1"].maxScoreGrowth21_40m41_60m is None and got["p1"].maxNumCommentsGrowth21_40m41_60m is None
    assert got["p2"].maxScoreGrowth21_40m41_60m == pytest.approx(38 / 29)
    assert got["p2"].maxNumCommentsGrowth21_40m41_60m == 0.5
    assert got["p3"].maxScoreGrowth21_40m41_60m == pytest.approx(121 / 29)
    assert got["p3"].maxNumCommentsGrowth21_40m41_60m == pytest.approx(14 / 6)
    assert all(r.timeElapsedMin == 55 for r in got.values())
    assert (got["p2"].maxScore20m, got["p2"].maxScore21_40m, got["p2"].maxScore41_60m) == (10, 29, 67)


def test_bucket_edges(spark):
    ages = {20: 1, 21: 2, 40: 3, 41: 4, 60: 5, 61: 6}
    row = features.post_features(frame(spark, [snap("p", a, s) for a, s in ages.items()])).first()
    assert (row.maxScore20m, row.maxScore21_40m, row.maxScore41_60m, row.timeElapsedMin) == (1, 3, 5, 61)


def test_empty_bucket_is_null_and_fills_to_zero(spark):
    rows = features.post_features(frame(spark, [snap("p", 5, 3)]))
    assert rows.first().maxScore41_60m is None
    filled = features.fill_features(rows).first()
    assert filled.maxScore41_60m == 0 and filled.maxScoreGrowth21_40m41_60m == 0.0


def test_retitled_post_gives_two_rows(spark):
    rows = features.post_features(frame(spark, [snap("p", 5), snap("p", 10, title="new")]))
    assert rows.count() == 2


def test_feature_schema_and_empty_input(spark):
    rows = features.post_features(frame(spark, []))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in FEATURES]
    assert rows.count() == 0


def test_other_edges_and_metrics(spark):
    rows = features.post_features(frame(spark, [snap("p", 7, 4), snap("p", 25, 8)]), ("score",), (10, 30))
    row = rows.first()
    assert (row.maxScore10m, row.maxScore11_30m, row.maxScoreGrowth10m11_30m) == (4, 8, 1.0)


def test_feature_columns_count():
    assert len(feature_columns()) == 14


def test_aggregate_combines_before_the_shuffle(spark, plan):
    text = plan(features.post_features(three(spark)))
    assert text.count("HashAggregate") >= 2 and "partial_max" in text and "SortAggregate" not in text


def test_hot_post_reaches_the_shuffle_as_few_rows(spark):
    """A post holding most snapshots is reduced in the map tasks."""
    many = spark.range(20000).select(
        F.lit(CREATED.date()).alias("loadDateUTC"), F.lit("x").alias("loadTimeUTC"), F.lit(CREATED).alias("loadTSUTC"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id"))).alias("postId"),
        F.lit("pics").alias("subreddit"), F.lit(1).alias("subscribers"), F.lit(1).alias("activeUsers"),
        F.lit("t").alias("title"), F.lit(CREATED).alias("createdTSUTC"), (F.col("id") % 60).cast("int").alias("timeElapsedMin"),
        F.col("id").cast("int").alias("score"), F.lit(1).alias("numComments"), F.lit(0.5).cast("float").alias("upvoteRatio"),
        F.lit(0).alias("numGildings"),
    )
    out = features.post_features(many)
    assert out.where("postId = 'hot'").first().maxScore41_60m == 19977
    assert out.count() == 20000 - 6667 + 1


def test_labels(spark, rows):
    posts = spark.createDataFrame([("123456",), ("212341",)], "postId string")
    hot = spark.createDataFrame([("123456",), ("123457",), ("123456",)], "postId string")
    assert rows(label_members(posts, hot)) == [("123456", 1), ("212341", 0)]


def test_label_plan_has_no_python_and_no_sort(spark, plan):
    posts = spark.range(100).select(F.col("id").cast("string").alias("postId"))
    text = plan(label_members(posts, posts.limit(5)))
    assert "Python" not in text and "BroadcastHashJoin" in text


def test_date_spine(spark, rows):
    bounds = spark.createDataFrame([(dt.date(2024, 2, 28), dt.date(2024, 3, 1))], "start date, end date")
    assert rows(scans.date_spine(bounds)) == [("2024-02-28",), ("2024-02-29",), ("2024-03-01",)]
    turned = spark.createDataFrame([(dt.date(2024, 3, 1), dt.date(2024, 2, 1))], "start date, end date")
    assert rows(scans.date_spine(turned)) == [("2024-03-01",)]
    assert scans.days_until(dt.date(2024, 2, 28), dt.date(2024, 3, 1)) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    assert len(scans.days_until(dt.date.today() - dt.timedelta(days=3))) >= 3


def test_ids_keep_duplicates(spark, rows):
    data = frame(spark, [snap("a", 1), snap("a", 2), snap("b", 3, created=CREATED + dt.timedelta(days=1))])
    assert rows(scans.ids_on_dates(data, "2023-05-04")) == [("a",), ("a",)]
    assert rows(scans.ids_on_dates(data, ["2023-05-04", "2023-05-05"])) == [("a",), ("a",), ("b",)]


def test_recent_ids_across_midnight(spark, rows):
    before, after = dt.datetime(2024, 1, 1, 23, 55), dt.datetime(2024, 1, 2, 0, 3)
    data = frame(
        spark,
        [
            snap("late", 5, created=before - dt.timedelta(minutes=5)),
            snap("early", 3, created=after - dt.timedelta(minutes=3)),
            snap("past", 1, created=before - dt.timedelta(hours=1)),
        ],
    )
    as_of = dt.datetime(2024, 1, 2, 0, 5)
    assert rows(scans.recent_ids(data, as_of)) == [("early",), ("late",)]
    assert rows(scans.recent_ids(data, as_of, same_day_only=True)) == [("late",)]
    assert rows(scans.recent_ids(data, as_of, extra=F.col("timeElapsedMin") == 3)) == [("early",)]


def test_history_of_wanted_posts(spark):
    data = three(spark)
    assert scans.history_for(data, data.select("postId")).count() == 9
    ids = spark.createDataFrame([("p2",), ("p2",), ("zz",)], "postId string")
    assert scans.history_for(data, ids).count() == 3
    assert scans.preview(data).count() == 5


def test_live_features_cover_the_whole_history(spark):
    data = three(spark)
    rows = live_features(data, CREATED + dt.timedelta(minutes=60))
    assert rows.count() == 3
    assert rows.where("maxScore20m IS NOT NULL").count() == 3
    assert live_features(data, CREATED + dt.timedelta(minutes=80)).count() == 0


def test_training_range_keeps_history_from_the_day_before(spark, tmp_path):
    made = dt.datetime(2024, 1, 1, 23, 50)
    data = frame(spark, [snap("p", 5, 7, created=made), snap("p", 30, 9, created=made), snap("q", 5, created=made)])
    day = dt.date(2024, 1, 2)
    rows = training_table(data, data.where("postId = 'p'"), day, day).collect()
    assert [(r.postId, r.maxScore20m, r.maxScore21_40m, r.target) for r in rows] == [("p", 7, 9, 1)]
    path = str(tmp_path / "train")
    build_training(data, data.where("postId = 'p'"), path)
    stored = read_training(spark, path)
    assert {(r.postId, r.target) for r in stored.collect()} == {("p", 1), ("q", 0)}
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in TRAINING]


@pytest.mark.parametrize(
    "utc, hour, weekday",
    [
        (dt.datetime(2024, 3, 10, 6, 59), 1, 6),  # last standard hour
        (dt.datetime(2024, 3, 10, 7, 0), 3, 6),  # clocks go forward
        (dt.datetime(2024, 11, 3, 5, 30), 1, 6),
        (dt.datetime(2024, 11, 3, 6, 30), 1, 6),  # the repeated hour
        (dt.datetime(2024, 1, 1, 4, 59), 23, 6),  # still Sunday in the east
        (dt.datetime(2024, 1, 1, 5, 0), 0, 0),
    ],
)
def test_time_features(spark, utc, hour, weekday):
    row = features.time_features(spark.createDataFrame([(utc,)], "createdTSUTC timestamp")).first()
    assert (row.hour, row.dayofweek, row.sunday) == (hour, weekday, int(weekday == 6))
    assert row.time0006 + row.time0612 + row.time1218 + row.time1800 == 1
    assert row[["time0006", "time0612", "time1218", "time1800"][hour // 6]] == 1


def test_random_control_has_the_wanted_rate(spark):
    posts = spark.range(20000).select(F.col("id").cast("string").alias("postId"))
    draw = lambda seed: features.random_control(posts, "postId", 0.2, seed)
    assert draw(0).agg(F.avg("randomVar")).first()[0] == pytest.approx(0.2, abs=0.015)
    assert draw(0).exceptAll(draw(0)).count() == 0
    assert draw(0).exceptAll(draw(1)).count() > 0


def test_look_back_of_days_keeps_every_post(spark):
    days = [CREATED - dt.timedelta(days=d) for d in range(5)]
    rows = [snap(f"p{i}", 10, 5, created=c) for i, c in enumerate(days)]
    data = frame(spark, rows)
    as_of = CREATED + dt.timedelta(minutes=60)
    assert live_features(data, as_of, dt.timedelta(days=4, hours=2)).count() == 5
    aware = as_of.replace(tzinfo=dt.timezone.utc).astimezone(dt.timezone(dt.timedelta(hours=-5)))
    assert live_features(data, aware, dt.timedelta(days=4, hours=2)).count() == 5


def test_history_of_few_posts_shuffles_no_other(spark, tmp_path, plan):
    rows = [snap(f"p{i % 50}", i % 60, i) for i in range(500)]
    spark.createDataFrame(rows, SNAPSHOT).write.parquet(str(tmp_path / "t"))
    data = spark.read.schema(SNAPSHOT).parquet(str(tmp_path / "t"))
    ids = spark.createDataFrame([("p1",), ("p2",), ("p1",)], "postId string")
    few, many = scans.history_for(data, ids), scans.history_for(data, ids, most=1)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 20
    assert "Exchange hashpartitioning" not in plan(few) and "BroadcastHashJoin" in plan(few)
    assert "BroadcastHashJoin" not in many._jdf.queryExecution().optimizedPlan().toString()

    # One exchange: that of the aggregate, which only gets the snapshots of the chosen posts.
    text = plan(live_features(data, CREATED + dt.timedelta(minutes=60), dt.timedelta(minutes=2)))
    assert text.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    assert text.index("HashAggregate") < text.index("BroadcastHashJoin")


def test_live_features_of_many_posts_are_the_same(spark, monkeypatch):
    from posttrend.plans import live

    data = spark.createDataFrame([snap(f"p{i % 7}", i % 60, i) for i in range(100)], SNAPSHOT)
    at = CREATED + dt.timedelta(minutes=30)
    few = live_features(data, at).collect()
    monkeypatch.setattr(live, "are_few", lambda ids: False)
    assert sorted(map(repr, live_features(data, at).collect())) == sorted(map(repr, few)) and few


def test_training_range_is_one_scan_and_keeps_edited_posts_whole(spark, tmp_path, plan):
    first, second = CREATED.date(), CREATED.date() + dt.timedelta(days=1)
    edited = list(snap("p", 3, 7))
    edited[0], edited[7] = second, "new title"
    rows = [snap("p", 5, 10), tuple(edited), snap("q", 5, 3)]
    spark.createDataFrame(rows, SNAPSHOT).write.parquet(str(tmp_path / "t"))
    data = spark.read.schema(SNAPSHOT).parquet(str(tmp_path / "t"))
    hot = spark.createDataFrame([], SNAPSHOT)
    got = training_table(data, hot, second, second)
    assert sorted((r.postId, r.title, r.maxScore20m) for r in got.collect()) == [("p", "T", 10), ("p", "new title", 7)]
    assert training_table(data, hot, first, second).count() == 3
    assert plan(got).split("== Initial Plan ==")[0].count("FileScan parquet") == 1
