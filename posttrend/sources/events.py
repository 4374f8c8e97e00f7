"""An event log read as snapshots, feed items and scores.

One event is one observation: the event type is the feed, and type and hour make
up the post.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.operators.features import post_features
from posttrend.operators.intake import top_n_per_feed
from posttrend.operators.labels import label_members
from posttrend.operators.scoring import mark_step_up

HOT_PER_DAY = 3


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoned(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def zoned(events: DataFrame) -> DataFrame:
    """The log's zone-less times are UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def event_snapshots(events: DataFrame) -> DataFrame:
    """Snapshots with the event id kept as a tie-breaker."""
    return events.selectExpr(
        "event_id",
        "to_date(ts) AS loadDateUTC",
        "date_format(ts, 'HH:mm:ss') AS loadTimeUTC",
        "date_trunc('second', ts) AS loadTSUTC",
        "concat_ws('-', event_type, date_format(ts, 'yyyyMMddHH')) AS postId",
        "event_type AS subreddit",
        "cast(user_id * 1000 AS int) AS subscribers",
        "cast(user_id AS int) AS activeUsers",
        "concat('post ', event_type) AS title",
        "date_trunc('hour', ts) AS createdTSUTC",
        "minute(ts) AS timeElapsedMin",
        "cast(floor(value * 10) AS int) AS score",
        "cast(get_json_object(props, '$.k') AS int) AS numComments",
        "(user_id % 100) / 100.0D AS upvoteRatio",
        "cast(event_id % 3 AS int) AS numGildings",
    )


def hot_snapshots(snapshots: DataFrame) -> DataFrame:
    """The best snapshots of each feed and day stand in for the hot feed."""
    order = F.struct((-F.col("score")).alias("s"), F.col("postId"), F.col("event_id"))
    ranked = snapshots.withColumn("_rank", order).withColumn("_day", F.to_date("createdTSUTC"))
    return top_n_per_feed(ranked, ["subreddit", "_day"], "_rank", HOT_PER_DAY).drop("_rank", "_day")


def event_listing(events: DataFrame) -> DataFrame:
    """Raw feed items, fetched hourly, some pinned, some old."""
    created = "unix_timestamp(date_trunc('minute', ts)) - (user_id % 4) * 600 - if(event_id % 17 = 0, 86400, 0)"
    return events.selectExpr(
        "event_type AS subreddit",
        "if(event_id % 3 = 0, 'hot', 'rising') AS view",
        "event_id AS rank",
        "event_id % 11 = 0 AS stickied",
        f"cast({created} AS double) AS created_utc",
        "concat_ws('-', event_type, cast(event_id AS string)) AS id",
        "concat('post ', event_type) AS title",
        "cast(floor(value * 10) AS int) AS score",
        "cast(get_json_object(props, '$.k') AS int) AS num_comments",
        "(user_id % 100) / 100.0D AS upvote_ratio",
        "map('silver', cast(event_id % 3 AS int), 'gold', cast(user_id % 2 AS int)) AS gildings",
        "cast(user_id * 1000 AS int) AS subscribers",
        "cast(user_id AS int) AS accounts_active",
        "date_trunc('hour', ts) + interval 1 hour AS fetched_at",
    )


def labelled_posts(snapshots: DataFrame) -> DataFrame:
    """Training rows: features and whether the post is among the hot ones."""
    return label_members(post_features(snapshots), hot_snapshots(snapshots))


def proxy_scored(posts: DataFrame, threshold: float = 0.6, model: str = "proxy") -> DataFrame:
    """A deterministic stand-in for a model: late score s as s / (s + 500)."""
    late = F.coalesce(F.col("maxScore41_60m"), F.lit(0)).cast("double")
    scored = posts.withColumn("modelName", F.lit(model)).withColumn("predict_proba_1", late / (late + 500.0))
    return mark_step_up(scored, threshold)
