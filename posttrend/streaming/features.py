"""Snapshots as a stream, and features that follow them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.operators.features import post_features
from posttrend.operators.intake import RISING_MAX_MINUTES
from posttrend.schema import LISTING, SNAPSHOT, SNAPSHOT_KEY

DELAY = "90 minutes"
TRIGGER = "10 minutes"


def stream_snapshots(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New snapshot files as they arrive in ``path``."""
    reader = spark.readStream.schema(SNAPSHOT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_listing(spark: SparkSession, path: str) -> DataFrame:
    """Raw feed items as they land as JSON lines."""
    return spark.readStream.schema(LISTING).json(path)


def drop_repeats(snapshots: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row per (post, load time) within the watermark; which of the repeats stays is not defined."""
    return snapshots.withWatermark("loadTSUTC", delay).dropDuplicatesWithinWatermark(SNAPSHOT_KEY)


def latest_rows(snapshots: DataFrame, order: list[str], key: str = "postId", delay: str = DELAY) -> DataFrame:
    """The newest row of each post over a stream: the one with the largest ``order``.

    One row per post is kept in state, until ``delay`` has passed since the post was created.  In update mode a post is
    emitted whenever rows of it come, in append mode once, when no more are expected.
    """
    kept = snapshots.withWatermark("createdTSUTC", delay)
    newest = F.max_by(F.struct(*[c for c in snapshots.columns if c not in (key, "createdTSUTC")]), F.struct(*order))
    return kept.groupBy(key, "createdTSUTC").agg(newest.alias("_row")).select(key, "createdTSUTC", "_row.*")


def drop_aged(snapshots: DataFrame) -> DataFrame:
    """Keep rows of the first hour, counted by true age rather than minute of day."""
    age = F.unix_timestamp("loadTSUTC") - F.unix_timestamp("createdTSUTC")
    return snapshots.where(age < (RISING_MAX_MINUTES + 1) * 60)


def stream_features(snapshots: DataFrame, delay: str = DELAY) -> DataFrame:
    """The feature aggregate over a stream.

    The creation time is part of the key and carries the watermark, so state of a
    post is let go once ``delay`` has passed since it was created.  In update mode
    each run emits the posts that changed; in append mode a post is emitted once,
    when it is final.
    """
    return post_features(snapshots.withWatermark("createdTSUTC", delay))
