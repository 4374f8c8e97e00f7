"""The training table: features of every rising post with its label."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posttrend.operators.features import post_features
from posttrend.operators.labels import label_members
from posttrend.sources.tables import write_training


def _inside(start: dt.date | None, end: dt.date | None) -> Column:
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("loadDateUTC") >= F.lit(start))
    if end is not None:
        inside = inside & (F.col("loadDateUTC") <= F.lit(end))
    return inside


def training_table(
    rising: DataFrame, hot: DataFrame, start: dt.date | None = None, end: dt.date | None = None,
    margin: dt.timedelta | None = None,
) -> DataFrame:
    """Features of the posts loaded from ``start`` to ``end``, target 1 where the post was hot in that time.

    One pass over the snapshots: whether a post was loaded in that time is carried along with its features, and posts
    that were not are dropped after the aggregate, which every map task begins.  The whole history of a chosen post
    counts; ``margin`` limits the scan to so many days around the range, for callers who know that no post has older
    snapshots.
    """
    if start is None and end is None:
        features = post_features(rising)
    else:
        around = rising if margin is None else rising.where(_inside(start and start - margin, end and end + margin))
        loaded = F.bool_or(_inside(start, end)).alias("_loaded")
        # A post whose title was edited has a row per title; it counts if any of them was loaded.
        any_row = F.max("_loaded").over(Window.partitionBy("postId"))
        features = post_features(around, also=(loaded,)).withColumn("_loaded", any_row).where("_loaded").drop("_loaded")
    return label_members(features, hot.where(_inside(start, end)))


def build_training(rising: DataFrame, hot: DataFrame, path: str, **days) -> None:
    write_training(training_table(rising, hot, **days), path)
