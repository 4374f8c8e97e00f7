"""Snapshots to one feature row per post, and the columns derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posttrend.functions import growth, hash_fraction, local_hour, local_weekday, max_between
from posttrend.schema import GROWTH_METRICS, METRICS, POST_KEY, bucket_labels, feature_name, growth_name

EASTERN = "US/Eastern"
QUARTERS = ((0, 6, "time0006"), (6, 12, "time0612"), (12, 18, "time1218"), (18, 24, "time1800"))


def post_features(
    snapshots: DataFrame, metrics: tuple[str, ...] = tuple(METRICS), edges: tuple[int, ...] = (20, 40, 60),
    also: tuple[Column, ...] = (),
) -> DataFrame:
    """Largest value of each metric per age bucket, plus growth between the last two buckets.

    ``also``: named aggregates to carry along.

    One pass of conditional maxima.  Every map task reduces a post to one row
    before the shuffle, so a post with very many snapshots is no hot spot.  An
    edited title starts a row of its own because the title is part of the key.
    """
    labels = bucket_labels(edges)
    age = "timeElapsedMin"
    maxima = [
        max_between(age, metric, low, high, feature_name(metric, label))
        for metric in metrics
        for low, high, label in labels
    ]
    rows = snapshots.groupBy(*POST_KEY).agg(F.max(age).alias(age), *maxima, *also)
    if len(labels) < 2:
        return rows
    earlier, later = labels[-2][2], labels[-1][2]
    ratios = [
        growth(feature_name(m, later), feature_name(m, earlier), growth_name(m, earlier, later))
        for m in GROWTH_METRICS
        if m in metrics
    ]
    return rows.select("*", *ratios)


def fill_features(features: DataFrame) -> DataFrame:
    """NULL to 0 in the numeric columns: the form the models are trained on and applied to."""
    return features.fillna(0)


def time_features(df: DataFrame, ts: str = "createdTSUTC", zone: str = EASTERN) -> DataFrame:
    """Local hour and weekday (Monday 0) of ``ts``, quarter-of-day flags and a Sunday flag."""
    dated = df.withColumn("hour", local_hour(F.col(ts), zone)).withColumn("dayofweek", local_weekday(F.col(ts), zone))
    flags = {
        name: ((F.col("hour") >= low) & (F.col("hour") < high)).cast("int") for low, high, name in QUARTERS
    }
    flags["sunday"] = (F.col("dayofweek") == 6).cast("int")
    return dated.withColumns(flags)


def random_control(df: DataFrame, key: str, rate: Column | float, seed: int = 0, out: str = "randomVar") -> DataFrame:
    """A 0/1 column that is 1 with probability ``rate`` and carries no signal.

    Drawn from a hash of the key, so that a recomputed partition repeats itself.
    """
    return df.withColumn(out, (hash_fraction(F.col(key), seed) < rate).cast("int"))
