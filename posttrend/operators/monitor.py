"""How past alerts fared: labels from the hot feed, precision and recall per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posttrend.operators.merge import melt

FLAG_COLUMNS = ["stepUp", "hotPost", "hotPost10k", "stepUpHotPost", "stepUpHotPost10k"]


def hot_max_score(hot: DataFrame, seen: Column | None = None) -> DataFrame:
    """Best score a post reached in the hot feed; with ``seen``, of the posts for which that holds of any row."""
    also = [] if seen is None else [F.bool_or(seen).alias("_seen")]
    best = hot.groupBy("postId", "subreddit").agg(F.max("score").alias("hotPostMaxScore"), *also)
    if seen is not None:
        best = best.withColumn("_seen", F.max("_seen").over(Window.partitionBy("postId"))).where("_seen").drop("_seen")
    return best.withColumnRenamed("subreddit", "hotPostSubreddit")


def monitor_labels(scored: DataFrame, hot_max: DataFrame, cutoff: int = 10000) -> DataFrame:
    """Scored posts and hot posts side by side with true labels and hit flags.

    ``hotPost10k`` asks for a hot score of at least ``cutoff``.  A hot post that
    was never scored counts as not stepped up.
    """
    both = scored.select("postId", "subreddit", "stepUp").join(hot_max, "postId", "full")
    best = F.col("hotPostMaxScore")
    flagged = both.select(
        F.col("postId"),
        F.coalesce("subreddit", "hotPostSubreddit").alias("coalesceSubreddit"),
        best,
        F.coalesce(F.col("stepUp"), F.lit(0)).cast("int").alias("stepUp"),
        best.isNotNull().cast("int").alias("hotPost"),
        F.coalesce(best >= cutoff, F.lit(False)).cast("int").alias("hotPost10k"),
    )
    return flagged.select(
        "*",
        F.col("stepUp").bitwiseAND(F.col("hotPost")).alias("stepUpHotPost"),
        F.col("stepUp").bitwiseAND(F.col("hotPost10k")).alias("stepUpHotPost10k"),
    )


def label_counts(labels: DataFrame, group: str = "coalesceSubreddit") -> DataFrame:
    return labels.groupBy(group).agg(F.count("stepUp").alias("count"))


def precision_recall_by(labels: DataFrame, group: str = "coalesceSubreddit") -> DataFrame:
    """Flag sums per group with precision and recall for both label variants; NULL for 0/0."""
    sums = labels.groupBy(group).agg(*[F.sum(c).alias(c) for c in FLAG_COLUMNS])
    rates = []
    for label in ("hotPost", "hotPost10k"):
        hits = F.col("stepUp" + label[0].upper() + label[1:])
        rates.append(F.try_divide(hits, F.col(label)).alias(f"recall_{label}"))
        rates.append(F.try_divide(hits, F.col("stepUp")).alias(f"precision_{label}"))
    return sums.select("*", *rates)


def ranked_metrics(metrics: DataFrame, group: str = "coalesceSubreddit") -> DataFrame:
    """Best recall first, groups without one last; equal ones by name."""
    return metrics.orderBy(F.col("recall_hotPost10k").desc_nulls_last(), group)


def metrics_long(metrics: DataFrame, label: str, group: str = "coalesceSubreddit") -> DataFrame:
    """Recall and precision of one label variant, one row per group and measure."""
    return melt(metrics, [group], [f"recall_{label}", f"precision_{label}"])
