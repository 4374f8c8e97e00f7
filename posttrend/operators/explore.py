"""Univariate looks at the training table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posttrend.functions import to_double
from posttrend.operators.ranking import interpolated, quantile_ends, running_counts


def long_features(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """(by, feature, value) rows; the features become doubles first so they share a column."""
    return df.selectExpr(by, *to_double(*cols)).unpivot([by], cols, "feature", "value")


def describe_by(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of each column per group.

    All of it comes from the distinct values and their running counts.  The sum
    total rides along, so the deviation is taken from the mean as it should be.
    """
    keys = ["feature", by]
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ranked = running_counts(long_features(df, by, cols), "value", keys, {"s": F.col("value")}, slices=64)
    found = ranked.groupBy(*keys).agg(
        F.max("total_n").alias("total_n"),
        F.max("total_s").alias("total_s"),
        F.expr("sum(n * pow(value - total_s / total_n, 2)) AS squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        *[end for name, q in quartiles.items() for end in quantile_ends(q, name)],
    )
    described = found.selectExpr(
        *keys,
        "total_n AS count",
        "total_s / total_n AS mean",
        "sqrt(try_divide(squares, total_n - 1)) AS std",
        "min",
        *[f"{interpolated(q, name)} AS {name}" for name, q in quartiles.items()],
        "max",
    )
    # Columns without a value in a group have no ranks; they count 0.
    counts = df.groupBy(by).agg(*[F.count(c).alias(c) for c in cols]).unpivot([by], cols, "feature", "count")
    return described.unionByName(counts.where("count = 0"), allowMissingColumns=True)


def rate_by(df: DataFrame, group: Column, name: str, y: str = "target") -> DataFrame:
    """Share of positives per value of ``group``."""
    return df.groupBy(group.alias(name)).agg(F.avg(y).alias("rate"))


def hist(df: DataFrame, value: Column, width: float, name: str = "bin") -> DataFrame:
    """Row count per bin of ``width``; the bin is named by its lower edge."""
    edge = F.floor(value / F.lit(width)) * F.lit(width)
    return df.groupBy(edge.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def feature_hist_by(df: DataFrame, by: str, widths: dict[str, float]) -> DataFrame:
    """Binned distribution of each feature per group: bin number, count and share of the group."""
    long = long_features(df, by, list(widths))
    width = reduce(
        lambda acc, item: F.when(F.col("feature") == item[0], F.lit(float(item[1]))).otherwise(acc),
        widths.items(),
        F.lit(None).cast("double"),
    )
    binned = long.where(F.col("value").isNotNull()).groupBy("feature", by, F.floor(F.col("value") / width).alias("bin"))
    counts = binned.agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("feature", by).agg(F.sum("count").alias("_all"))
    return counts.join(totals, ["feature", by]).select(
        "feature", by, "bin", "count", (F.col("count") / F.col("_all")).alias("share")
    )


def base_rate(df: DataFrame, y: str = "target") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("posts"), F.sum(y).cast("long").alias("positives"), F.avg(y).alias("rate")
    )
