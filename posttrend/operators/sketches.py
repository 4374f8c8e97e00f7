"""Quantiles of long windows from small sketches kept per day.

A day's scores become one mergeable sketch (KLL) when the day is over; thresholds over any run of days come from
merging the days' sketches, without reading a score again.  ``rank_error`` states how far the rank of such a quantile
may be off; the exact path is ``evaluate.quantiles``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.sources.tables import replace_days

# Larger keeps more: about 60 KB a day, and a rank error of 0.13 %.
SIZE = 4096
LAYOUT = "n bigint, sketch binary, day date"


def rank_error(size: int = SIZE) -> float:
    """Bound on the error of a normalised rank, kept with 99 % probability, as published for this sketch."""
    return 2.296 / size**0.9021


def day_sketches(df: DataFrame, col: str, day: str, size: int = SIZE) -> DataFrame:
    """One sketch per day, begun in the map tasks; NULL scores are left out."""
    rows = df.where(F.col(col).isNotNull()).select(F.col(day).alias("day"), F.col(col).cast("double").alias("_v"))
    return rows.groupBy("day").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_v", F.lit(size)).alias("sketch"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Keep the days' sketches; a day sketched again is replaced."""
    replace_days(sketches.select("n", "sketch", "day"), path, "day")


def read_sketches(spark: SparkSession, path: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Stored sketches of a run of days; other days are not listed."""
    try:
        rows = spark.read.schema(LAYOUT).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no sketches in {path}") from error
    if since is not None:
        rows = rows.where(F.col("day") >= F.lit(since))
    return rows if until is None else rows.where(F.col("day") <= F.lit(until))


def sketched_quantiles(sketches: DataFrame, qs: list[float], by: list[str] | None = None) -> DataFrame:
    """One row per (group,) quantile: ``q``, ``value`` and the number of scores ``n`` behind it."""
    by = list(by or [])
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_all")).where("n > 0")
    rows = [F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("_all", F.lit(float(q))).alias("value")) for q in qs]
    return merged.select(*by, "n", F.inline(F.array(*rows)))


def with_rank_check(found: DataFrame, df: DataFrame, col: str, error: float | None = None) -> DataFrame:
    """``within``: whether the rank of each found value is as close to ``q`` as stated, by one pass over the scores."""
    error = rank_error() if error is None else error
    values = found.select("q", "value").collect()  # one per quantile asked for
    scores = df.where(F.col(col).isNotNull())
    counts = [F.count("*").alias("_n")]
    for i, r in enumerate(values):
        counts += [F.count_if(F.col(col) < r["value"]).alias(f"_below{i}"), F.count_if(F.col(col) <= r["value"]).alias(f"_upto{i}")]
    told = scores.agg(*counts).first()
    within = F.lit(False)
    for i, r in enumerate(values):
        low, high = told[f"_below{i}"] / told["_n"], told[f"_upto{i}"] / told["_n"]
        within = F.when(F.col("q") == r["q"], F.lit(low - error <= r["q"] <= high + error)).otherwise(within)
    return found.withColumn("within", within)
