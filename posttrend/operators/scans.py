"""Reads over the snapshot tables, all of them prunable by load date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posttrend.functions import utc, utc_date
from posttrend.session import fresh_path

# Ids that are sent to every task: a few megabytes.
FEW_IDS = 100_000


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One ``yyyy-MM-dd`` row per day of each [start, end] pair, both ends included.

    A start after the end still yields the start day, as a span of one.
    """
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    days = F.sequence(first, F.greatest(first, last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("_day")).select(F.date_format("_day", "yyyy-MM-dd").alias("date"))


def days_until(start: dt.date, today: dt.date | None = None) -> list[str]:
    """The same span as Python strings, for use in a partition filter."""
    today = today or dt.datetime.now(dt.timezone.utc).date()
    span = max((today - start).days, 0)
    return [(start + dt.timedelta(days=i)).isoformat() for i in range(span + 1)]


def ids_on_dates(snapshots: DataFrame, dates: str | list[str], columns: tuple[str, ...] = ("postId",)) -> DataFrame:
    """Ids loaded on the given day(s), as a bag: one row per snapshot, duplicates kept."""
    days = [dates] if isinstance(dates, str) else list(dates)
    wanted = F.col("loadDateUTC").isin([dt.date.fromisoformat(d) for d in days])
    return snapshots.where(wanted).select(*columns)


def distinct_ids(rows: DataFrame, key: str = "postId") -> DataFrame:
    return rows.select(key).distinct()


def recent_ids(
    snapshots: DataFrame,
    as_of: dt.datetime,
    lookback: dt.timedelta = dt.timedelta(minutes=15),
    same_day_only: bool = False,
    extra: Column | None = None,
) -> DataFrame:
    """Ids with a snapshot in [as_of - lookback, as_of].

    The load dates are named as well as the times, so that only the one or two
    partitions concerned are listed.  ``same_day_only`` limits the window to the
    day it starts on, which loses the rows after midnight.
    """
    start = as_of - lookback
    last = start if same_day_only else as_of
    window = F.col("loadTSUTC").between(utc(start), utc(as_of))
    window = window & F.col("loadDateUTC").between(F.lit(utc_date(start)), F.lit(utc_date(last)))
    if extra is not None:
        window = window & extra
    return distinct_ids(snapshots.where(window))


def stored_ids(ids: DataFrame, key: str = "postId") -> DataFrame:
    """The distinct ids as a table of their own, so that their number is known before anything is joined to them."""
    spark, path = ids.sparkSession, fresh_path(ids.sparkSession, "ids")
    distinct_ids(ids, key).write.parquet(path)
    return spark.read.schema(f"`{key}` {ids.schema[key].dataType.simpleString()}").parquet(path)


def are_few(ids: DataFrame, most: int = FEW_IDS) -> bool:
    """Whether stored ids may be sent to every task; their count is in the files' footers."""
    return ids.count() <= most


def history_for(snapshots: DataFrame, ids: DataFrame, key: str = "postId", most: int = FEW_IDS) -> DataFrame:
    """Every snapshot of the wanted posts.

    Up to ``most`` ids go to the snapshots, which are filtered where they are read and not shuffled; more than that
    are a join, in which adaptive execution splits a hot post over several tasks.
    """
    wanted = stored_ids(ids, key)
    return snapshots.join(F.broadcast(wanted) if are_few(wanted, most) else wanted, key, "left_semi")


def scored_between(scored: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Scored posts created in [start, end]."""
    return scored.where(F.col("createdTSUTC").between(utc(start), utc(end)))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
