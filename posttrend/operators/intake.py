"""From landed feed items to clean snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posttrend.functions import age_days, age_minute_of_day, map_value_sum
from posttrend.schema import LANDED, SNAPSHOT, TIME_FILTERS, VIEWS

MAX_FEED = 25
STICKY_SLACK = 2
RISING_MAX_MINUTES = 60


def check_feed_request(top_n: int, view: str, time_filter: str | None = None) -> None:
    """Reject a feed request the collector does not support, before any plan is built."""
    if top_n > MAX_FEED:
        raise ValueError(f"top_n must be at most {MAX_FEED}, got {top_n}")
    if view not in VIEWS:
        raise ValueError(f"view must be one of {VIEWS}, got {view!r}")
    if view == "top" and time_filter not in TIME_FILTERS:
        raise ValueError(f"time_filter must be one of {TIME_FILTERS}, got {time_filter!r}")


def with_age(df: DataFrame, load: Column, created_epoch: Column) -> DataFrame:
    """Add ``timeElapsedMin`` (minute within the day of age) and ``ageDays``."""
    return df.withColumn("timeElapsedMin", age_minute_of_day(load, created_epoch)).withColumn(
        "ageDays", age_days(load, created_epoch)
    )


def with_load_columns(df: DataFrame, fetched_at: Column) -> DataFrame:
    """Add second-precision load timestamp, load date and load time of day."""
    load = F.date_trunc("second", fetched_at)
    return (
        df.withColumn("loadTSUTC", load)
        .withColumn("loadDateUTC", F.to_date(load))
        .withColumn("loadTimeUTC", F.date_format(load, "HH:mm:ss"))
    )


def fresh_enough(view: Column) -> Column:
    """Rising items count only while at most an hour old; other views keep every age."""
    young = (F.col("timeElapsedMin") <= RISING_MAX_MINUTES) & (F.col("ageDays") <= 0)
    return (view != "rising") | young


def top_n_per_feed(df: DataFrame, feed: list[str], rank: str, n: int) -> DataFrame:
    """First ``n`` rows of each feed by listing rank.

    The row_number filter becomes a group limit on both sides of the shuffle, so
    every map task forwards at most ``n`` rows per feed however large the feed is.
    """
    position = F.row_number().over(Window.partitionBy(*feed).orderBy(F.col(rank)))
    return df.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")


def normalize_listing(
    listing: DataFrame,
    view: str,
    top_n: int = MAX_FEED,
    time_filter: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Snapshots of one view: over-fetch, drop stickies and stale rising items, keep ``top_n``.

    The feed is read ``STICKY_SLACK`` items deeper than asked for because pinned
    items use up positions.  ``keep`` names listing columns to carry along.
    """
    check_feed_request(top_n, view, time_filter)
    feed = ["subreddit", "loadTSUTC"]
    fetched = with_load_columns(listing.where(F.col("view") == view), F.col("fetched_at"))
    window = top_n_per_feed(fetched, feed, "rank", top_n + STICKY_SLACK)
    aged = with_age(window.where(~F.coalesce(F.col("stickied"), F.lit(False))), F.col("loadTSUTC"), F.col("created_utc"))
    kept = top_n_per_feed(aged.where(fresh_enough(F.col("view"))), feed, "rank", top_n)
    return kept.select(
        F.col("loadDateUTC"),
        F.col("loadTimeUTC"),
        F.col("loadTSUTC"),
        F.col("id").alias("postId"),
        F.col("subreddit"),
        F.col("subscribers"),
        F.col("accounts_active").alias("activeUsers"),
        F.col("title"),
        F.timestamp_seconds(F.col("created_utc")).alias("createdTSUTC"),
        F.col("timeElapsedMin"),
        F.col("score"),
        F.col("num_comments").alias("numComments"),
        F.col("upvote_ratio").alias("upvoteRatio"),
        map_value_sum(F.col("gildings")).alias("numGildings"),
        *keep,
    )


def dedupe_latest(df: DataFrame, keys: list[str], order_col: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Newest row per key; equal times fall to the largest ``tiebreak``.

    Planned as a group limit before the shuffle: one row per key and map task
    travels, so a key holding a large share of all rows costs nothing extra.
    """
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak or []]
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_newest", newest).where(F.col("_newest") == 1).drop("_newest")


_DATE = r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
_TIME = r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}"
# The one layout each attribute may have; a plain cast would let others through.
_LAYOUTS = {
    "loadDateUTC": f"^{_DATE}$",
    "loadTimeUTC": f"^{_TIME}$",
    "loadTSUTC": f"^{_DATE} {_TIME}$",
    "createdTSUTC": f"^{_DATE} {_TIME}$",
}


def _typed(name: str) -> str:
    """The attribute converted, NULL where it does not convert."""
    kind = SNAPSHOT[name].dataType.simpleString()
    value = f"try_cast(`{name}` AS {kind})"
    if name == "loadTimeUTC":
        value = f"date_format(try_cast(concat('1900-01-01 ', `{name}`) AS timestamp), 'HH:mm:ss')"
    return f"CASE WHEN `{name}` RLIKE '{_LAYOUTS[name]}' THEN {value} END" if name in _LAYOUTS else value


def _bad(name: str) -> str:
    """A value that is present but does not convert, or a required one that is absent."""
    present = f" AND `{name}` IS NOT NULL" if SNAPSHOT[name].nullable else ""
    return f"({_typed(name)} IS NULL{present})"


_ANY_BAD = " OR ".join(_bad(name) for name in SNAPSHOT.names)


def typed_snapshots(landed: DataFrame) -> DataFrame:
    """Text attributes to typed snapshots; rows that do not convert go to ``rejected_snapshots``."""
    return landed.where(f"NOT ({_ANY_BAD})").selectExpr(*[f"{_typed(name)} AS `{name}`" for name in SNAPSHOT.names])


def rejected_snapshots(landed: DataFrame) -> DataFrame:
    """The rows ``typed_snapshots`` leaves out, untouched, with the offending columns listed."""
    names = ", ".join(f"CASE WHEN {_bad(name)} THEN '{name}' END" for name in SNAPSHOT.names)
    return landed.where(_ANY_BAD).selectExpr(*LANDED.names, f"concat_ws(',', {names}) AS badColumns")


def stale_rows(snapshots: DataFrame, max_seconds: int = 3600) -> DataFrame:
    """Snapshots taken more than ``max_seconds`` after the post was created."""
    age = F.unix_timestamp(F.col("loadTSUTC")) - F.unix_timestamp(F.col("createdTSUTC"))
    return snapshots.where(age > max_seconds)
