"""Landed feed items to the two snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.operators.intake import dedupe_latest, normalize_listing
from posttrend.schema import LISTING, SNAPSHOT_KEY
from posttrend.sources.tables import FETCH, append_snapshots, item_table, snapshot_table

# How deep each feed is read.
FEED_DEPTH = {"rising": 25, "hot": 3}


def feed_snapshots(listing: DataFrame, view: str, top_n: int | None = None) -> DataFrame:
    """Clean snapshots of one view, one per post and load time: of repeats, the one listed last."""
    rows = normalize_listing(listing, view, FEED_DEPTH[view] if top_n is None else top_n, keep=("rank",))
    return dedupe_latest(rows, SNAPSHOT_KEY, "loadTSUTC", ["rank"]).drop("rank")


def collect(listing: DataFrame, paths: dict[str, str]) -> None:
    """Append the rising and hot snapshots of a landed batch."""
    for view, path in paths.items():
        append_snapshots(feed_snapshots(listing, view), path)


def collect_put(listing: DataFrame, paths: dict[str, str]) -> None:
    """Put the rising and hot snapshots of a landed batch: collected again, they replace themselves."""
    for view, path in paths.items():
        snapshot_table(listing.sparkSession, path).put(feed_snapshots(listing, view))


def collect_parts(listing: DataFrame, paths: dict[str, str], items_path: str) -> None:
    """As ``collect_put``, where a fetch may land in parts: its ranks are those among all its items so far.

    The items go into a table of their own; the fetches a batch has items of are read back whole, ranked anew, and
    their snapshots take the place of those made of fewer items.  Batches may be cut anywhere and come again.
    """
    spark = listing.sparkSession
    items = item_table(spark, items_path)
    landed = listing.select(*LISTING.names, F.to_date("fetched_at").alias("fetchDate")).dropDuplicates(items.keys)
    items.put(landed)
    days = [r[0] for r in landed.select("fetchDate").distinct().collect()]
    if not days:
        return
    for view, path in paths.items():
        fetches = landed.where(F.col("view") == view).select(*FETCH, "fetchDate").distinct()
        whole = items.read(since=min(days), until=max(days)).join(fetches, [*FETCH, "fetchDate"], "left_semi")
        groups = fetches.select("subreddit", F.col("fetched_at").alias("loadTSUTC"), F.col("fetchDate").alias("loadDateUTC"))
        snapshot_table(spark, path).replace_groups(groups, feed_snapshots(whole, view), ["subreddit", "loadTSUTC"])
