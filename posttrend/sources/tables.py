"""Reading and writing the tables of the system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posttrend.operators.intake import dedupe_latest
from posttrend.operators.merge import delete_by_key
from posttrend.schema import LANDED, LISTING, SNAPSHOT, SNAPSHOT_KEY
from posttrend.sources.keyed import KeyedTable, is_keyed
from posttrend.sources.scored import append_scored, read_scored, read_scored_batch  # noqa: F401  (read with the others)


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Raw feed items from JSON lines."""
    return spark.read.schema(LISTING).json(path)


def read_landed_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Text snapshots from CSV with a header; ``columns`` gives the file's own column order."""
    names = columns or LANDED.names
    order = T.StructType([LANDED[name] for name in names])
    return spark.read.schema(order).csv(path, header=True, enforceSchema=False).select(*LANDED.names)


def snapshot_table(spark: SparkSession, path: str) -> KeyedTable:
    """The stored snapshots: one per post and load time, a snapshot put again replaces the one before."""
    return KeyedTable(spark, path, SNAPSHOT, SNAPSHOT_KEY, "loadDateUTC")


# Raw feed items with the day of their fetch; an item of a fetch counts once, however often it lands.
LANDED_ITEM = T.StructType([*LISTING.fields, T.StructField("fetchDate", T.DateType(), False)])
FETCH = ["subreddit", "view", "fetched_at"]


def item_table(spark: SparkSession, path: str) -> KeyedTable:
    """The stored feed items, so that a fetch that lands in parts can be ranked as a whole."""
    return KeyedTable(spark, path, LANDED_ITEM, [*FETCH, "rank", "id"], "fetchDate")


def read_snapshots(spark: SparkSession, path: str, latest_only: bool = False) -> DataFrame:
    """A snapshot table: the newest version where versions are kept, else files partitioned by load date.

    Of such files ``latest_only`` lets the row written last stand for its (post, load time), so
    that writing a snapshot again replaces it; versions hold one row per key anyway.
    """
    if is_keyed(spark, path):
        return snapshot_table(spark, path).read()
    rows = spark.read.schema(SNAPSHOT).parquet(path)
    if not latest_only:
        return rows.select(*SNAPSHOT.names)
    written = rows.select(
        *SNAPSHOT.names,
        F.col("_metadata.file_modification_time").alias("_written"),
        F.col("_metadata.file_path").alias("_file"),
    )
    return dedupe_latest(written, SNAPSHOT_KEY, "_written", ["_file"]).drop("_written", "_file")


def _by_day(df: DataFrame, day: str) -> DataFrame:
    """Gather each day into few files; adaptive execution splits days too large for one task."""
    return df.hint("rebalance", day)


def append_snapshots(snapshots: DataFrame, path: str) -> None:
    """Add a batch of snapshots under its load dates."""
    _by_day(snapshots.select(*SNAPSHOT.names), "loadDateUTC").write.partitionBy("loadDateUTC").mode("append").parquet(path)


def replace_days(rows: DataFrame, path: str, day: str) -> None:
    """Overwrite only the day partitions that occur in ``rows``."""
    writer = _by_day(rows, day).write.partitionBy(day).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_training(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def rewrite_without(snapshots: DataFrame, bad: DataFrame, path: str) -> None:
    """A copy of a snapshot table less the rows whose (post, load time) is in ``bad``.

    It goes to a path of its own: a day that loses all its rows must not survive,
    and readers of the old table are left alone until they are pointed here.
    """
    append_snapshots(delete_by_key(snapshots, bad, SNAPSHOT_KEY), path)


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational table; filters and column choices are pushed to the database."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options).load()
