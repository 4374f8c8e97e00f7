"""Rows that come too late for the stateful streams: kept apart, counted, and filled in by a batch job."""

from __future__ import annotations

import datetime as dt
import json
import posixpath

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from posttrend.operators.features import post_features
from posttrend.operators.scans import history_for
from posttrend.sources.files import Files
from posttrend.sources.tables import snapshot_table
from posttrend.streaming.features import TRIGGER

DELAY = dt.timedelta(minutes=90)
MARKS = "_marks"


def _mark_path(path: str, batch: int) -> str:
    return posixpath.join(path, MARKS, f"{batch:010d}.json")


def marks(spark: SparkSession, path: str) -> list[dict]:
    """What each batch saw, oldest first: rows kept and late, and the largest event time up to then in microseconds."""
    folder = posixpath.join(path, MARKS)
    names = [posixpath.join(folder, n) for n in Files(spark, path).names(folder) if n.endswith(".json")]
    if not names:
        return []
    return sorted((json.loads(r[0]) for r in spark.read.text(names, wholetext=True).collect()), key=lambda m: m["batch"])


def _seen_before(spark: SparkSession, path: str, batch: int) -> int | None:
    """The largest event time of earlier batches; batches without rows leave no mark."""
    names = Files(spark, path).names(posixpath.join(path, MARKS))
    earlier = [n for n in names if n.endswith(".json") and int(n.removesuffix(".json")) < batch]
    if not earlier:
        return None
    return json.loads(spark.read.text(posixpath.join(path, MARKS, max(earlier)), wholetext=True).first()[0])["seen"]


def split_late(
    rows: DataFrame, path: str, checkpoint: str, event_time: str = "createdTSUTC", delay: dt.timedelta = DELAY,
    cadence: str | None = TRIGGER,
) -> StreamingQuery:
    """Write a stream's rows to ``path``/kept and ``path``/late, a folder per batch.

    A row is late if its event time lies more than ``delay`` before the largest one of earlier batches: what a
    watermark of that delay would drop.  Each batch leaves a mark with that largest time and the numbers of rows, as
    observed while they were written; a repeated batch starts from the mark before it and replaces all it wrote.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen_before(spark, path, batch_id)
        at = F.unix_micros(event_time)
        limit = None if seen is None else seen - delay // dt.timedelta(microseconds=1)
        late = F.lit(False) if limit is None else F.coalesce(at < limit, F.lit(False))
        told = Observation()
        observed = batch.withColumn("_late", late).observe(
            told, F.count_if(~F.col("_late")).alias("kept"), F.count_if("_late").alias("late"), F.max(at).alias("seen")
        )
        # One pass: the two sides are folders of one write.
        sides = observed.withColumn("side", F.when(F.col("_late"), "late").otherwise("kept")).drop("_late")
        writer = sides.write.partitionBy("side").mode("overwrite").option("partitionOverwriteMode", "static")
        writer.parquet(posixpath.join(path, "rows", f"batch={batch_id}"))
        counts = told.get
        if not counts["kept"] and not counts["late"]:
            return
        top = max(x for x in (seen, counts["seen"]) if x is not None) if seen is not None or counts["seen"] is not None else None
        mark = {"batch": batch_id, "kept": counts["kept"], "late": counts["late"], "seen": top}
        Files(spark, path).put(_mark_path(path, batch_id), json.dumps(mark), replace=True)

    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=cadence) if cadence else writer.trigger(availableNow=True)).start()


def read_side(spark: SparkSession, path: str, side: str, schema) -> DataFrame:
    """The kept or the late rows of all batches."""
    layout = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, batch bigint, side string"
    rows = spark.read.schema(layout).parquet(posixpath.join(path, "rows"))
    return rows.where(F.col("side") == side).select(*[f.name for f in schema])


def backfill(late: DataFrame, snapshots_path: str) -> DataFrame:
    """Put late snapshots into the stored table and return the features of their posts, made of all their rows."""
    table = snapshot_table(late.sparkSession, snapshots_path)
    table.put(late)
    return post_features(history_for(table.read(), late))
