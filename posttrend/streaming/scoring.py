"""Scoring as a stream: every trigger scores the posts that changed, alerts and stores them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from posttrend.plans.live import Scorer, score_batch, store_batch
from posttrend.streaming.features import DELAY, TRIGGER, drop_aged, stream_features


def _trigger(writer, cadence: str | None):
    return writer.trigger(processingTime=cadence) if cadence else writer.trigger(availableNow=True)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The identifier Spark gave a stream when its checkpoint was begun."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def run_scoring(
    snapshots: DataFrame,
    scorer: Scorer,
    model: str,
    threshold: float,
    paths: dict[str, str],
    delay: str = DELAY,
    cadence: str | None = TRIGGER,
    history: dt.timedelta = dt.timedelta(days=2),
) -> StreamingQuery:
    """Start scoring a snapshot stream into ``paths`` (scored, alerts, checkpoint).

    ``cadence=None`` works off what is there and stops.  Prior alerts are looked
    up among the posts created within ``history`` of the oldest post of a batch.
    Rows are stored under the identifier kept in the checkpoint: a stream that goes
    on continues its batch numbers, one begun anew has a run of its own.  A batch
    stands for the time at which it was first tried, also when it is repeated.
    """
    run: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Kept for the two reads below; each would otherwise replay the stateful aggregate.
        batch = batch.persist()
        try:
            oldest, moment = batch.agg(F.min(F.to_date("createdTSUTC")), F.max("_moment")).first()
            if oldest is not None:
                if not run:
                    run.append(checkpoint_id(batch.sparkSession, paths["checkpoint"]))
                scored = score_batch(batch.drop("_moment"), scorer, model, threshold)
                since = oldest - history
                store_batch(scored, threshold, paths["scored"], paths["alerts"], batch_id, since, run[0], moment)
        finally:
            batch.unpersist()

    # In a stream the current time is that of the micro-batch, which its offset log keeps.
    features = stream_features(drop_aged(snapshots), delay).withColumn("_moment", F.unix_micros(F.current_timestamp()))
    writer = features.writeStream.outputMode("update").foreachBatch(handle)
    return _trigger(writer.option("checkpointLocation", paths["checkpoint"]), cadence).start()


def write_final_features(
    snapshots: DataFrame, path: str, checkpoint: str, delay: str = DELAY, cadence: str | None = TRIGGER
) -> StreamingQuery:
    """Append each post's features once they can no longer change."""
    writer = stream_features(drop_aged(snapshots), delay).writeStream.outputMode("append").format("parquet")
    return _trigger(writer.option("path", path).option("checkpointLocation", checkpoint), cadence).start()


def write_feature_updates(
    snapshots: DataFrame, path: str, checkpoint: str, delay: str = DELAY, cadence: str | None = TRIGGER
) -> StreamingQuery:
    """Store every run's changed feature rows under its batch number; a replayed batch replaces itself."""
    return write_updates(stream_features(snapshots, delay), path, checkpoint, cadence)


def write_updates(rows: DataFrame, path: str, checkpoint: str, cadence: str | None = TRIGGER) -> StreamingQuery:
    """Store what each run changed under its batch number; a replayed batch replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        writer = rows.write.partitionBy("batch").mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)

    writer = rows.writeStream.outputMode("update").foreachBatch(handle)
    return _trigger(writer.option("checkpointLocation", checkpoint), cadence).start()
