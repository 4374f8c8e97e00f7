"""Continuous intake: landed feed items to the snapshot tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from posttrend.plans.collect import collect_parts, collect_put

CADENCE = "1 minute"


def run_collect(
    listing: DataFrame, paths: dict[str, str], checkpoint: str, cadence: str | None = CADENCE, items: str | None = None
) -> StreamingQuery:
    """Put the snapshots of every landed batch into the table of their view.

    A fetch must land within one batch, as its ranks are compared, unless ``items`` names a folder to keep feed items
    in: then a fetch is ranked anew whenever more of it lands.  A batch that is replayed replaces what it wrote.
    """

    def handle(batch: DataFrame, _: int) -> None:
        if items is None:
            collect_put(batch, paths)
        else:
            collect_parts(batch, paths, items)

    writer = listing.writeStream.foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=cadence) if cadence else writer.trigger(availableNow=True)).start()
