"""Membership labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_members(df: DataFrame, members: DataFrame, key: str = "postId", out: str = "target") -> DataFrame:
    """1 where the key occurs in ``members``, else 0.

    The member set grows with the data, so no broadcast is forced: its measured
    size decides at run time.  Both sides hold one row per key.
    """
    hits = members.select(key).distinct().withColumn("_hit", F.lit(1))
    return df.join(hits, key, "left").withColumn(out, F.coalesce("_hit", F.lit(0))).drop("_hit")
