"""Keyed table maintenance and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posttrend.operators.intake import dedupe_latest


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """The empty table an upsert starts from when the target is not there yet."""
    return spark.createDataFrame([], schema)


def _one_per_key(new: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """The row of each key that comes last by ``order``, then by the other columns that can be sorted."""
    sortable = [
        f.name for f in new.schema.fields if f.name not in [*keys, order] and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    ranks = [order, *sortable] if order else sortable
    if not ranks:
        return new.dropDuplicates(keys)
    return dedupe_latest(new, keys, ranks[0], ranks[1:])


def _checked_unique(new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` as it is; reading it fails where two rows share a key.

    The count runs over the join's own partitioning and order, and needs no column but the keys.
    """
    names = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit("several new rows of the key "), names)
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    counted = new.withColumn("_copies", F.when(copies > 1, F.raise_error(message).cast("int")))
    return counted.where(F.col("_copies").isNull()).drop("_copies")


def upsert(
    old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None, unique: bool = False
) -> DataFrame:
    """Insert the new keys and replace the columns ``new`` carries where the key exists.

    Columns only ``old`` has keep their value on an update and are NULL on an
    insert.  ``new`` must not bring columns the table lacks; add those first with
    ``ensure_columns``.  Of several new rows of one key the one with the largest
    ``order`` counts (without it, or on a tie, the largest by the other columns),
    so the table stays unique on ``keys``.  A key with a NULL in it finds nothing
    in ``old``; new rows with the same such key count as one.  ``unique`` says that
    no two new rows share a key: none is ranked, and if two do, reading the result fails.
    """
    unknown = [c for c in new.columns if c not in old.columns]
    if unknown:
        raise ValueError(f"columns not in the target table: {unknown}")
    # Both sides are read once, and the rank above is partitioned like the join.
    here = F.lit(True).alias("here")
    before = old.select(*keys, F.struct(here, *[c for c in old.columns if c not in keys]).alias("_old"))
    incoming = _checked_unique(new, keys) if unique else _one_per_key(new, keys, order)
    incoming = incoming.select(*keys, F.struct(here, *[c for c in new.columns if c not in keys]).alias("_new"))

    def pick(name: str):
        if name in keys:
            return F.col(name)
        if name not in new.columns:
            return F.col("_old")[name].alias(name)
        return F.when(F.col("_new.here"), F.col("_new")[name]).otherwise(F.col("_old")[name]).alias(name)

    return before.join(incoming, keys, "full").select(*[pick(c) for c in old.columns])


def delete_by_key(df: DataFrame, bad: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key is not in ``bad``."""
    return df.join(bad.select(*keys).distinct(), keys, "left_anti").select(*df.columns)


def ensure_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add the columns that are missing as typed NULLs; existing ones stay as they are."""
    missing = {c: F.lit(None).cast(kind) for c, kind in wanted.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def union_all(frames: list[DataFrame], spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Bag union by name; no frames give an empty frame of ``schema``."""
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else empty_like(spark, schema)


def flatten_items(df: DataFrame, column: str, out: str = "item") -> DataFrame:
    """One row per element of an array of arrays (or of an array)."""
    nested = isinstance(df.schema[column].dataType.elementType, T.ArrayType)
    items = F.flatten(column) if nested else F.col(column)
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(items).alias(out))


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(ids, values, name, value)
