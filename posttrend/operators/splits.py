"""Repeated stratified train/test splits with exact class shares."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posttrend.functions import row_hash
from posttrend.session import cut_lineage

PREFIX_DIGITS = 3
HASH_DIGITS = 32
# Rows of a prefix that one task may order.
CUT_ROWS = 100_000


def _repeats(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    return df.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(
        "_hash", row_hash(F.col(key), F.col("split"), seed)
    )


def _running(df: DataFrame, y: str, order: str) -> DataFrame:
    upto = Window.partitionBy("split", y).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_upto", F.sum("_n").over(upto))


def _crossed(drawn: DataFrame, y: str, test: float, digits: int, edge: DataFrame | None) -> DataFrame:
    """The prefix of ``digits`` digits the cut falls into per (split, class): its rows, and which of them is the last."""
    prefix = F.substring("_hash", 1, digits).alias("_prefix")
    if edge is None:
        counts = drawn.groupBy("split", y, prefix).agg(F.count(F.lit(1)).alias("_n"))
        size = F.sum("_n").over(Window.partitionBy("split", y))
        sized = counts.withColumn("_wanted", F.round(size * (1 - test)))
    else:
        inside = _inside(drawn, y, edge)
        sized = inside.groupBy("split", y, prefix, F.col("_left").alias("_wanted")).agg(F.count(F.lit(1)).alias("_n"))
    sized = _running(sized, y, "_prefix")
    crossing = sized.where((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted")))
    return crossing.select("split", y, "_prefix", "_n", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_left"))


def _inside(drawn: DataFrame, y: str, edge: DataFrame) -> DataFrame:
    """The rows whose hash begins with the prefix of their split and class."""
    # len(classes) * n rows at most, so the broadcast cannot grow with the data.
    return drawn.join(F.broadcast(edge.drop("_n")), ["split", y]).where(F.col("_hash").startswith(F.col("_prefix")))


def split_cutoffs(
    df: DataFrame, y: str, key: str, test: float, n: int, seed: int, classes: tuple[int, ...], most_rows: int = CUT_ROWS
) -> DataFrame:
    """The hash of the last training row per (split, class).

    Rows are counted per hash prefix first, which combines on the map side and leaves at most 16**PREFIX_DIGITS counts
    per split and class.  Only the one prefix the cut falls into is looked at closer: by the next digits as long as it
    holds more than ``most_rows`` rows, then row by row, so no task ever orders more than that, unless one key does.
    """
    drawn = _repeats(df.where(F.col(y).isin(list(classes))).select(key, y), key, n, seed)
    edge, digits = None, 0
    while digits < HASH_DIGITS:
        digits += PREFIX_DIGITS
        edge = cut_lineage(_crossed(drawn, y, test, digits, edge))
        if (edge.agg(F.max("_n")).first()[0] or 0) <= most_rows:
            break
    hashes = _inside(drawn, y, edge).groupBy("split", y, "_hash", "_left").agg(F.count(F.lit(1)).alias("_n"))
    reached = _running(hashes, y, "_hash").where(F.col("_upto") >= F.col("_left"))
    return reached.groupBy("split", y).agg(F.min("_hash").alias("_cut"))


def stratified_splits(
    df: DataFrame,
    y: str,
    key: str,
    test: float = 0.2,
    n: int = 10,
    seed: int = 0,
    classes: tuple[int, ...] = (0, 1),
) -> DataFrame:
    """``n`` copies of the rows, each marked ``is_train`` for round((1 - test) * size) rows per class.

    Rows are taken in the order of a hash of (key, split, seed), so a split is
    the same in every run and engine.  Rows sharing a key land on the same side;
    rows whose label is not one of ``classes`` are left out.
    """
    cuts = split_cutoffs(df, y, key, test, n, seed, classes)
    rows = _repeats(df.where(F.col(y).isin(list(classes))), key, n, seed)
    # One row per split and class: the marking itself needs no shuffle.
    marked = rows.join(F.broadcast(cuts), ["split", y], "left")
    is_train = F.coalesce(F.col("_hash") <= F.col("_cut"), F.lit(False)).cast("int")
    return marked.select("split", *df.columns, is_train.alias("is_train"))


class Folds(NamedTuple):
    """Rows stored once, and per split and class the hash of its last training row: splits are marked when read, so
    no row is kept once per split.  ``sizes``: training rows per split."""

    rows: DataFrame
    y: str
    key: str
    seed: int
    cuts: dict[int, dict[int, str]]
    sizes: dict[int, int]

    def is_train(self, split: int) -> Column:
        return _in_training(self.y, self.key, self.seed, split, self.cuts[split])

    def train(self, split: int) -> DataFrame:
        return self.rows.where(self.is_train(split))

    def test(self, split: int) -> DataFrame:
        return self.rows.where(~self.is_train(split))


def _in_training(y: str, key: str, seed: int, split: int, cuts: dict[int, str]) -> Column:
    cut = F.lit(None).cast("string")
    for label, last in cuts.items():
        cut = F.when(F.col(y) == label, F.lit(last)).otherwise(cut)
    return F.coalesce(row_hash(F.col(key), split, seed) <= cut, F.lit(False))


def stored_folds(
    df: DataFrame, y: str, key: str, test: float = 0.2, n: int = 10, seed: int = 0, classes: tuple[int, ...] = (0, 1),
) -> Folds:
    """The splits of ``stratified_splits`` over one stored copy of the rows."""
    rows = cut_lineage(df.where(F.col(y).isin(list(classes))))
    cuts: dict[int, dict[int, str]] = {split: {} for split in range(n)}
    # n * len(classes) rows.
    for r in split_cutoffs(rows, y, key, test, n, seed, classes).collect():
        cuts[r["split"]][r[y]] = r["_cut"]
    counts = [F.count_if(_in_training(y, key, seed, split, cuts[split])).alias(str(split)) for split in range(n)]
    return Folds(rows, y, key, seed, cuts, {int(k): v for k, v in rows.agg(*counts).first().asDict().items()})
