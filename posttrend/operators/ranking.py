"""Exact global ranks without a global sort on one task.

Ranks over the whole table (quantiles, precision-recall curves) are made from
three small facts: rows per distinct value, cut points that divide the distinct
values into slices of near-equal size, and the row totals of the slices.  Sorting
happens within a slice only; what lies before a slice is added as an offset.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 256
SALTS = 32


def join_groups(rows: DataFrame, groups: DataFrame, by: list[str], spread: str, salts: int = SALTS) -> DataFrame:
    """Bring one-per-group facts to the rows of the group.

    The facts are repeated per salt and the rows salted by a hash of ``spread``.
    If the facts turn out small they are broadcast; if not, a group holding a
    third of all rows is still spread over ``salts`` tasks, and what follows
    cannot settle on one task per group.
    """
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # Never NULL, as in ``_slice_of``.
    spread_rows = rows.withColumn("_salt", F.expr(f"coalesce(pmod(hash({spread}), {salts}), 0)"))
    return join_equal(spread_rows, salted, [*by, "_salt"]).drop("_salt")


def join_equal(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL, so that the group without a name is kept like any other."""
    named = facts.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return rows.join(named, same).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, value: str, by: list[str], sums: dict[str, Column]) -> DataFrame:
    """One row per distinct (by, value): row count ``n`` and the named sums; NULL values are left out, NULL groups are not."""
    totals = [F.sum(column).alias(name) for name, column in sums.items()]
    return df.where(f"{value} IS NOT NULL").groupBy(*by, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"), *totals)


def _slice_stats(counts: DataFrame, by: list[str], names: list[str], slices: int) -> DataFrame:
    """Cut points and totals per group; every column of ``counts`` is used so its shuffle is shared."""
    probs = ", ".join(f"{(i + 1) / slices!r}D" for i in range(slices - 1))
    cuts = F.expr(f"percentile_approx(value, array({probs}), {4 * slices}) AS cuts")
    stats = counts.groupBy(*by).agg(cuts, *[F.sum(c).alias(f"total_{c}") for c in names])
    step = _step(slices)
    every = ", ".join(f"cuts[{i}]" for i in range(step - 1, slices - 1, step))
    return stats.selectExpr("*", f"array({every}) AS marks")


def _step(slices: int) -> int:
    return max(math.isqrt(slices), 2)


def _slice_of(stats: str, slices: int) -> str:
    """Number of cut points below the value: first among every ``step``-th one, then among those that follow it.

    Never NULL, or the join on it would filter beneath the counts and spoil their reuse.
    """
    step = _step(slices)
    mark = f"size(filter({stats}marks, c -> c < value))"
    return (
        f"coalesce({mark} * {step}"
        f" + size(filter(slice({stats}cuts, {mark} * {step} + 1, {step - 1}), c -> c < value)), 0) AS slice"
    )


def running_counts(
    df: DataFrame,
    value: str,
    by: list[str] | None = None,
    sums: dict[str, Column] | None = None,
    needed: str | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Distinct values with running totals in ascending order of value.

    Columns: ``by``, ``value``, ``n`` and each named sum, ``cum_*`` (this value
    included) and ``total_*`` for all of them.  ``needed`` is a condition on the
    row numbers a slice covers (``before_n``, ``size_n``, ``total_n``); the rows
    of slices that do not meet it are dropped before the sort.
    """
    by, sums = list(by or []), dict(sums or {})
    names = ["n", *sums]
    counts = value_counts(df, value, by, sums)
    stats = _slice_stats(counts, by, names, slices)
    totals = [f"total_{c}" for c in names]
    if by:
        sliced = join_groups(counts, stats, by, "value").selectExpr(
            *counts.columns, _slice_of("", slices), *totals
        )
    else:
        sliced = counts.withColumn("_s", stats.select(F.struct("*")).scalar()).selectExpr(
            *counts.columns, _slice_of("_s.", slices), *[f"_s.{t}" for t in totals]
        )
    # At most ``slices`` rows per group from here to the join.
    # The totals are grouping columns so that both uses of the stats need all of them and share one run.
    sizes = sliced.groupBy(*by, "slice", *totals).agg(*[F.expr(f"sum({c}) AS size_{c}") for c in names])
    groups = f"PARTITION BY {', '.join(by)} " if by else ""
    before = f"OVER ({groups}ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = sizes.selectExpr(
        *by, "slice", *[f"coalesce(sum(size_{c}) {before}, 0) AS before_{c}" for c in names], "size_n", "total_n"
    )
    if needed is not None:
        offsets = offsets.where(needed)
    offsets = offsets.drop("size_n", "total_n")
    # Without groups the offsets are ``slices`` rows at most, whatever the data.  With
    # groups the measured size decides; slices are even, so this join has no hot key.
    ranked = join_equal(sliced, offsets, [*by, "slice"]) if by else sliced.join(F.broadcast(offsets), "slice")
    upto = f"OVER (PARTITION BY {', '.join([*by, 'slice'])} ORDER BY value ROWS UNBOUNDED PRECEDING)"
    return ranked.selectExpr(
        *by, "value", *names, *[f"before_{c} + sum({c}) {upto} AS cum_{c}" for c in names], *totals
    )


def position(q: float) -> str:
    """Fractional row number of quantile ``q``, counted from 0."""
    return f"((total_n - 1) * {float(q)!r}D)"


def at_or_above(q: float) -> str:
    """Condition on a running count: the value is not below the interpolated quantile ``q``."""
    return f"cum_n > ceil{position(q)}"


def quantile_ends(q: float, tag: str) -> list[Column]:
    """Aggregates over running counts: the values on either side of quantile ``q``."""
    side = "min(CASE WHEN cum_n > {at} THEN value END) AS {name}"
    return [
        F.expr(side.format(at=f"floor{position(q)}", name=f"lo{tag}")),
        F.expr(side.format(at=f"ceil{position(q)}", name=f"hi{tag}")),
    ]


def interpolated(q: float, tag: str) -> str:
    """The quantile from its ``quantile_ends`` and ``total_n``."""
    at = position(q)
    return f"lo{tag} + (hi{tag} - lo{tag}) * ({at} - floor{at})"


def quantiles_wide(
    df: DataFrame, value: str, qs: list[float], by: list[str] | None = None, slices: int = SLICES
) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per group with an array in the order of ``qs``."""
    by = list(by or [])
    holds_a_rank = " OR ".join(
        f"(ceil{position(q)} >= before_n AND floor{position(q)} < before_n + size_n)" for q in qs
    )
    doubles = df.select(*by, F.col(value).cast("double").alias("_v"))
    ranked = running_counts(doubles, "_v", by, None, holds_a_rank, slices)
    ends = [end for i, q in enumerate(qs) for end in quantile_ends(q, str(i))]
    found = ranked.groupBy(*by).agg(*ends, F.max("total_n").alias("total_n"))
    parts = ", ".join(interpolated(q, str(i)) for i, q in enumerate(qs))
    return found.selectExpr(*by, f"array({parts}) AS quantiles")
