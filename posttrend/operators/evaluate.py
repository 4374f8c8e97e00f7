"""Model quality from (score, 0/1 label) rows: quantiles, precision, recall, PR curve and area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posttrend.operators.ranking import (
    SLICES,
    at_or_above,
    interpolated,
    position,
    quantile_ends,
    quantiles_wide,
    running_counts,
)
from posttrend.operators.scoring import post_link

# The quantiles the review plots use.  The last one is 1.0: stepping
# from .95 by .005 in floating point lands just below 1 one time more.
TOP_QUANTILES = [0.95, 0.955, 0.96, 0.965, 0.97, 0.975, 0.98, 0.985, 0.99, 0.995, 1.0]


def quantiles(
    df: DataFrame, col: str, qs: list[float], by: list[str] | None = None, slices: int = SLICES
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per (group,) quantile."""
    by = list(by or [])
    wide = quantiles_wide(df, col, qs, by, slices)
    return wide.selectExpr(*by, f"inline({_long(qs, 'quantiles')})")


def _long(qs: list[float], array: str) -> str:
    """(q, value) structs from an array in the order of ``qs``."""
    return "array(" + ", ".join(f"struct({float(q)!r}D AS q, {array}[{i}] AS value)" for i, q in enumerate(qs)) + ")"


def approx_quantiles(df: DataFrame, col: str, qs: list[float], accuracy: int = 10000) -> DataFrame:
    """Sketch quantiles in one pass, for a quick look at very large score tables."""
    wide = df.select(F.percentile_approx(col, [float(q) for q in qs], accuracy).alias("quantiles"))
    return wide.selectExpr(f"inline({_long(qs, 'quantiles')})")


def running_scores(
    df: DataFrame, p: str, y: str, by: list[str] | None = None, min_quantile: float | None = None, slices: int = SLICES
) -> DataFrame:
    """Distinct scores with running row and positive counts, optionally of the top scores only.

    Whether a score lies at or above a quantile shows in its running count, so the
    top scores need no threshold to be looked up first.
    """
    scores = df.select(*(by or []), F.col(p).cast("double").alias("_v"), F.col(y).alias("_y"))
    needed = None if min_quantile is None else f"before_n + size_n > floor{position(min_quantile)}"
    return running_counts(scores, "_v", by, {"tp": F.col("_y")}, needed, slices)


def above_counts(q: float, tag: str) -> list[Column]:
    """Aggregates over running scores: rows and positives at or above quantile ``q``."""
    return [F.expr(f"sum(CASE WHEN {at_or_above(q)} THEN {c} END) AS {c}{tag}") for c in ("n", "tp")]


def pr_at_quantiles(df: DataFrame, p: str, y: str, qs: list[float] | None = None, slices: int = SLICES) -> DataFrame:
    """Threshold, precision and recall of the rows at or above each score quantile, in one pass."""
    qs = list(TOP_QUANTILES if qs is None else qs)
    measures = [F.max("total_n").alias("total_n"), F.max("total_tp").alias("positives")]
    for i, q in enumerate(qs):
        measures += [*quantile_ends(q, str(i)), *above_counts(q, str(i))]
    rows = ", ".join(
        f"struct({float(q)!r}D AS q, {interpolated(q, str(i))} AS threshold,"
        f" try_divide(tp{i}, n{i}) AS precision, try_divide(tp{i}, positives) AS recall)"
        for i, q in enumerate(qs)
    )
    return running_scores(df, p, y, min_quantile=min(qs), slices=slices).agg(*measures).selectExpr(f"inline(array({rows}))")


def top_share_metrics(df: DataFrame, p: str, y: str, q: float = 0.98) -> DataFrame:
    """Threshold, precision and recall of the top (1 - q) share of scores."""
    return pr_at_quantiles(df, p, y, [q])


# Totals at or above a distinct score, and strictly above it, from its running counts.
_UPTO = {c: f"(total_{c} - cum_{c} + {c})" for c in ("n", "tp")}
_ABOVE = {c: f"(total_{c} - cum_{c})" for c in ("n", "tp")}


def pr_curve(df: DataFrame, p: str, y: str, slices: int = SLICES) -> DataFrame:
    """One point per distinct score, and the anchor (recall 0, precision 1) with no threshold."""
    points = running_scores(df, p, y, slices=slices).selectExpr(
        "value AS threshold",
        f"try_divide({_UPTO['tp']}, {_UPTO['n']}) AS precision",
        f"try_divide({_UPTO['tp']}, total_tp) AS recall",
    )
    anchor = df.sparkSession.range(1).selectExpr(
        "cast(NULL AS double) AS threshold", "1.0D AS precision", "0.0D AS recall"
    )
    return points.unionByName(anchor)


def area_under_curve(name: str, min_quantile: float | None = None) -> Column:
    """Aggregate over running scores: trapezoid area under the anchored precision-recall curve.

    Each point holds the totals above it, so the trapezoid to its left needs no
    look at the neighbouring row.  Leaving out low scores changes no such total.
    """
    here = f"try_divide({_UPTO['tp']}, {_UPTO['n']})"
    left = f"coalesce(try_divide({_ABOVE['tp']}, {_ABOVE['n']}), 1.0D)"
    kept = "true" if min_quantile is None else at_or_above(min_quantile)
    area = f"sum(CASE WHEN {kept} THEN tp * ({here} + {left}) / 2 END)"
    return F.expr(f"try_divide({area}, sum(CASE WHEN {kept} THEN tp END)) AS {name}")


def auc_pr(
    df: DataFrame,
    p: str,
    y: str,
    min_quantile: float | None = None,
    by: list[str] | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Area under the precision-recall curve, optionally of the scores at or above a quantile."""
    by = list(by or [])
    return running_scores(df, p, y, by, min_quantile, slices).groupBy(*by).agg(area_under_curve("aucpr", min_quantile))


def pr_at_threshold(df: DataFrame, p: str, y: str, threshold: float, by: list[str] | None = None) -> DataFrame:
    """Recall and precision of a fixed threshold, with the counts behind them."""
    up = F.col(p) >= F.lit(float(threshold))
    counts = df.groupBy(*(by or [])).agg(
        F.count_if(F.col(y) == 1).alias("positives"),
        F.count_if((F.col(y) == 1) & up).alias("true_positives"),
        F.count_if((F.col(y) == 0) & up).alias("false_positives"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    return counts.select(
        "*",
        F.try_divide(tp, F.col("positives")).alias("recall"),
        F.try_divide(tp, tp + fp).alias("precision"),
    )


def top_predictions(df: DataFrame, p: str, y: str, n: int = 10, tiebreak: str = "postId") -> DataFrame:
    """The ``n`` highest scores with their labels."""
    return df.select(tiebreak, p, y).orderBy(F.col(p).desc(), F.col(tiebreak)).limit(n)


def review_list(df: DataFrame, p: str, y: str, threshold: float, features: list[str] | None = None) -> DataFrame:
    """All positives and the negatives at or above the threshold, with links for a manual look."""
    wanted = (F.col(y) == 1) | ((F.col(y) == 0) & (F.col(p) >= F.lit(float(threshold))))
    return df.where(wanted).select(
        F.col(y).alias("target"),
        F.col("postId"),
        post_link().alias("link"),
        F.col(p).alias("prediction"),
        F.col("createdTSUTC"),
        *(features or []),
    )


def review_order(rows: DataFrame) -> DataFrame:
    """Positives first, then false positives, each by falling score; equal scores by post."""
    return rows.orderBy(F.col("target").desc(), F.col("prediction").desc(), "postId")
