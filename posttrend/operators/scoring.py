"""Scores, step-up decisions and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts and number formats of an alert.
LINK_BASE = "https://reddit.com/"
ALERT_HEADER = "Found potentially viral post(s):"
ALERT_BODY = "  %s\n    score=%.4f\n    :arrow_up: %d | :speech_balloon: %d | :clock10: %d"
ALERT_FOOTER = "threshold = %.4f"


def linear_margin(weights: dict[str, float], intercept: float) -> Column:
    terms = [f"cast(`{name}` AS double) * {float(w)!r}D" for name, w in weights.items()]
    return F.expr(" + ".join([f"{float(intercept)!r}D", *terms]))


def score_linear(
    df: DataFrame, weights: dict[str, float], intercept: float, out: str = "predict_proba_1"
) -> DataFrame:
    """Probability of a logistic model given as plain weights."""
    return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_margin(weights, intercept))))


def with_model_name(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("modelName", F.lit(name))


def mark_step_up(df: DataFrame, threshold: float = 0.0, score: str = "predict_proba_1") -> DataFrame:
    """``stepUp`` = 1 at or above the threshold; a threshold of 0 steps up everything."""
    decided = F.coalesce(F.col(score) >= F.lit(float(threshold)), F.lit(False))
    return df.withColumn("stepUp", decided.cast("int"))


def drop_already_alerted(new: DataFrame, prior: DataFrame, key: str = "postId", flag: str = "stepUp") -> DataFrame:
    """Drop rows that step up again after they already did.

    Rows that no longer step up pass, so that the stored flag is reset and the
    post may alert once more later.
    """
    alerted = prior.where(F.col(flag) == 1).select(key, flag)
    return new.join(alerted, [key, flag], "left_anti")


def post_link(key: str = "postId", base: str = LINK_BASE) -> Column:
    return F.concat(F.lit(base), F.col(key))


def alert_messages(
    scored: DataFrame, threshold: float, score: str = "predict_proba_1", link_base: str = LINK_BASE
) -> DataFrame:
    """One alert text per stepped-up post, with the header and footer lines of its batch."""
    body = F.format_string(
        ALERT_BODY,
        post_link(base=link_base),
        F.col(score),
        F.coalesce(F.col("maxScore41_60m"), F.lit(0)).cast("long"),
        F.coalesce(F.col("maxNumComments41_60m"), F.lit(0)).cast("long"),
        F.col("timeElapsedMin").cast("long"),
    )
    return scored.where(F.col("stepUp") == 1).select(
        F.col("postId"),
        post_link(base=link_base).alias("link"),
        body.alias("message"),
        F.lit(ALERT_HEADER).alias("header"),
        F.lit(ALERT_FOOTER % threshold).alias("footer"),
    )
