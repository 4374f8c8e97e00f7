"""One scoring run over the posts seen most recently."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posttrend.functions.columns import utc_date
from posttrend.operators.features import fill_features, post_features, time_features
from posttrend.operators.models import score_model
from posttrend.operators.scans import are_few, recent_ids, stored_ids
from posttrend.operators.scoring import alert_messages, drop_already_alerted, mark_step_up, with_model_name
from posttrend.schema import SCORED
from posttrend.sources.scored import JOBS, batch_path, commit, committed, head, read_attempts, read_scored, write_attempt

Scorer = Callable[[DataFrame], DataFrame]


def model_scorer(model) -> Scorer:
    """Adapt a fitted model to the scoring run; time features are there for the models that use them."""
    return lambda features: score_model(time_features(features), model)


def live_features(
    snapshots: DataFrame, as_of: dt.datetime, lookback: dt.timedelta = dt.timedelta(minutes=15),
    history: dt.timedelta | None = None, **window,
) -> DataFrame:
    """Features of the posts seen within ``lookback`` of ``as_of``.

    The ids come first, and as long as they are few (they are those of some minutes) only the snapshots of these posts
    are aggregated: all others are dropped where they are read.  Of more ids the features come first, so that a post
    with very many snapshots is reduced in the map tasks instead of meeting the join as one huge key.  A post's whole
    history up to ``as_of`` counts; ``history`` limits the scan to so much before the look-back, for callers who
    know that no post has older snapshots.
    """
    days = F.col("loadDateUTC") <= F.lit(utc_date(as_of))
    if history is not None:
        days = days & (F.col("loadDateUTC") >= F.lit(utc_date(as_of - lookback - history)))
    ids = stored_ids(recent_ids(snapshots, as_of, lookback, **window))
    known = snapshots.where(days)
    if are_few(ids):
        return post_features(known.join(F.broadcast(ids), "postId", "left_semi"))
    return post_features(known).join(ids, "postId", "left_semi")


def score_batch(features: DataFrame, scorer: Scorer, model: str, threshold: float) -> DataFrame:
    """Filled, scored and decided rows in the layout of the scored table."""
    scored = mark_step_up(scorer(fill_features(features)), threshold)
    return with_model_name(scored, model).select(*SCORED.names)


def run_once(
    snapshots: DataFrame,
    scorer: Scorer,
    model: str,
    threshold: float,
    scored_path: str,
    alerts_path: str,
    as_of: dt.datetime,
    batch: int,
    lookback: dt.timedelta = dt.timedelta(minutes=15),
    history: dt.timedelta | None = None,
) -> bool:
    """Score, alert and store one run; repeating a ``batch`` number replaces that batch.  False if nothing was new.

    All earlier alerts are remembered; ``history`` limits both the snapshots read and the alerts looked up.
    Batches come in the order of their ``as_of``, those of one ``as_of`` in the order of their numbers.
    """
    scored = score_batch(live_features(snapshots, as_of, lookback, history), scorer, model, threshold)
    since = None if history is None else utc_date(as_of - lookback - history)
    return store_batch(scored, threshold, scored_path, alerts_path, batch, since, moment=_micros(as_of))


def _micros(moment: dt.datetime) -> int:
    """Microseconds since 1970; a time without a zone is UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)
    return (aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def store_batch(
    scored: DataFrame,
    threshold: float,
    scored_path: str,
    alerts_path: str,
    batch: int,
    since: dt.date | None,
    run: str = JOBS,
    moment: int | None = None,
) -> bool:
    """Write a scored batch and its alerts; False if no row is left.

    The batch is computed once: alerts come from the rows as stored, and the batch is committed when both are there,
    so a run cut short before that has stored nothing as far as readers know.  A repeat of
    the same ``batch`` of a ``run`` does not see its own rows as prior ones and
    replaces both its rows and its alerts, also by none, so a run cut short can
    simply be repeated.  ``moment`` (microseconds) tells its place among all runs.
    """
    spark = scored.sparkSession
    prior = _prior(spark, scored_path, since, batch, run, moment)
    left = scored if prior is None else drop_already_alerted(scored, prior)
    attempt = write_attempt(left, scored_path, batch, run, moment)
    stored = read_attempts(spark, scored_path, [attempt]).select(*SCORED.names)
    writer = alert_messages(stored, threshold).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").parquet(batch_path(alerts_path, batch, run))
    commit(spark, scored_path, attempt)
    return not stored.isEmpty()


def _prior(
    spark: SparkSession, path: str, since: dt.date | None, batch: int, run: str, moment: int | None
) -> DataFrame | None:
    """What earlier batches stored; None before the first one."""
    if not committed(spark, path) and not head(spark, path).version:
        return None
    return read_scored(spark, path, since, batch, run, moment)
