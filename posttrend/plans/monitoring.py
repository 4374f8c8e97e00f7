"""How the alerts of the last days fared against the hot feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posttrend.functions.columns import utc_date
from posttrend.operators.monitor import hot_max_score, monitor_labels, precision_recall_by
from posttrend.operators.scans import scored_between


def recent_labels(
    scored: DataFrame,
    hot: DataFrame,
    as_of: dt.datetime,
    back: dt.timedelta = dt.timedelta(days=2),
    lag: dt.timedelta = dt.timedelta(hours=6),
    cutoff: int = 10000,
) -> DataFrame:
    """Labels of the posts created from ``as_of - back`` to ``as_of - lag``; the lag lets posts climb.

    A post seen hot in that time keeps the best score of its whole hot history.
    """
    days = F.col("loadDateUTC").between(F.lit(utc_date(as_of - back)), F.lit(utc_date(as_of)))
    window = scored_between(scored, as_of - back, as_of - lag)
    return monitor_labels(window, hot_max_score(hot, days), cutoff)


def report(scored: DataFrame, hot: DataFrame, as_of: dt.datetime, **options) -> DataFrame:
    return precision_recall_by(recent_labels(scored, hot, as_of, **options))
