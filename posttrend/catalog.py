"""Every registered query over the given tables, by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posttrend.functions import map_value_sum, utc
from posttrend.operators import evaluate as ev
from posttrend.operators import explore, features, intake, merge, models, monitor, scans, scoring, sketches, splits
from posttrend.plans import collect, live, modeling, monitoring, training
from posttrend.schema import FEATURES, LANDED, LINEAR_FEATURES, SNAPSHOT, TREE_FEATURES, feature_columns
from posttrend.session import cut_lineage, fresh_path
from posttrend.sources import registry, tables
from posttrend.sources.events import (
    EVENTS,
    event_listing,
    event_snapshots,
    hot_snapshots,
    labelled_posts,
    proxy_scored,
    read_events,
    zoned,
)
from posttrend.sources.files import Files
from posttrend.sources.scored import compact, read_scored
from posttrend.streaming import collect as stream_collect
from posttrend.streaming import late
from posttrend.streaming.features import latest_rows, stream_snapshots
from posttrend.streaming.scoring import run_scoring, write_feature_updates, write_updates

Query = Callable[[SparkSession, str], DataFrame]

THRESHOLD = 0.6
AS_OF = dt.datetime(2024, 1, 30, 23, 0, 0)
MONITOR_AS_OF = dt.datetime(2024, 1, 25, 0, 0, 0)
CUTS = [dt.datetime(2024, 1, 5, 0, 40), dt.datetime(2024, 1, 11, 12, 30), dt.datetime(2024, 1, 17, 0, 20), dt.datetime(2024, 1, 23, 18, 45)]
NEW_FROM = dt.datetime(2024, 1, 15)
PRIOR_BEFORE = dt.datetime(2024, 1, 20)
HOT_CUTOFF = 2000
LOW_SCORE = 100
QUANTILES = [0.95, 0.97, 0.975, 0.98, 0.99]
# What the two searches go through.
C_VALUES = [1.0, 0.5, 0.25, 0.1, 0.01, 0.001, 0.0001, 0.00001]
TREE_GRID = {
    "n_estimators": [50, 100, 150],
    "learning_rate": [0.1, 0.01, 0.001],
    "min_samples_leaf": [1, 3, 5, 7],
    "max_depth": [2, 3, 4],
}
# Thresholds of the written-down stumps that stand in for fitted trees in ``cv_summary_trees``.
STUMP_THRESHOLDS = dict(zip(TREE_FEATURES, [300.0, 8.0, 8.0, 0.2, 0.1, 0.1]))
WEIGHTS = {
    "maxScore21_40m": 0.0004,
    "maxScore41_60m": 0.0011,
    "maxNumComments21_40m": 0.002,
    "maxNumComments41_60m": 0.004,
    "maxUpvoteRatio21_40m": 0.1,
    "maxUpvoteRatio41_60m": 0.25,
    "maxScoreGrowth21_40m41_60m": 0.05,
    "maxNumCommentsGrowth21_40m41_60m": 0.02,
    "time0006": -0.1,
    "time0612": 0.05,
    "time1800": 0.1,
}
INTERCEPT = -3.0
EXPLORED = ["timeElapsedMin", *feature_columns()]
# The first fitting part of a name decides.
_WIDTHS = {"Elapsed": 5.0, "Growth": 0.5, "Ratio": 0.25, "Gildings": 1.0, "Comments": 10.0, "Score": 100.0}
HIST_WIDTHS = {c: next(w for part, w in _WIDTHS.items() if part in c) for c in EXPLORED}

QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types that compare across engines: zone-less timestamps, dates as text, no 32-bit floats."""
    casts = {T.TimestampType: "timestamp_ntz", T.DateType: "string", T.FloatType: "double"}
    fields = df.schema.fields
    if not any(type(f.dataType) in casts for f in fields):
        return df
    return df.selectExpr(
        *[
            f"cast(`{f.name}` AS {casts[type(f.dataType)]}) AS `{f.name}`" if type(f.dataType) in casts else f"`{f.name}`"
            for f in fields
        ]
    )


def query(name: str):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return register


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.expr(f"round(`{n}`, 6)") for n in names})


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_snapshots(read_events(spark, sf_dir))


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_listing(read_events(spark, sf_dir))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.post_features(snapshots(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_posts(snapshots(spark, sf_dir))


def proxied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxy_scored(labelled(spark, sf_dir), THRESHOLD)


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled, labelled rows with time features: what models are fitted on."""
    return features.time_features(features.fill_features(labelled(spark, sf_dir)))


def prior_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = posts(spark, sf_dir)
    prior = proxy_scored(rows.where(F.col("createdTSUTC") < utc(PRIOR_BEFORE)), THRESHOLD, "first")
    new = proxy_scored(rows.where(F.col("createdTSUTC") >= utc(NEW_FROM)), THRESHOLD, "second")
    return prior, new


# ---------------------------------------------------------------- intake


@query("snapshot_normalize")
def _(spark, sf_dir):
    rows = listing(spark, sf_dir)
    return intake.normalize_listing(rows, "rising", collect.FEED_DEPTH["rising"]).unionByName(
        intake.normalize_listing(rows, "hot", collect.FEED_DEPTH["hot"])
    )


@query("collect_feed")
def _(spark, sf_dir):
    return collect.feed_snapshots(listing(spark, sf_dir), "hot")


@query("snapshot_age")
def _(spark, sf_dir):
    aged = intake.with_age(listing(spark, sf_dir), F.col("fetched_at"), F.col("created_utc"))
    return aged.select("id", "timeElapsedMin", "ageDays")


@query("map_value_sum")
def _(spark, sf_dir):
    return listing(spark, sf_dir).select("id", map_value_sum(F.col("gildings")).alias("numGildings"))


@query("load_columns")
def _(spark, sf_dir):
    rows = intake.with_load_columns(read_events(spark, sf_dir), F.col("ts"))
    return rows.select("event_id", "loadTSUTC", "loadDateUTC", "loadTimeUTC")


def _landed(spark, sf_dir):
    """Snapshots as text; a score now and then is unreadable."""
    rows = snapshots(spark, sf_dir)
    text = {
        "loadDateUTC": F.date_format("loadDateUTC", "yyyy-MM-dd"),
        "loadTSUTC": F.date_format("loadTSUTC", "yyyy-MM-dd HH:mm:ss"),
        "createdTSUTC": F.date_format("createdTSUTC", "yyyy-MM-dd HH:mm:ss"),
        "score": F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("score").cast("string")),
    }
    return rows.select(*[text.get(c, F.col(c).cast("string")).alias(c) for c in LANDED.names])


@query("typed_snapshots")
def _(spark, sf_dir):
    # A 32-bit ratio prints more digits than the text it came from.
    return rounded(intake.typed_snapshots(_landed(spark, sf_dir)), "upvoteRatio").withColumn(
        "upvoteRatio", F.round(F.col("upvoteRatio").cast("double"), 6)
    )


@query("rejected_snapshots")
def _(spark, sf_dir):
    return intake.rejected_snapshots(_landed(spark, sf_dir)).select("postId", "loadTSUTC", "score", "badColumns")


@query("dedupe_latest")
def _(spark, sf_dir):
    rows = intake.dedupe_latest(snapshots(spark, sf_dir), ["postId"], "loadTSUTC", ["event_id"])
    return rows.select("postId", "loadTSUTC", "event_id", "score")


@query("topn_per_feed")
def _(spark, sf_dir):
    rows = intake.top_n_per_feed(listing(spark, sf_dir), ["view", "subreddit", "fetched_at"], "rank", 2)
    return rows.select("view", "subreddit", "fetched_at", "rank", "id")


@query("stale_rows")
def _(spark, sf_dir):
    rows = intake.normalize_listing(listing(spark, sf_dir), "hot")
    return intake.stale_rows(rows).select("postId", "loadTSUTC", "createdTSUTC")


# ---------------------------------------------------------------- scans


@query("ids_by_date")
def _(spark, sf_dir):
    return scans.ids_on_dates(snapshots(spark, sf_dir), "2024-01-10")


@query("ids_by_date_range")
def _(spark, sf_dir):
    days = scans.days_until(dt.date(2024, 1, 10), dt.date(2024, 1, 14))
    return scans.ids_on_dates(snapshots(spark, sf_dir), days)


@query("date_spine")
def _(spark, sf_dir):
    loads = snapshots(spark, sf_dir)
    return scans.date_spine(loads.agg(F.min("loadDateUTC").alias("start"), F.max("loadDateUTC").alias("end")))


@query("recent_ids")
def _(spark, sf_dir):
    return scans.recent_ids(snapshots(spark, sf_dir), AS_OF)


@query("recent_ids_aged")
def _(spark, sf_dir):
    window = dt.timedelta(hours=6)
    return scans.recent_ids(snapshots(spark, sf_dir), AS_OF, window, extra=F.col("timeElapsedMin") >= 45)


@query("recent_ids_same_day")
def _(spark, sf_dir):
    midnight = dt.datetime(2024, 1, 20, 0, 5)
    return scans.recent_ids(snapshots(spark, sf_dir), midnight, dt.timedelta(hours=1), same_day_only=True)


@query("distinct_ids")
def _(spark, sf_dir):
    return scans.distinct_ids(snapshots(spark, sf_dir))


@query("history_for_ids")
def _(spark, sf_dir):
    rows = snapshots(spark, sf_dir)
    ids = scans.ids_on_dates(hot_snapshots(rows), scans.days_until(dt.date(2024, 1, 5), dt.date(2024, 1, 12)))
    return scans.history_for(rows, ids).select("event_id", "postId", "loadTSUTC", "score")


@query("scored_window")
def _(spark, sf_dir):
    scored = proxy_scored(posts(spark, sf_dir), THRESHOLD)
    lo, hi = MONITOR_AS_OF - dt.timedelta(days=2), MONITOR_AS_OF - dt.timedelta(hours=6)
    return scans.scored_between(scored, lo, hi).select("postId", "createdTSUTC", "predict_proba_1", "stepUp")


# ---------------------------------------------------------------- features and labels


@query("post_features")
def _(spark, sf_dir):
    return posts(spark, sf_dir)


@query("features_filled")
def _(spark, sf_dir):
    return features.fill_features(posts(spark, sf_dir))


@query("labelled_features")
def _(spark, sf_dir):
    return labelled(spark, sf_dir)


@query("training_days")
def _(spark, sf_dir):
    rows = snapshots(spark, sf_dir)
    return training.training_table(rows, hot_snapshots(rows), dt.date(2024, 1, 8), dt.date(2024, 1, 20))


@query("time_features")
def _(spark, sf_dir):
    rows = features.time_features(posts(spark, sf_dir).select("postId", "createdTSUTC"))
    return rows


@query("random_control")
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    rate = rows.select(F.avg("target")).scalar()
    return features.random_control(rows, "postId", rate).select("postId", "randomVar")


# ---------------------------------------------------------------- scoring and tables


@query("score_posts")
def _(spark, sf_dir):
    rows = features.time_features(features.fill_features(posts(spark, sf_dir)))
    scored = scoring.mark_step_up(scoring.score_linear(rows, WEIGHTS, INTERCEPT), 0.3)
    scored = scoring.with_model_name(scored, "fixed_weights")
    return rounded(scored.select("postId", "modelName", "predict_proba_1", "stepUp"), "predict_proba_1")


@query("unseen_alerts")
def _(spark, sf_dir):
    prior, new = prior_and_new(spark, sf_dir)
    return scoring.drop_already_alerted(new, prior).select("postId", "predict_proba_1", "stepUp")


@query("alert_messages")
def _(spark, sf_dir):
    return scoring.alert_messages(proxy_scored(features.fill_features(posts(spark, sf_dir)), THRESHOLD), THRESHOLD)


@query("live_features_long")
def _(spark, sf_dir):
    rows = live.live_features(snapshots(spark, sf_dir), AS_OF, dt.timedelta(days=3))
    return rows.select("postId", "timeElapsedMin", *[c for c in FEATURES.names if c.startswith("maxScore") and "Growth" not in c])


@query("live_scoring")
def _(spark, sf_dir):
    rows = live.live_features(snapshots(spark, sf_dir), AS_OF, dt.timedelta(hours=3))
    scorer = lambda df: scoring.score_linear(features.time_features(df), WEIGHTS, INTERCEPT)
    scored = live.score_batch(rows, scorer, "fixed_weights", 0.3)
    return rounded(scored, "predict_proba_1")


@query("snapshot_upsert")
def _(spark, sf_dir):
    rows = snapshots(spark, sf_dir).select("event_id", "postId", "loadTSUTC", "score", "numComments")
    key = ["postId", "loadTSUTC"]
    half = lambda n: intake.dedupe_latest(rows.where(F.col("event_id") % 2 == n), key, "event_id")
    return merge.upsert(half(0), half(1), key, unique=True)


def _stored_halves(spark, sf_dir):
    """The snapshots of even events stored, then those of odd ones put over them, in two writes by time of day."""
    rows = snapshots(spark, sf_dir)
    table = tables.snapshot_table(spark, fresh_path(spark, "snapshot-table"))
    table.put(rows.where("event_id % 2 = 0"), "event_id")
    odd = rows.where("event_id % 2 = 1")
    table.put(odd.where("hour(loadTSUTC) < 12"), "event_id")
    table.put(odd.where("hour(loadTSUTC) >= 12"), "event_id")
    return table


def _same_twice(table):
    """The rows as a fresh reader sees them, and again after old versions are gone."""
    before = table.read()
    counted = before.count()
    table.clean(keep=1)
    after = tables.snapshot_table(table.spark, table.path).read()
    if after.count() != counted:
        raise RuntimeError("cleaning changed the newest version")
    return after.withColumn("upvoteRatio", F.round(F.col("upvoteRatio").cast("double"), 6))


@query("table_merge")
def _(spark, sf_dir):
    return _same_twice(_stored_halves(spark, sf_dir))


@query("table_delete")
def _(spark, sf_dir):
    table = _stored_halves(spark, sf_dir)
    table.delete(table.read().where(f"score < {LOW_SCORE}").select("postId", "loadTSUTC", "loadDateUTC"))
    return _same_twice(table)


@query("upsert_scored")
def _(spark, sf_dir):
    prior, new = prior_and_new(spark, sf_dir)
    return merge.upsert(prior, new, ["postId"], unique=True).select("postId", "modelName", "predict_proba_1", "stepUp")


@query("upsert_composite")
def _(spark, sf_dir):
    prior, new = prior_and_new(spark, sf_dir)
    columns = ["subreddit", "createdTSUTC", "modelName", "timeElapsedMin"]
    # The new side lacks the age, so updated rows keep the one they have.
    return merge.upsert(prior.select(*columns), new.select(*columns[:-1]), columns[:2], unique=True)


@query("upsert_empty_target")
def _(spark, sf_dir):
    rows = posts(spark, sf_dir)
    return merge.upsert(merge.empty_like(spark, rows.schema), rows, ["postId"], unique=True)


@query("purge_stale")
def _(spark, sf_dir):
    rows = intake.normalize_listing(listing(spark, sf_dir), "hot")
    kept = merge.delete_by_key(rows, intake.stale_rows(rows), ["postId", "loadTSUTC"])
    return kept.select("postId", "loadTSUTC", "createdTSUTC", "score")


@query("evolve_schema")
def _(spark, sf_dir):
    rows = posts(spark, sf_dir).select("postId", "timeElapsedMin")
    return merge.ensure_columns(rows, {"timeElapsedMin": "int", "reviewer": "string", "reviewScore": "double"})


@query("union_all")
def _(spark, sf_dir):
    rows = snapshots(spark, sf_dir).select("event_id", "postId", "score")
    return merge.union_all([rows.where(F.col("event_id") % 3 == n) for n in range(3)], spark, rows.schema)


@query("flatten_items")
def _(spark, sf_dir):
    nested = F.array(F.array("postId", "subreddit"), F.array("title"))
    return merge.flatten_items(snapshots(spark, sf_dir).select("event_id", nested.alias("parts")), "parts")


@query("latest_model")
def _(spark, sf_dir):
    stamp = F.date_format("loadTSUTC", "yyyyMMdd-HHmmss")
    names = snapshots(spark, sf_dir).select(F.concat(F.lit(registry.PREFIX), stamp, F.lit("_"), "subreddit").alias("name"))
    return registry.latest_name(names)


# ---------------------------------------------------------------- monitoring


@query("hot_max_score")
def _(spark, sf_dir):
    return monitor.hot_max_score(hot_snapshots(snapshots(spark, sf_dir)))


def _labels(spark, sf_dir):
    rows = snapshots(spark, sf_dir)
    scored = proxy_scored(features.post_features(rows), THRESHOLD)
    scored = scans.scored_between(scored, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 25))
    return monitor.monitor_labels(scored, monitor.hot_max_score(hot_snapshots(rows)), HOT_CUTOFF)


@query("monitor_labels")
def _(spark, sf_dir):
    return _labels(spark, sf_dir)


@query("monitor_counts")
def _(spark, sf_dir):
    return monitor.label_counts(_labels(spark, sf_dir))


RATES = [f"{m}_{label}" for label in ("hotPost", "hotPost10k") for m in ("recall", "precision")]


@query("monitor_metrics")
def _(spark, sf_dir):
    return rounded(monitor.ranked_metrics(monitor.precision_recall_by(_labels(spark, sf_dir))), *RATES)


@query("monitor_long")
def _(spark, sf_dir):
    metrics = monitor.precision_recall_by(_labels(spark, sf_dir))
    both = monitor.metrics_long(metrics, "hotPost").unionByName(monitor.metrics_long(metrics, "hotPost10k"))
    return rounded(both, "value")


@query("monitoring_report")
def _(spark, sf_dir):
    rows = snapshots(spark, sf_dir)
    scored = proxy_scored(features.post_features(rows), THRESHOLD)
    return rounded(monitoring.report(scored, hot_snapshots(rows), MONITOR_AS_OF, cutoff=HOT_CUTOFF), *RATES)


# ---------------------------------------------------------------- exploration


@query("describe_by_target")
def _(spark, sf_dir):
    rows = features.fill_features(labelled(spark, sf_dir))
    return rounded(
        explore.describe_by(rows, "target", EXPLORED), "mean", "std", "min", "p25", "p50", "p75", "max"
    )


@query("rate_by_hour")
def _(spark, sf_dir):
    return rounded(explore.rate_by(labelled(spark, sf_dir), F.hour("createdTSUTC"), "hour"), "rate")


@query("rate_by_weekday")
def _(spark, sf_dir):
    return rounded(explore.rate_by(labelled(spark, sf_dir), F.weekday("createdTSUTC"), "dayofweek"), "rate")


@query("hist_hour")
def _(spark, sf_dir):
    return explore.hist(posts(spark, sf_dir), F.hour("createdTSUTC"), 1, "hour")


@query("hist_minute_block")
def _(spark, sf_dir):
    # Creation falls on the full hour here, so the load time shows the blocks.
    return explore.hist(snapshots(spark, sf_dir), explore.minute_of_day(F.col("loadTSUTC")), 15, "minute")


@query("feature_hist_by_target")
def _(spark, sf_dir):
    rows = features.fill_features(labelled(spark, sf_dir))
    return rounded(explore.feature_hist_by(rows, "target", HIST_WIDTHS), "share")


@query("base_rate")
def _(spark, sf_dir):
    return rounded(explore.base_rate(labelled(spark, sf_dir)), "rate")


# ---------------------------------------------------------------- evaluation


@query("score_quantiles")
def _(spark, sf_dir):
    return rounded(ev.quantiles(proxied(spark, sf_dir), "predict_proba_1", QUANTILES), "value")


@query("score_quantiles_sketch")
def _(spark, sf_dir):
    """Thresholds from sketches stored per creation day, beside the exact ones, and whether they are as close as stated."""
    scored = proxied(spark, sf_dir).select(F.to_date("createdTSUTC").alias("day"), "predict_proba_1")
    path = fresh_path(spark, "score-sketches")
    middle = F.col("day") < F.lit(dt.date(2024, 1, 16))
    # The second half comes on its own, then the first half and one of the days again.
    for part in (~middle, middle, F.col("day") == F.lit(dt.date(2024, 1, 20))):
        sketches.store_sketches(sketches.day_sketches(scored.where(part), "predict_proba_1", "day"), path)
    near = sketches.sketched_quantiles(sketches.read_sketches(spark, path), QUANTILES)
    exact = ev.quantiles(scored, "predict_proba_1", QUANTILES)
    checked = sketches.with_rank_check(near, scored, "predict_proba_1").join(exact.withColumnRenamed("value", "exact"), "q")
    return rounded(checked.select("q", "exact", "n", "within"), "exact")


@query("pr_at_quantiles")
def _(spark, sf_dir):
    rows = ev.pr_at_quantiles(proxied(spark, sf_dir), "predict_proba_1", "target")
    return rounded(rows, "threshold", "precision", "recall")


@query("top2pct_metrics")
def _(spark, sf_dir):
    rows = ev.top_share_metrics(proxied(spark, sf_dir), "predict_proba_1", "target")
    return rounded(rows, "threshold", "precision", "recall")


@query("pr_curve")
def _(spark, sf_dir):
    return rounded(ev.pr_curve(proxied(spark, sf_dir), "predict_proba_1", "target"), "threshold", "precision", "recall")


@query("aucpr")
def _(spark, sf_dir):
    return rounded(ev.auc_pr(proxied(spark, sf_dir), "predict_proba_1", "target"), "aucpr")


@query("aucpr_top5")
def _(spark, sf_dir):
    return rounded(ev.auc_pr(proxied(spark, sf_dir), "predict_proba_1", "target", min_quantile=0.95), "aucpr")


@query("aucpr_by_feed")
def _(spark, sf_dir):
    rows = ev.auc_pr(proxied(spark, sf_dir), "predict_proba_1", "target", min_quantile=0.5, by=["subreddit"])
    return rounded(rows, "aucpr")


@query("pr_at_threshold")
def _(spark, sf_dir):
    return rounded(ev.pr_at_threshold(proxied(spark, sf_dir), "predict_proba_1", "target", THRESHOLD), "recall", "precision")


@query("top10_predictions")
def _(spark, sf_dir):
    return ev.top_predictions(proxied(spark, sf_dir), "predict_proba_1", "target")


@query("review_list")
def _(spark, sf_dir):
    rows = ev.review_list(proxied(spark, sf_dir), "predict_proba_1", "target", THRESHOLD, TREE_FEATURES)
    return ev.review_order(rows)


@query("stratified_split")
def _(spark, sf_dir):
    return splits.stratified_splits(labelled(spark, sf_dir).select("postId", "target"), "target", "postId")


# ---------------------------------------------------------------- models


@query("holdout_metrics")
def _(spark, sf_dir):
    """The fixed weights on the rows that the first split leaves out."""
    rows = train_rows(spark, sf_dir)
    folds = splits.stored_folds(rows, "target", "postId", n=1)
    metrics = modeling.holdout_metrics(scoring.score_linear(folds.test(0), WEIGHTS, INTERCEPT))
    return rounded(metrics, *metrics.columns)


@query("linear_attribution")
def _(spark, sf_dir):
    return rounded(models.linear_attribution(train_rows(spark, sf_dir), WEIGHTS), "mean_abs", "max_abs")


def _stored_train_rows(spark, sf_dir):
    return cut_lineage(train_rows(spark, sf_dir))


@query("train_lr")
def _(spark, sf_dir):
    rows = _stored_train_rows(spark, sf_dir)
    model = models.fit_lr(rows, LINEAR_FEATURES)
    return models.score_model(rows, model).select("postId", "target", "predict_proba_1")


@query("coef_table")
def _(spark, sf_dir):
    return models.coef_table(spark, models.fit_lr(_stored_train_rows(spark, sf_dir), LINEAR_FEATURES))


@query("lr_gradient")
def _(spark, sf_dir):
    pulls = models.lr_gradient(train_rows(spark, sf_dir), WEIGHTS, INTERCEPT)
    return pulls.select("feature", F.round("gradient", 4).alias("gradient"), F.round("share", 6).alias("share"))


@query("train_gbt")
def _(spark, sf_dir):
    rows = _stored_train_rows(spark, sf_dir)
    model = models.fit_gbt(rows, TREE_FEATURES)
    return models.score_model(rows, model).select("postId", "target", "predict_proba_1")


@query("feature_importance")
def _(spark, sf_dir):
    return models.feature_importance(spark, models.fit_gbt(_stored_train_rows(spark, sf_dir), TREE_FEATURES))


FLAGS = ["time0006", "time0612", "time1218", "time1800", "sunday"]


@query("split_gains")
def _(spark, sf_dir):
    gains = models.split_gains(train_rows(spark, sf_dir), FLAGS)
    return rounded(gains, "below", "above", "gain")


def _stump(rows):
    return models.fit_gbt(rows, FLAGS, n_estimators=1, max_depth=1)


@query("train_stump")
def _(spark, sf_dir):
    rows = _stored_train_rows(spark, sf_dir)
    return rounded(models.score_model(rows, _stump(rows)).select("postId", "target", "predict_proba_1"), "predict_proba_1")


@query("stump_importance")
def _(spark, sf_dir):
    return rounded(models.feature_importance(spark, _stump(_stored_train_rows(spark, sf_dir))), "featureImportance")


@query("cv_summary")
def _(spark, sf_dir):
    rows = train_rows(spark, sf_dir).select("postId", "target", *LINEAR_FEATURES)
    folds = splits.stored_folds(rows, "target", "postId")
    fitter = models.ml_fitter(lambda params, n: models.logistic_stage(n, params["C"]), LINEAR_FEATURES)
    results = models.grid_search(folds, fitter, {"C": C_VALUES})
    return models.leaderboard(models.cv_summary(results, ["C"]), ["C"], n=len(C_VALUES))


def _fixed_trees(rows, params, n):
    """In place of a fit, stumps that are written down: one after the other takes the next feature, and after each
    round of all features the next of ``max_depth`` thresholds."""

    def score(df: DataFrame, trees: int) -> DataFrame:
        votes = " + ".join(
            f"if({name} > {STUMP_THRESHOLDS[name] * (level + 1)!r}D + {params['min_samples_leaf']}, {count}, -{count})"
            for (name, level), count in fixed_votes(params["max_depth"], trees).items()
        )
        return df.selectExpr("*", f"1 / (1 + exp(-2 * {params['learning_rate']!r}D * ({votes}))) AS predict_proba_1")

    return score


def fixed_votes(depth: int, trees: int) -> dict[tuple[str, int], int]:
    """How many of the first ``trees`` stumps look at each feature and threshold."""
    votes: dict[tuple[str, int], int] = {}
    for i in range(trees):
        place = (TREE_FEATURES[i % len(TREE_FEATURES)], i // len(TREE_FEATURES) % depth)
        votes[place] = votes.get(place, 0) + 1
    return votes


@query("cv_summary_trees")
def _(spark, sf_dir):
    rows = train_rows(spark, sf_dir).select("postId", "target", *TREE_FEATURES)
    folds = splits.stored_folds(rows, "target", "postId")
    results = models.grid_search(folds, _fixed_trees, TREE_GRID, staged="n_estimators")
    measures = [f"{kind}_{m}" for m in models.MEASURES for kind in ("mean", "std")]
    return rounded(models.cv_summary(results, list(TREE_GRID)), *measures)


# ---------------------------------------------------------------- streams


def _event_stream(spark, sf_dir):
    events = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events*.parquet")
    return event_snapshots(zoned(events))


@query("stream_snapshots")
def _(spark, sf_dir):
    """Snapshots written to a folder, picked up again as a stream and appended to another."""
    source, sink, state = (fresh_path(spark, f"snapshots-{part}") for part in ("in", "out", "state"))
    snapshots(spark, sf_dir).select(*[F.col(f.name).cast(f.dataType) for f in SNAPSHOT.fields]).write.parquet(source)
    writer = stream_snapshots(spark, source).writeStream.format("parquet").outputMode("append")
    writer.option("path", sink).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(SNAPSHOT).parquet(sink)
    return rows.withColumn("upvoteRatio", F.round(F.col("upvoteRatio").cast("double"), 6))


@query("stream_features")
def _(spark, sf_dir):
    sink, state = fresh_path(spark, "features-out"), fresh_path(spark, "features-state")
    write_feature_updates(_event_stream(spark, sf_dir), sink, state, cadence=None).awaitTermination()
    rows = spark.read.parquet(sink)
    return intake.dedupe_latest(rows, ["postId", "title"], "batch").select(*FEATURES.names)


def _slices(events: DataFrame) -> list[DataFrame]:
    """The events before, between and after the cuts, which fall into the hours of posts."""
    at, ends = F.col("ts"), [None, *[utc(c) for c in CUTS], None]
    return [
        events.where((F.lit(True) if a is None else at >= a) & (F.lit(True) if b is None else at < b))
        for a, b in zip(ends, ends[1:])
    ]


def _streamed(spark, slices: list[DataFrame], start) -> None:
    """Land the slices one after the other; after each, ``start`` goes on with the stream until all is worked off."""
    folder = fresh_path(spark, "events-in")
    for part in slices:
        # The log's times have no zone, as ``zoned`` expects.
        part.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.mode("append").parquet(folder)
        start(zoned(spark.readStream.schema(EVENTS).parquet(folder))).awaitTermination()


@query("stream_dedupe")
def _(spark, sf_dir):
    """The newest snapshot of each post, over a stream that is cut within the hours of posts."""
    sink, state = fresh_path(spark, "newest-out"), fresh_path(spark, "newest-state")

    def start(events):
        rows = latest_rows(event_snapshots(events), ["loadTSUTC", "event_id"])
        return write_updates(rows.select("postId", "loadTSUTC", "event_id", "score"), sink, state, cadence=None)

    _streamed(spark, _slices(read_events(spark, sf_dir)), start)
    rows = spark.read.parquet(sink)
    return intake.dedupe_latest(rows, ["postId"], "batch").select("postId", "loadTSUTC", "event_id", "score")


@query("stream_features_sliced")
def _(spark, sf_dir):
    """The features again, with posts that are cut by the slices: state and watermark go from batch to batch."""
    sink, state = fresh_path(spark, "sliced-out"), fresh_path(spark, "sliced-state")
    start = lambda events: write_feature_updates(event_snapshots(events), sink, state, cadence=None)
    _streamed(spark, _slices(read_events(spark, sf_dir)), start)
    return intake.dedupe_latest(spark.read.parquet(sink), ["postId", "title"], "batch").select(*FEATURES.names)


@query("stream_late")
def _(spark, sf_dir):
    """Every fiftieth event lands a slice late; each event once, with the side it went to."""
    events = read_events(spark, sf_dir)
    parts = _slices(events)
    held = F.col("event_id") % 50 == 0
    none = events.where(F.lit(False))
    mixed = [now.where(~held).unionByName(before.where(held)) for now, before in zip([*parts, none], [none, *parts])]
    out, state = fresh_path(spark, "late-out"), fresh_path(spark, "late-state")
    _streamed(spark, mixed, lambda rows: late.split_late(event_snapshots(rows), out, state, cadence=None))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("createdTSUTC", T.TimestampType())])
    sides = [late.read_side(spark, out, side, schema).withColumn("side", F.lit(side)) for side in ("kept", "late")]
    both = sides[0].unionByName(sides[1])
    told = late.marks(spark, out)
    counted = {r["side"]: r["count"] for r in both.groupBy("side").count().collect()}
    if any(sum(m[side] for m in told) != counted.get(side, 0) for side in ("kept", "late")):
        raise RuntimeError("the batches' counts do not add up")
    return both


@query("stream_collect")
def _(spark, sf_dir):
    """Fetches that land in three parts each, ranked as a whole in the end."""
    paths = {"hot": fresh_path(spark, "collect-hot")}
    items, state = fresh_path(spark, "collect-items"), fresh_path(spark, "collect-state")

    def start(events):
        return stream_collect.run_collect(event_listing(events), paths, state, cadence=None, items=items)

    events = read_events(spark, sf_dir)
    _streamed(spark, [events.where(F.col("event_id") % 5 % 3 == n) for n in range(3)], start)
    return tables.read_snapshots(spark, paths["hot"]).withColumn("upvoteRatio", F.round(F.col("upvoteRatio").cast("double"), 6))


@query("stream_scoring_replay")
def _(spark, sf_dir):
    """Scoring over several batches, the last of them repeated, all of it again on a new checkpoint, then folded."""
    paths = {part: fresh_path(spark, f"replay-{part}") for part in ("scored", "alerts", "checkpoint")}
    scorer = lambda df: scoring.score_linear(features.time_features(df), WEIGHTS, INTERCEPT)
    folders = []

    def start(events, paths=paths):
        folders.append(events)
        return run_scoring(event_snapshots(events), scorer, "fixed_weights", 0.3, paths, cadence=None)

    _streamed(spark, _slices(read_events(spark, sf_dir)), start)
    # A driver that dies between storing a batch and noting it in the checkpoint repeats that batch.
    files, commits = Files(spark, paths["checkpoint"]), f"{paths['checkpoint']}/commits"
    files.delete(f"{commits}/{max((n for n in files.names(commits) if n.isdigit()), key=int)}")
    start(folders[-1]).awaitTermination()
    start(folders[-1], {**paths, "checkpoint": fresh_path(spark, "replay-again")}).awaitTermination()
    compact(spark, paths["scored"])
    alerts = spark.read.parquet(paths["alerts"]).groupBy("postId").agg(F.count("*").alias("alerts"))
    rows = read_scored(spark, paths["scored"]).join(alerts, "postId", "left")
    return rounded(rows.select("postId", "predict_proba_1", "stepUp", F.coalesce("alerts", F.lit(0)).alias("alerts")), "predict_proba_1")


@query("stream_scoring")
def _(spark, sf_dir):
    paths = {part: fresh_path(spark, f"scoring-{part}") for part in ("scored", "alerts", "checkpoint")}
    scorer = lambda df: scoring.score_linear(features.time_features(df), WEIGHTS, INTERCEPT)
    query_ = run_scoring(_event_stream(spark, sf_dir), scorer, "fixed_weights", 0.3, paths, cadence=None)
    query_.awaitTermination()
    return spark.read.parquet(paths["alerts"]).select("postId", "message", "footer")
