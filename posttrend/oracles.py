"""The registered queries as plain SQL over the event table, for an independent check."""

from __future__ import annotations

from posttrend.catalog import (
    CUTS, EXPLORED, FLAGS, HIST_WIDTHS, INTERCEPT, LOW_SCORE, QUANTILES, RATES, STUMP_THRESHOLDS, TREE_GRID, WEIGHTS, fixed_votes,
)
from posttrend.operators.evaluate import TOP_QUANTILES
from posttrend.schema import METRICS, TREE_FEATURES, bucket_labels, feature_columns, feature_name, growth_name

# Common table expressions, each naming the ones it needs.
CTES: dict[str, tuple[tuple[str, ...], str]] = {}

CTES["snap"] = (
    (),
    """
    SELECT event_id, ts::date AS "loadDateUTC", strftime(ts, '%H:%M:%S') AS "loadTimeUTC",
           date_trunc('second', ts) AS "loadTSUTC",
           concat_ws('-', event_type, strftime(ts, '%Y%m%d%H')) AS "postId",
           event_type AS subreddit, (user_id * 1000)::int AS subscribers, user_id::int AS "activeUsers",
           'post ' || event_type AS title, date_trunc('hour', ts) AS "createdTSUTC",
           minute(ts)::int AS "timeElapsedMin", floor(value * 10)::int AS score,
           json_extract_string(props, '$.k')::int AS "numComments",
           (user_id % 100) / 100.0::double AS "upvoteRatio", (event_id % 3)::int AS "numGildings"
    FROM events""",
)
CTES["hot"] = (
    ("snap",),
    """
    SELECT * FROM snap
    QUALIFY row_number() OVER (PARTITION BY subreddit, "createdTSUTC"::date
                               ORDER BY score DESC, "postId", event_id) <= 3""",
)


def _bucket(metric: str, low: int | None, high: int, label: str) -> str:
    inside = f'"timeElapsedMin" <= {high}' if low is None else f'"timeElapsedMin" BETWEEN {low} AND {high}'
    return f'max(CASE WHEN {inside} THEN "{metric}" END) AS "{feature_name(metric, label)}"'


_LABELS = bucket_labels()
_MAXIMA = ",\n           ".join(_bucket(m, *b) for m in METRICS for b in _LABELS)


def _growth(metric: str) -> str:
    early, late = feature_name(metric, _LABELS[1][2]), feature_name(metric, _LABELS[2][2])
    name = growth_name(metric, _LABELS[1][2], _LABELS[2][2])
    return f'("{late}" - "{early}")::double / nullif("{early}", 0) AS "{name}"'


def _features(source: str) -> str:
    return f"""
    SELECT *, {_growth("score")},
           {_growth("numComments")}
    FROM (SELECT "postId", subreddit, title, "createdTSUTC", max("timeElapsedMin") AS "timeElapsedMin",
           {_MAXIMA}
          FROM {source} GROUP BY ALL)"""


CTES["feat"] = (("snap",), _features("snap"))
CTES["lab"] = (
    ("feat", "hot"),
    """
    SELECT feat.*, CASE WHEN "postId" IN (SELECT "postId" FROM hot) THEN 1 ELSE 0 END AS target FROM feat""",
)
_FEATURES = feature_columns()
_FILL = ", ".join(f'coalesce("{c}", 0) AS "{c}"' for c in _FEATURES)
CTES["filled"] = (("lab",), f"""
    SELECT * REPLACE ({_FILL}) FROM lab""")
_EASTERN = "timezone('US/Eastern', timezone('UTC', \"createdTSUTC\"))"
CTES["timed"] = (
    ("filled",),
    f"""
    SELECT *, (h < 6)::int AS time0006, (h >= 6 AND h < 12)::int AS time0612, (h >= 12 AND h < 18)::int AS time1218,
           (h >= 18)::int AS time1800, (wd = 6)::int AS sunday
    FROM (SELECT *, hour({_EASTERN})::int AS h, (isodow({_EASTERN}) - 1)::int AS wd FROM filled)""",
)
_PROXY = 'coalesce("maxScore41_60m", 0)::double / (coalesce("maxScore41_60m", 0)::double + 500.0)'
CTES["px"] = (
    ("lab",),
    f"""
    SELECT *, p AS predict_proba_1, (p >= 0.6)::int AS "stepUp" FROM (SELECT *, {_PROXY} AS p FROM lab)""",
)
CTES["prior"] = (("px",), """
    SELECT *, 'first' AS "modelName" FROM px WHERE "createdTSUTC" < TIMESTAMP '2024-01-20'""")
CTES["incoming"] = (("px",), """
    SELECT *, 'second' AS "modelName" FROM px WHERE "createdTSUTC" >= TIMESTAMP '2024-01-15'""")
CTES["raw"] = (
    (),
    """
    SELECT event_type AS subreddit, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'rising' END AS view,
           event_id AS rank, event_id % 11 = 0 AS stickied,
           epoch(date_trunc('minute', ts)) - (user_id % 4) * 600
             - CASE WHEN event_id % 17 = 0 THEN 86400 ELSE 0 END AS created_utc,
           concat_ws('-', event_type, event_id::varchar) AS id, 'post ' || event_type AS title,
           floor(value * 10)::int AS score, json_extract_string(props, '$.k')::int AS num_comments,
           (user_id % 100) / 100.0::double AS upvote_ratio, (event_id % 3 + user_id % 2)::int AS gilded,
           (user_id * 1000)::int AS subscribers, user_id::int AS accounts_active,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS fetched_at
    FROM events""",
)
CTES["aged"] = (
    ("raw",),
    """
    SELECT *, floor((age - floor(age / 86400) * 86400) / 60)::int AS minutes, floor(age / 86400)::int AS days
    FROM (SELECT *, epoch(fetched_at) - created_utc AS age FROM raw)""",
)


def _normalized(view: str, n: int) -> str:
    young = "AND minutes <= 60 AND days <= 0" if view == "rising" else ""
    order = "OVER (PARTITION BY subreddit, fetched_at ORDER BY rank)"
    return f"""
    SELECT fetched_at::date AS "loadDateUTC", strftime(fetched_at, '%H:%M:%S') AS "loadTimeUTC",
           fetched_at AS "loadTSUTC", id AS "postId", subreddit, subscribers, accounts_active AS "activeUsers", title,
           epoch_ms((created_utc * 1000)::bigint) AS "createdTSUTC", minutes AS "timeElapsedMin", score,
           num_comments AS "numComments", upvote_ratio AS "upvoteRatio", gilded AS "numGildings"
    FROM (SELECT * FROM aged WHERE view = '{view}' QUALIFY row_number() {order} <= {n + 2})
    WHERE NOT stickied {young}
    QUALIFY row_number() {order} <= {n}"""


CTES["rising25"] = (("aged",), _normalized("rising", 25))
CTES["hot3"] = (("aged",), _normalized("hot", 3))
CTES["hot25"] = (("aged",), _normalized("hot", 25))
CTES["hotmax"] = (
    ("hot",),
    """
    SELECT "postId", subreddit AS "hotPostSubreddit", max(score) AS "hotPostMaxScore" FROM hot GROUP BY ALL""",
)


def _labels(scored: str, best: str) -> str:
    return f"""
    SELECT *, "stepUp" & "hotPost" AS "stepUpHotPost", "stepUp" & "hotPost10k" AS "stepUpHotPost10k"
    FROM (SELECT "postId", coalesce(subreddit, "hotPostSubreddit") AS "coalesceSubreddit", "hotPostMaxScore",
                 coalesce("stepUp", 0) AS "stepUp", ("hotPostMaxScore" IS NOT NULL)::int AS "hotPost",
                 coalesce("hotPostMaxScore" >= 2000, false)::int AS "hotPost10k"
          FROM (SELECT "postId", subreddit, "stepUp" FROM {scored}) FULL JOIN {best} USING ("postId"))"""


def _metrics(labels: str) -> str:
    return f"""
    SELECT *, round("stepUpHotPost"::double / nullif("hotPost", 0), 6) AS "recall_hotPost",
           round("stepUpHotPost"::double / nullif("stepUp", 0), 6) AS "precision_hotPost",
           round("stepUpHotPost10k"::double / nullif("hotPost10k", 0), 6) AS "recall_hotPost10k",
           round("stepUpHotPost10k"::double / nullif("stepUp", 0), 6) AS "precision_hotPost10k"
    FROM (SELECT "coalesceSubreddit", sum("stepUp")::bigint AS "stepUp", sum("hotPost")::bigint AS "hotPost",
                 sum("hotPost10k")::bigint AS "hotPost10k", sum("stepUpHotPost")::bigint AS "stepUpHotPost",
                 sum("stepUpHotPost10k")::bigint AS "stepUpHotPost10k"
          FROM {labels} GROUP BY ALL)"""


CTES["win"] = (("px",), """
    SELECT * FROM px WHERE "createdTSUTC" BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-25'""")
CTES["labels_"] = (("win", "hotmax"), _labels("win", "hotmax"))
CTES["metrics"] = (("labels_",), _metrics("labels_"))
CTES["win2"] = (("px",), """
    SELECT * FROM px WHERE "createdTSUTC" BETWEEN TIMESTAMP '2024-01-23' AND TIMESTAMP '2024-01-24 18:00:00'""")
CTES["hotmax2"] = (
    ("hotmax", "hot"),
    """
    SELECT * FROM hotmax WHERE "postId" IN
      (SELECT "postId" FROM hot WHERE "loadDateUTC" BETWEEN DATE '2024-01-23' AND DATE '2024-01-25')""",
)
CTES["labels2"] = (("win2", "hotmax2"), _labels("win2", "hotmax2"))
CTES["curve"] = (
    ("px",),
    """
    SELECT value, n, tp, sum(n) OVER w AS cn, sum(tp) OVER w AS ct, sum(tp) OVER () AS total
    FROM (SELECT predict_proba_1 AS value, count(*) AS n, sum(target) AS tp FROM px GROUP BY ALL)
    WINDOW w AS (ORDER BY value DESC ROWS UNBOUNDED PRECEDING)""",
)


def with_ctes(body: str, *roots: str) -> str:
    """Put the needed table expressions, in dependency order, before ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for root in roots:
        visit(root)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order) + "\n" + body


ORACLES: dict[str, str] = {}
_DATE_AS_TEXT = '* REPLACE ("loadDateUTC"::varchar AS "loadDateUTC")'


def oracle(name: str, body: str, *roots: str) -> None:
    ORACLES[name] = with_ctes(body, *roots)


# ---------------------------------------------------------------- intake

oracle(
    "snapshot_normalize",
    f"SELECT {_DATE_AS_TEXT} FROM (SELECT * FROM rising25 UNION ALL SELECT * FROM hot3)",
    "rising25",
    "hot3",
)
oracle("collect_feed", f"SELECT {_DATE_AS_TEXT} FROM hot3", "hot3")
oracle("snapshot_age", 'SELECT id, minutes AS "timeElapsedMin", days AS "ageDays" FROM aged', "aged")
oracle("map_value_sum", 'SELECT id, gilded AS "numGildings" FROM raw', "raw")
oracle(
    "load_columns",
    'SELECT event_id, "loadTSUTC", "loadDateUTC"::varchar AS "loadDateUTC", "loadTimeUTC" FROM snap',
    "snap",
)
oracle(
    "typed_snapshots",
    """SELECT * EXCLUDE (event_id) REPLACE ("loadDateUTC"::varchar AS "loadDateUTC")
FROM snap WHERE event_id % 97 <> 0""",
    "snap",
)
oracle(
    "rejected_snapshots",
    """SELECT "postId", strftime("loadTSUTC", '%Y-%m-%d %H:%M:%S') AS "loadTSUTC", 'n/a' AS score, 'score' AS "badColumns"
FROM snap WHERE event_id % 97 = 0""",
    "snap",
)
oracle(
    "dedupe_latest",
    """SELECT "postId", "loadTSUTC", event_id, score FROM snap
QUALIFY row_number() OVER (PARTITION BY "postId" ORDER BY "loadTSUTC" DESC, event_id DESC) = 1""",
    "snap",
)
oracle(
    "topn_per_feed",
    """SELECT view, subreddit, fetched_at, rank, id FROM raw
QUALIFY row_number() OVER (PARTITION BY view, subreddit, fetched_at ORDER BY rank) <= 2""",
    "raw",
)
_STALE = 'epoch("loadTSUTC") - epoch("createdTSUTC") > 3600'
oracle("stale_rows", f'SELECT "postId", "loadTSUTC", "createdTSUTC" FROM hot25 WHERE {_STALE}', "hot25")

# ---------------------------------------------------------------- scans

oracle("ids_by_date", """SELECT "postId" FROM snap WHERE "loadDateUTC" = DATE '2024-01-10'""", "snap")
oracle(
    "ids_by_date_range",
    """SELECT "postId" FROM snap WHERE "loadDateUTC" BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'""",
    "snap",
)
oracle(
    "date_spine",
    """SELECT strftime(unnest(generate_series(lo, hi, INTERVAL 1 DAY)), '%Y-%m-%d') AS date
FROM (SELECT min("loadDateUTC")::timestamp AS lo, max("loadDateUTC")::timestamp AS hi FROM snap)""",
    "snap",
)
oracle(
    "recent_ids",
    """SELECT DISTINCT "postId" FROM snap
WHERE "loadTSUTC" BETWEEN TIMESTAMP '2024-01-30 22:45:00' AND TIMESTAMP '2024-01-30 23:00:00'""",
    "snap",
)
oracle(
    "recent_ids_aged",
    """SELECT DISTINCT "postId" FROM snap WHERE "timeElapsedMin" >= 45
AND "loadTSUTC" BETWEEN TIMESTAMP '2024-01-30 17:00:00' AND TIMESTAMP '2024-01-30 23:00:00'""",
    "snap",
)
oracle(
    "recent_ids_same_day",
    """SELECT DISTINCT "postId" FROM snap
WHERE "loadDateUTC" = DATE '2024-01-19' AND "loadTSUTC" >= TIMESTAMP '2024-01-19 23:05:00'""",
    "snap",
)
oracle("distinct_ids", 'SELECT DISTINCT "postId" FROM snap', "snap")
oracle(
    "history_for_ids",
    """SELECT event_id, "postId", "loadTSUTC", score FROM snap WHERE "postId" IN
  (SELECT "postId" FROM hot WHERE "loadDateUTC" BETWEEN DATE '2024-01-05' AND DATE '2024-01-12')""",
    "snap",
    "hot",
)
oracle("scored_window", 'SELECT "postId", "createdTSUTC", predict_proba_1, "stepUp" FROM win2', "win2")

# ---------------------------------------------------------------- features and labels

oracle("post_features", "SELECT * FROM feat", "feat")
oracle("features_filled", "SELECT * EXCLUDE (target) FROM filled", "filled")
oracle("labelled_features", "SELECT * FROM lab", "lab")
oracle(
    "training_days",
    """SELECT *, CASE WHEN "postId" IN
  (SELECT "postId" FROM hot WHERE "loadDateUTC" BETWEEN DATE '2024-01-08' AND DATE '2024-01-20') THEN 1 ELSE 0 END AS target
FROM feat WHERE "createdTSUTC"::date BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'""",
    "feat",
    "hot",
)
oracle(
    "time_features",
    """SELECT "postId", "createdTSUTC", h AS hour, wd AS dayofweek, time0006, time0612, time1218, time1800, sunday
FROM timed""",
    "timed",
)
oracle(
    "random_control",
    """SELECT "postId", (('0x' || substr(md5(concat_ws('|', "postId", '0')), 1, 8))::bigint / 4294967296.0::double
        < (SELECT avg(target) FROM lab))::int AS "randomVar" FROM lab""",
    "lab",
)

# ---------------------------------------------------------------- scoring and tables

_MARGIN = " + ".join(f'"{c}" * {w!r}::double' for c, w in WEIGHTS.items()) + f" + {INTERCEPT!r}"
CTES["lin"] = (("timed",), f"""
    SELECT *, 1 / (1 + exp(-({_MARGIN}))) AS q FROM timed""")
oracle(
    "score_posts",
    """SELECT "postId", 'fixed_weights' AS "modelName", round(q, 6) AS predict_proba_1, (q >= 0.3)::int AS "stepUp"
FROM lin""",
    "lin",
)
oracle(
    "unseen_alerts",
    """SELECT "postId", predict_proba_1, "stepUp" FROM incoming WHERE NOT EXISTS
  (SELECT 1 FROM prior WHERE prior."postId" = incoming."postId" AND prior."stepUp" = 1 AND incoming."stepUp" = 1)""",
    "prior",
    "incoming",
)
_LINK = """'https://reddit.com/' || "postId\""""
oracle(
    "alert_messages",
    f"""SELECT "postId", {_LINK} AS link,
  format('  {{}}
    score={{:.4f}}
    :arrow_up: {{}} | :speech_balloon: {{}} | :clock10: {{}}', {_LINK}, predict_proba_1,
    coalesce("maxScore41_60m", 0), coalesce("maxNumComments41_60m", 0), "timeElapsedMin") AS message,
  'Found potentially viral post(s):' AS header, 'threshold = 0.6000' AS footer
FROM px WHERE "stepUp" = 1""",
    "px",
)
_FEATURE_LIST = ", ".join(f'"{c}"' for c in _FEATURES)
oracle(
    "live_scoring",
    f"""SELECT "postId", subreddit, title, "createdTSUTC", "timeElapsedMin", {_FEATURE_LIST},
  'fixed_weights' AS "modelName", round(q, 6) AS predict_proba_1, (q >= 0.3)::int AS "stepUp"
FROM lin WHERE "postId" IN (SELECT "postId" FROM snap
  WHERE "loadTSUTC" BETWEEN TIMESTAMP '2024-01-30 20:00:00' AND TIMESTAMP '2024-01-30 23:00:00')""",
    "lin",
    "snap",
)
oracle(
    "live_features_long",
    """SELECT "postId", "timeElapsedMin", "maxScore20m", "maxScore21_40m", "maxScore41_60m"
FROM feat WHERE "postId" IN (SELECT "postId" FROM snap
  WHERE "loadTSUTC" BETWEEN TIMESTAMP '2024-01-27 23:00:00' AND TIMESTAMP '2024-01-30 23:00:00')""",
    "feat",
    "snap",
)
CTES["newest"] = (
    ("snap",),
    """
    SELECT event_id, "postId", "loadTSUTC", score, "numComments", event_id % 2 AS half FROM snap
    QUALIFY row_number() OVER (PARTITION BY "postId", "loadTSUTC", event_id % 2 ORDER BY event_id DESC) = 1""",
)
oracle(
    "snapshot_upsert",
    """SELECT * EXCLUDE (half) FROM newest
QUALIFY row_number() OVER (PARTITION BY "postId", "loadTSUTC" ORDER BY half DESC) = 1""",
    "newest",
)
oracle(
    "upsert_scored",
    """SELECT "postId", "modelName", predict_proba_1, "stepUp" FROM incoming
UNION ALL SELECT "postId", "modelName", predict_proba_1, "stepUp" FROM prior
WHERE "postId" NOT IN (SELECT "postId" FROM incoming)""",
    "prior",
    "incoming",
)
oracle(
    "upsert_composite",
    """SELECT subreddit, "createdTSUTC", coalesce(incoming."modelName", prior."modelName") AS "modelName",
  prior."timeElapsedMin" AS "timeElapsedMin"
FROM prior FULL JOIN incoming USING (subreddit, "createdTSUTC")""",
    "prior",
    "incoming",
)
oracle("upsert_empty_target", "SELECT * FROM feat", "feat")
oracle("purge_stale", f'SELECT "postId", "loadTSUTC", "createdTSUTC", score FROM hot25 WHERE NOT ({_STALE})', "hot25")
oracle(
    "evolve_schema",
    """SELECT "postId", "timeElapsedMin", NULL::varchar AS reviewer, NULL::double AS "reviewScore" FROM feat""",
    "feat",
)
oracle("union_all", 'SELECT event_id, "postId", score FROM snap', "snap")
oracle(
    "flatten_items",
    """SELECT event_id, "postId" AS item FROM snap UNION ALL SELECT event_id, subreddit FROM snap
UNION ALL SELECT event_id, title FROM snap""",
    "snap",
)
oracle(
    "latest_model",
    """SELECT max(concat('post_model_', strftime("loadTSUTC", '%Y%m%d-%H%M%S'), '_', subreddit)) AS name FROM snap""",
    "snap",
)

CTES["stored"] = (
    ("snap",),
    """
    SELECT * EXCLUDE (event_id) REPLACE ("loadDateUTC"::varchar AS "loadDateUTC") FROM snap
    QUALIFY row_number() OVER (PARTITION BY "postId", "loadTSUTC" ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
)
oracle("table_merge", "SELECT * FROM stored", "stored")
oracle("table_delete", f"SELECT * FROM stored WHERE score >= {LOW_SCORE}", "stored")

# ---------------------------------------------------------------- monitoring

oracle("hot_max_score", "SELECT * FROM hotmax", "hotmax")
oracle("monitor_labels", "SELECT * FROM labels_", "labels_")
oracle("monitor_counts", 'SELECT "coalesceSubreddit", count("stepUp") AS count FROM labels_ GROUP BY ALL', "labels_")
oracle("monitor_metrics", "SELECT * FROM metrics", "metrics")
oracle(
    "monitor_long",
    "\nUNION ALL ".join(f"""SELECT "coalesceSubreddit", '{r}' AS variable, "{r}" AS value FROM metrics""" for r in RATES),
    "metrics",
)
oracle("monitoring_report", _metrics("labels2"), "labels2")

# ---------------------------------------------------------------- exploration

_DESCRIBE = [
    f"""SELECT '{c}' AS feature, target, count("{c}") AS count, round(avg("{c}"), 6) AS mean,
  round(stddev_samp("{c}"), 6) AS std, round(min("{c}")::double, 6) AS min,
  round(quantile_cont("{c}"::double, 0.25), 6) AS p25, round(quantile_cont("{c}"::double, 0.5), 6) AS p50,
  round(quantile_cont("{c}"::double, 0.75), 6) AS p75, round(max("{c}")::double, 6) AS max
FROM filled GROUP BY target"""
    for c in EXPLORED
]
oracle("describe_by_target", "\nUNION ALL ".join(_DESCRIBE), "filled")
oracle(
    "rate_by_hour",
    'SELECT hour("createdTSUTC")::int AS hour, round(avg(target), 6) AS rate FROM lab GROUP BY ALL',
    "lab",
)
oracle(
    "rate_by_weekday",
    'SELECT (isodow("createdTSUTC") - 1)::int AS dayofweek, round(avg(target), 6) AS rate FROM lab GROUP BY ALL',
    "lab",
)
oracle("hist_hour", 'SELECT hour("createdTSUTC")::bigint AS hour, count(*) AS count FROM feat GROUP BY ALL', "feat")
oracle(
    "hist_minute_block",
    """SELECT ((hour("loadTSUTC") * 60 + minute("loadTSUTC")) // 15 * 15)::bigint AS minute, count(*) AS count
FROM snap GROUP BY ALL""",
    "snap",
)
_HIST = [
    f"""SELECT '{c}' AS feature, target, floor("{c}" / {w}::double)::bigint AS bin, count(*) AS count
FROM filled GROUP BY ALL"""
    for c, w in HIST_WIDTHS.items()
]
oracle(
    "feature_hist_by_target",
    "SELECT *, round(count / sum(count) OVER (PARTITION BY feature, target), 6) AS share FROM (\n"
    + "\nUNION ALL ".join(_HIST)
    + ")",
    "filled",
)
oracle(
    "base_rate",
    "SELECT count(*) AS posts, sum(target)::bigint AS positives, round(avg(target), 6) AS rate FROM lab",
    "lab",
)

# ---------------------------------------------------------------- evaluation

oracle(
    "score_quantiles",
    "\nUNION ALL ".join(
        f"SELECT {q}::double AS q, round(quantile_cont(predict_proba_1, {q}), 6) AS value FROM px" for q in QUANTILES
    ),
    "px",
)


def _above(q: float) -> str:
    return f"""SELECT {q}::double AS q, round(any_value(t), 6) AS threshold, round(avg(target), 6) AS precision,
  round(sum(target)::double / nullif(any_value(total), 0), 6) AS recall
FROM px, (SELECT quantile_cont(predict_proba_1, {q}) AS t, sum(target) AS total FROM px) WHERE predict_proba_1 >= t"""


oracle("pr_at_quantiles", "\nUNION ALL ".join(_above(q) for q in TOP_QUANTILES), "px")
oracle("top2pct_metrics", _above(0.98), "px")
oracle(
    "pr_curve",
    """SELECT round(value, 6) AS threshold, round(ct::double / cn, 6) AS precision, round(ct::double / total, 6) AS recall
FROM curve UNION ALL SELECT NULL, 1.0, 0.0""",
    "curve",
)


def _area(source: str, group: str = "") -> str:
    part = f"PARTITION BY {group}" if group else ""
    cols = f"{group}, " if group else ""
    tail = "GROUP BY ALL" if group else ""
    return f"""SELECT {cols}round(sum(tp::double / total * (ct::double / cn
    + coalesce((ct - tp)::double / nullif(cn - n, 0), 1.0)) / 2), 6) AS aucpr
FROM (SELECT {cols}n, tp, sum(n) OVER w AS cn, sum(tp) OVER w AS ct, sum(tp) OVER ({part}) AS total
      FROM (SELECT {cols}predict_proba_1 AS value, count(*) AS n, sum(target) AS tp FROM {source} GROUP BY ALL)
      WINDOW w AS ({part} ORDER BY value DESC ROWS UNBOUNDED PRECEDING)) {tail}"""


oracle("aucpr", _area("px"), "px")
CTES["top5"] = (("px",), """
    SELECT * FROM px WHERE predict_proba_1 >= (SELECT quantile_cont(predict_proba_1, 0.95) FROM px)""")
oracle("aucpr_top5", _area("top5"), "top5")
CTES["half"] = (
    ("px",),
    """
    SELECT px.* FROM px
    JOIN (SELECT subreddit, quantile_cont(predict_proba_1, 0.5) AS t FROM px GROUP BY ALL) USING (subreddit)
    WHERE predict_proba_1 >= t""",
)
oracle("aucpr_by_feed", _area("half", "subreddit"), "half")
oracle(
    "pr_at_threshold",
    """SELECT positives, true_positives, false_positives, round(true_positives / nullif(positives, 0), 6) AS recall,
  round(true_positives / nullif(true_positives + false_positives, 0), 6) AS precision
FROM (SELECT count(*) FILTER (target = 1) AS positives,
             count(*) FILTER (target = 1 AND predict_proba_1 >= 0.6) AS true_positives,
             count(*) FILTER (target = 0 AND predict_proba_1 >= 0.6) AS false_positives FROM px)""",
    "px",
)
oracle(
    "top10_predictions",
    'SELECT "postId", predict_proba_1, target FROM px ORDER BY predict_proba_1 DESC, "postId" LIMIT 10',
    "px",
)
_REVIEW = ", ".join(f'"{c}"' for c in TREE_FEATURES)
oracle(
    "review_list",
    f"""SELECT target, "postId", {_LINK} AS link, predict_proba_1 AS prediction, "createdTSUTC", {_REVIEW}
FROM px WHERE target = 1 OR predict_proba_1 >= 0.6""",
    "px",
)
oracle(
    "stratified_split",
    """SELECT split, "postId", target,
  (row_number() OVER (PARTITION BY split, target ORDER BY md5(concat_ws('|', "postId", split::varchar, '0')))
     <= round(0.8 * count(*) OVER (PARTITION BY split, target)))::int AS is_train
FROM lab, (SELECT unnest(range(10))::int AS split)""",
    "lab",
)

# ---------------------------------------------------------------- models and streams

_LINEAR = " + ".join([repr(INTERCEPT), *[f'{w!r}::double * "{c}"' for c, w in WEIGHTS.items()]])
CTES["missed"] = (("timed",), f"""
    SELECT *, 1 / (1 + exp(-({_LINEAR}))) - target AS e FROM timed""")


def _pull(name: str, weight: float, x: str) -> str:
    total = f"({weight!r}::double + 0.25 * sum(e * {x}))"
    size = f"({abs(weight)!r}::double + 0.25 * sum(abs(e * {x})))"
    return f"SELECT '{name}' AS feature, round({total}, 4) AS gradient, round(abs({total}) / {size}, 6) AS share FROM missed"


oracle(
    "lr_gradient",
    "\nUNION ALL ".join([*[_pull(c, w, f'"{c}"::double') for c, w in WEIGHTS.items()], _pull("intercept", 0.0, "1.0")]),
    "missed",
)
CTES["heldout"] = (
    ("timed",),
    f"""
    SELECT target, 1 / (1 + exp(-({_LINEAR}))) AS predict_proba_1 FROM (
      SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat_ws('|', "postId", '0', '0')))
          > round(0.8 * count(*) OVER (PARTITION BY target)) AS is_test FROM timed) WHERE is_test""",
)
CTES["heldout5"] = (("heldout",), """
    SELECT * FROM heldout WHERE predict_proba_1 >= (SELECT quantile_cont(predict_proba_1, 0.95) FROM heldout)""")
oracle(
    "holdout_metrics",
    f"""SELECT aucpr, "top5Pctaucpr", "top2PctThreshold", "top2PctPrecision", "top2PctRecall"
FROM ({_area("heldout")}) AS a, (SELECT aucpr AS "top5Pctaucpr" FROM ({_area("heldout5")}) AS b0) AS b,
  (SELECT threshold AS "top2PctThreshold", precision AS "top2PctPrecision", recall AS "top2PctRecall"
   FROM ({_above(0.98).replace("px", "heldout")}) AS c0) AS c""",
    "heldout5",
)
_VOTES = ", ".join(
    f"({depth}, {trees}, '{name}', {STUMP_THRESHOLDS[name] * (level + 1)}::double, {count})"
    for depth in TREE_GRID["max_depth"]
    for trees in TREE_GRID["n_estimators"]
    for (name, level), count in fixed_votes(depth, trees).items()
)
_LONG = "\n    UNION ALL ".join(f"""SELECT "postId", '{c}' AS name, "{c}"::double AS x FROM filled""" for c in TREE_FEATURES)
_IN_GROUP = "max_depth, n_estimators, min_samples_leaf, learning_rate, split"
CTES["tested"] = (
    ("filled",),
    f"""
    SELECT "postId", target, split FROM (
      SELECT "postId", target, split,
        row_number() OVER (PARTITION BY split, target ORDER BY md5(concat_ws('|', "postId", split::varchar, '0')))
          > round(0.8 * count(*) OVER (PARTITION BY split, target)) AS is_test
      FROM filled, (SELECT unnest(range(10))::int AS split)) WHERE is_test""",
)
CTES["voted"] = (
    ("filled",),
    f"""
    SELECT "postId", max_depth, n_estimators, min_samples_leaf, sum(CASE WHEN x > t + min_samples_leaf THEN n ELSE -n END) AS votes
    FROM ({_LONG}) JOIN (VALUES {_VOTES}) AS v(max_depth, n_estimators, name, t, n) USING (name),
      (SELECT unnest({TREE_GRID["min_samples_leaf"]}) AS min_samples_leaf)
    GROUP BY ALL""",
)
CTES["searched"] = (
    ("tested", "voted"),
    f"""
    SELECT target, split, max_depth, n_estimators, min_samples_leaf, learning_rate,
      1 / (1 + exp(-2 * learning_rate * votes)) AS p
    FROM tested JOIN voted USING ("postId"), (SELECT unnest({TREE_GRID["learning_rate"]})::double AS learning_rate)""",
)
CTES["cut"] = (
    ("searched",),
    f"""
    SELECT {_IN_GROUP}, p, target, quantile_cont(p, 0.95) OVER w AS t95, quantile_cont(p, 0.98) OVER w AS t98
    FROM searched WINDOW w AS (PARTITION BY {_IN_GROUP})""",
)


def _group_area(name: str, kept: str) -> str:
    """Area under the curve of the kept rows of each combination and split."""
    return f"""SELECT {_IN_GROUP}, sum(tp::double / total * (ct::double / cn
        + coalesce((ct - tp)::double / nullif(cn - n, 0), 1.0)) / 2) AS {name}
      FROM (SELECT *, sum(n) OVER w AS cn, sum(tp) OVER w AS ct, sum(tp) OVER (PARTITION BY {_IN_GROUP}) AS total
        FROM (SELECT {_IN_GROUP}, p, count(*) AS n, sum(target) AS tp FROM cut WHERE {kept} GROUP BY ALL)
        WINDOW w AS (PARTITION BY {_IN_GROUP} ORDER BY p DESC ROWS UNBOUNDED PRECEDING)) GROUP BY ALL"""


_MEANS = ", ".join(
    f"round(avg({m}), 6) AS mean_{m}, round(stddev_pop({m}), 6) AS std_{m}"
    for m in ("aucpr", "top5Pctaucpr", "top2PctPrecision", "top2PctRecall")
)
oracle(
    "cv_summary_trees",
    f"""SELECT n_estimators::double AS n_estimators, learning_rate, min_samples_leaf::double AS min_samples_leaf,
  max_depth::double AS max_depth, count(*) AS splits, {_MEANS}
FROM ({_group_area("aucpr", "true")})
JOIN ({_group_area("top5Pctaucpr", "p >= t95")}) USING ({_IN_GROUP})
JOIN (SELECT {_IN_GROUP}, sum(CASE WHEN p >= t98 THEN target END)::double / count(CASE WHEN p >= t98 THEN 1 END) AS top2PctPrecision,
        sum(CASE WHEN p >= t98 THEN target END)::double / nullif(sum(target), 0) AS top2PctRecall
      FROM cut GROUP BY ALL) USING ({_IN_GROUP})
GROUP BY n_estimators, learning_rate, min_samples_leaf, max_depth""",
    "cut",
)

_ATTRIBUTION = [
    f"""SELECT target, '{c}' AS feature, round(avg(abs(a)), 6) AS mean_abs, round(max(abs(a)), 6) AS max_abs
FROM (SELECT target, {w!r}::double * ("{c}" - avg("{c}") OVER ()) AS a FROM timed) GROUP BY ALL"""
    for c, w in WEIGHTS.items()
]
oracle("linear_attribution", "\nUNION ALL ".join(_ATTRIBUTION), "timed")
oracle(
    "stream_snapshots",
    'SELECT * EXCLUDE (event_id) REPLACE ("loadDateUTC"::varchar AS "loadDateUTC") FROM snap',
    "snap",
)
oracle("stream_features", "SELECT * FROM feat", "feat")
oracle(
    "stream_scoring",
    f"""SELECT "postId", format('  {{}}
    score={{:.4f}}
    :arrow_up: {{}} | :speech_balloon: {{}} | :clock10: {{}}', {_LINK}, q,
    coalesce("maxScore41_60m", 0)::int, coalesce("maxNumComments41_60m", 0)::int, "timeElapsedMin") AS message,
  'threshold = 0.3000' AS footer
FROM lin WHERE q >= 0.3""",
    "lin",
)

ORACLES["stream_dedupe"] = ORACLES["dedupe_latest"]
ORACLES["stream_features_sliced"] = ORACLES["stream_features"]
_STARTS = "[" + ", ".join(f"TIMESTAMP '{c}'" for c in CUTS) + "]"
CTES["sliced"] = (
    (),
    f"""
    SELECT event_id, date_trunc('hour', ts) AS "createdTSUTC",
      len([c FOR c IN {_STARTS} IF c <= ts]) + (event_id % 50 = 0)::int AS slice FROM events""",
)
CTES["marks"] = (
    ("sliced",),
    """
    SELECT slice, max(max("createdTSUTC")) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM sliced GROUP BY slice""",
)
oracle(
    "stream_late",
    """SELECT event_id, "createdTSUTC",
  CASE WHEN coalesce("createdTSUTC" < seen - INTERVAL 90 MINUTE, false) THEN 'late' ELSE 'kept' END AS side
FROM sliced JOIN marks USING (slice)""",
    "sliced",
    "marks",
)
oracle("stream_collect", f"SELECT {_DATE_AS_TEXT} FROM hot3", "hot3")
# Posts of an hour with a cut in it are scored twice, first on what came before the cut.
CTES["part_snap"] = (("snap",), "\n    UNION ALL ".join(f"""
    SELECT * FROM snap WHERE event_id IN (SELECT event_id FROM events
      WHERE ts < TIMESTAMP '{c}' AND date_trunc('hour', ts) = date_trunc('hour', TIMESTAMP '{c}'))""" for c in CUTS))
CTES["part_feat"] = (("part_snap",), _features("part_snap"))
CTES["part_filled"] = (("part_feat",), f"""
    SELECT * REPLACE ({_FILL}) FROM part_feat""")
CTES["part_timed"] = (("part_filled",), CTES["timed"][1].replace("FROM filled", "FROM part_filled"))
oracle(
    "stream_scoring_replay",
    f"""SELECT "postId", round(CASE WHEN first >= 0.3 AND q >= 0.3 THEN first ELSE q END, 6) AS predict_proba_1,
  (q >= 0.3)::int AS "stepUp", greatest((coalesce(first, 0) >= 0.3)::int, (q >= 0.3)::int)::bigint AS alerts
FROM lin LEFT JOIN (SELECT "postId", 1 / (1 + exp(-({_MARGIN}))) AS first FROM part_timed) USING ("postId")""",
    "lin",
    "part_timed",
)

_GAINS = [
    f"""SELECT {i} AS position, '{c}' AS feature, n - n1 AS n_below, n1 AS n_above, (s - coalesce(s1, 0)) / nullif(n - n1, 0) AS below,
    s1 / nullif(n1, 0) AS above, v - ((n - n1) * v0 + n1 * v1) / n AS gain
    FROM (SELECT count(*) AS n, sum(l) AS s, var_pop(l) AS v, count(*) FILTER ("{c}" = 1) AS n1, sum(l) FILTER ("{c}" = 1) AS s1,
      var_pop(l) FILTER ("{c}" = 1) AS v1, var_pop(l) FILTER ("{c}" = 0) AS v0
      FROM (SELECT *, 2.0::double * target - 1 AS l FROM timed))"""
    for i, c in enumerate(FLAGS)
]
CTES["gains"] = (("timed",), "\n    UNION ALL ".join(_GAINS))
oracle(
    "split_gains",
    """SELECT position::int AS position, feature, n_below, n_above, round(below, 6) AS below, round(above, 6) AS above,
  round(gain, 6) AS gain FROM gains""",
    "gains",
)
CTES["split"] = (("gains",), """
    SELECT * FROM gains ORDER BY gain DESC, position LIMIT 1""")
_SIDE = "CASE feature " + " ".join(f"""WHEN '{c}' THEN "{c}" """ for c in FLAGS) + "END"
oracle(
    "train_stump",
    f"""SELECT "postId", target, round(1 / (1 + exp(-2 * CASE WHEN {_SIDE} = 1 THEN above ELSE below END)), 6) AS predict_proba_1
FROM timed, split""",
    "split",
)
oracle(
    "stump_importance",
    """SELECT gains.feature AS "featureName", CASE WHEN gains.feature = split.feature THEN 1.0::double ELSE 0.0::double END AS "featureImportance"
FROM gains, split""",
    "split",
)
oracle(
    "score_quantiles_sketch",
    "\nUNION ALL ".join(
        f"""SELECT {q}::double AS q, round(quantile_cont(predict_proba_1, {q}), 6) AS exact, count(*) AS n, true AS within FROM px"""
        for q in QUANTILES
    ),
    "px",
)
