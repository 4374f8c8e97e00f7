"""Explicit schemas; nothing on a data path is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names that stored tables already use.
METRICS = {
    "score": "Score",
    "numComments": "NumComments",
    "upvoteRatio": "UpvoteRatio",
    "numGildings": "NumGildings",
}
GROWTH_METRICS = ("score", "numComments")
POST_KEY = ["postId", "subreddit", "title", "createdTSUTC"]
SNAPSHOT_KEY = ["postId", "loadTSUTC"]

# Names the feeds and their time filters go by.
VIEWS = ("rising", "hot", "top")
TIME_FILTERS = ("all", "day", "hour", "month", "week", "year")


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# One item of a ranked feed as it lands, before any cleaning (fixed values: the feed's own field names).
LISTING = _struct(
    ("subreddit", T.StringType(), False),
    ("view", T.StringType(), False),
    ("rank", T.LongType(), False),
    ("stickied", T.BooleanType(), True),
    ("created_utc", T.DoubleType(), False),
    ("id", T.StringType(), False),
    ("title", T.StringType(), False),
    ("score", T.IntegerType(), True),
    ("num_comments", T.IntegerType(), True),
    ("upvote_ratio", T.FloatType(), True),
    ("gildings", T.MapType(T.StringType(), T.IntegerType()), True),
    ("subscribers", T.IntegerType(), True),
    ("accounts_active", T.IntegerType(), True),
    ("fetched_at", T.TimestampType(), False),
)

# One observation of one post.
SNAPSHOT = _struct(
    ("loadDateUTC", T.DateType(), False),
    ("loadTimeUTC", T.StringType(), False),
    ("loadTSUTC", T.TimestampType(), False),
    ("postId", T.StringType(), False),
    ("subreddit", T.StringType(), False),
    ("subscribers", T.IntegerType(), False),
    ("activeUsers", T.IntegerType(), False),
    ("title", T.StringType(), False),
    ("createdTSUTC", T.TimestampType(), False),
    ("timeElapsedMin", T.IntegerType(), True),
    ("score", T.IntegerType(), True),
    ("numComments", T.IntegerType(), True),
    ("upvoteRatio", T.FloatType(), True),
    ("numGildings", T.IntegerType(), True),
)

# The same row with every attribute still a string, as a text store hands it over.
LANDED = T.StructType([T.StructField(f.name, T.StringType(), True) for f in SNAPSHOT.fields])


def bucket_labels(edges: tuple[int, ...] = (20, 40, 60)) -> list[tuple[int | None, int, str]]:
    """(low, high, label) for each age bucket; the first bucket has no lower bound."""
    out: list[tuple[int | None, int, str]] = []
    for i, high in enumerate(edges):
        low = None if i == 0 else edges[i - 1] + 1
        out.append((low, high, f"{high}m" if low is None else f"{low}_{high}m"))
    return out


def feature_name(metric: str, label: str) -> str:
    return f"max{METRICS[metric]}{label}"


def growth_name(metric: str, earlier: str, later: str) -> str:
    return f"max{METRICS[metric]}Growth{earlier}{later}"


def feature_columns(edges: tuple[int, ...] = (20, 40, 60)) -> list[str]:
    """The numeric feature columns in table order, growth ratios last."""
    labels = [label for _, _, label in bucket_labels(edges)]
    names = [feature_name(m, label) for m in METRICS for label in labels]
    if len(labels) > 1:
        names += [growth_name(m, labels[-2], labels[-1]) for m in GROWTH_METRICS]
    return names


def _feature_type(name: str) -> T.DataType:
    if "Growth" in name:
        return T.DoubleType()
    return T.FloatType() if "UpvoteRatio" in name else T.IntegerType()


FEATURES = T.StructType(
    [SNAPSHOT[c] for c in POST_KEY]
    + [T.StructField("timeElapsedMin", T.IntegerType(), True)]
    + [T.StructField(c, _feature_type(c), True) for c in feature_columns()]
)
TRAINING = T.StructType(FEATURES.fields + [T.StructField("target", T.IntegerType(), False)])
SCORED = T.StructType(
    FEATURES.fields
    + [
        T.StructField("modelName", T.StringType(), False),
        T.StructField("predict_proba_1", T.DoubleType(), True),
        T.StructField("stepUp", T.IntegerType(), True),
    ]
)
ALERTS = _struct(
    ("postId", T.StringType(), False),
    ("link", T.StringType(), False),
    ("message", T.StringType(), False),
    ("header", T.StringType(), False),
    ("footer", T.StringType(), False),
)

# The features the two model families are trained on.
TREE_FEATURES = [
    "maxScore41_60m",
    "maxNumComments21_40m",
    "maxNumComments41_60m",
    "maxUpvoteRatio41_60m",
    "maxScoreGrowth21_40m41_60m",
    "maxNumCommentsGrowth21_40m41_60m",
]
LINEAR_FEATURES = [
    "maxScore21_40m",
    "maxScore41_60m",
    "maxNumComments21_40m",
    "maxNumComments41_60m",
    "maxUpvoteRatio21_40m",
    "maxUpvoteRatio41_60m",
    "maxScoreGrowth21_40m41_60m",
    "maxNumCommentsGrowth21_40m41_60m",
    "time0006",
    "time0612",
    "time1800",
]
