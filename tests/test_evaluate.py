import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from posttrend.operators import evaluate as ev
from posttrend.operators import explore
from posttrend.operators.ranking import running_counts
from posttrend.operators.splits import stratified_splits


def scored(spark, p, y=None, g=None):
    y = [0] * len(p) if y is None else y
    g = ["g"] * len(p) if g is None else g
    data = [(f"k{i}", float(a), int(b), c) for i, (a, b, c) in enumerate(zip(p, y, g))]
    return spark.createDataFrame(data, "postId string, p double, y int, g string").repartition(5)


def sample(seed, n, ties=False):
    rng = np.random.default_rng(seed)
    p = rng.beta(0.6, 6.0, n)
    if ties:
        p = np.round(p, 2)
    return p, (rng.random(n) < p).astype(int)


def curve(p, y):
    """Anchored curve by definition: one point per distinct score, highest first."""
    points = [(0.0, 1.0)]
    for t in sorted(set(p), reverse=True):
        up = p >= t
        points.append((y[up].sum() / y.sum(), y[up].mean()))
    return np.array(points)


def area(p, y):
    points = curve(p, y)
    return float(np.sum(np.diff(points[:, 0]) * (points[1:, 1] + points[:-1, 1]) / 2))


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("slices", [4, 256])
def test_quantiles_match_numpy(spark, ties, slices):
    p, _ = sample(1, 1501, ties)
    qs = [0.0, 0.25, 0.5, 0.95, 0.975, 0.99, 1.0]
    got = {r.q: r.value for r in ev.quantiles(scored(spark, p), "p", qs, slices=slices).collect()}
    for q in qs:
        assert got[q] == pytest.approx(np.quantile(p, q), abs=1e-12)


@pytest.mark.parametrize("data", [[0.3], [0.3, 0.3, 0.3], [0.1, 0.9]])
def test_quantiles_of_very_little(spark, data):
    got = {r.q: r.value for r in ev.quantiles(scored(spark, data), "p", [0.0, 0.5, 1.0]).collect()}
    for q, v in got.items():
        assert v == pytest.approx(np.quantile(data, q))


def test_quantiles_of_nothing(spark):
    got = ev.quantiles(scored(spark, [0.5]).where("p > 1"), "p", [0.5]).collect()
    assert [r.value for r in got] == [None]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60), st.floats(0, 1))
def test_quantile_property(spark, values, q):
    got = ev.quantiles(scored(spark, values), "p", [q], slices=3).first().value
    assert got == pytest.approx(np.quantile(values, q), rel=1e-9, abs=1e-6)


def test_quantiles_with_a_third_on_one_value(spark):
    """The hot value is one row after counting, whatever its share."""
    p, _ = sample(2, 2000)
    p[:700] = 0.0375
    got = [r.value for r in ev.quantiles(scored(spark, p), "p", [0.2, 0.5, 0.8], slices=8).orderBy("q").collect()]
    assert got == pytest.approx(np.quantile(p, [0.2, 0.5, 0.8]))


def test_grouped_quantiles(spark):
    p, _ = sample(3, 900)
    g = np.where(np.arange(900) % 3 == 0, "a", "b")
    got = {(r.g, r.q): r.value for r in ev.quantiles(scored(spark, p, g=g), "p", [0.5, 0.9], ["g"], 8).collect()}
    for (group, q), value in got.items():
        assert value == pytest.approx(np.quantile(p[g == group], q))
    assert len(got) == 4


def test_sketch_quantile_is_close(spark):
    p, _ = sample(4, 2000)
    assert ev.approx_quantiles(scored(spark, p), "p", [0.9]).first().value == pytest.approx(np.quantile(p, 0.9), abs=0.01)


def test_running_counts_cover_every_row(spark):
    p, y = sample(5, 1200, ties=True)
    rows = running_counts(scored(spark, p, y), "p", sums={"tp": F.col("y")}, slices=16).orderBy("value").collect()
    assert [r.value for r in rows] == sorted(set(p))
    assert [r.cum_n for r in rows] == list(np.cumsum([r.n for r in rows]))
    assert [r.cum_tp for r in rows] == list(np.cumsum([r.tp for r in rows]))
    assert (rows[-1].cum_n, rows[0].total_n, rows[-1].cum_tp) == (1200, 1200, y.sum())


@pytest.mark.parametrize("ties", [False, True])
def test_pr_curve_and_area(spark, ties):
    p, y = sample(6, 800, ties)
    frame = scored(spark, p, y)
    got = ev.pr_curve(frame, "p", "y", slices=8).orderBy(F.col("threshold").desc_nulls_first()).collect()
    want = curve(p, y)
    assert [r.recall for r in got] == pytest.approx(list(want[:, 0]))
    assert [r.precision for r in got] == pytest.approx(list(want[:, 1]))
    assert all(a.recall <= b.recall for a, b in zip(got, got[1:]))
    assert ev.auc_pr(frame, "p", "y").first().aucpr == pytest.approx(area(p, y))


def test_area_is_anchored_at_precision_one(spark):
    p, y = np.array([0.9, 0.9, 0.1]), np.array([1, 0, 1])
    assert ev.auc_pr(scored(spark, p, y), "p", "y").first().aucpr == pytest.approx(area(p, y))


def test_area_without_positives_is_null(spark):
    assert ev.auc_pr(scored(spark, [0.1, 0.2], [0, 0]), "p", "y").first().aucpr is None


def test_partial_area(spark):
    p, y = sample(7, 1000)
    top = p >= np.quantile(p, 0.9)
    got = ev.auc_pr(scored(spark, p, y), "p", "y", min_quantile=0.9).first().aucpr
    assert got == pytest.approx(area(p[top], y[top]))


def test_grouped_partial_area(spark):
    p, y = sample(8, 900)
    g = np.where(np.arange(900) % 4 == 0, "a", "b")
    got = {r.g: r.aucpr for r in ev.auc_pr(scored(spark, p, y, g), "p", "y", 0.8, ["g"], 8).collect()}
    for group in "ab":
        pg, yg = p[g == group], y[g == group]
        top = pg >= np.quantile(pg, 0.8)
        assert got[group] == pytest.approx(area(pg[top], yg[top]))


def test_pr_at_quantiles(spark):
    p, y = sample(9, 1000, ties=True)
    rows = ev.pr_at_quantiles(scored(spark, p, y), "p", "y").orderBy("q").collect()
    assert len(rows) == 11
    for r in rows:
        t = np.quantile(p, r.q)
        assert r.threshold == pytest.approx(t)
        assert r.precision == pytest.approx(y[p >= t].mean())
        assert r.recall == pytest.approx(y[p >= t].sum() / y.sum())
    assert ev.top_share_metrics(scored(spark, p, y), "p", "y").first() == next(r for r in rows if r.q == 0.98)


def test_fixed_threshold(spark):
    p, y = sample(10, 500)
    row = ev.pr_at_threshold(scored(spark, p, y), "p", "y", 0.2).first()
    up = p >= 0.2
    assert row.recall == pytest.approx(y[up].sum() / y.sum())
    assert row.precision == pytest.approx(y[up].mean())


def test_top_and_review_lists(spark, plan):
    p, y = sample(11, 300)
    frame = scored(spark, p, y).withColumn("createdTSUTC", F.current_timestamp())
    top = ev.top_predictions(frame, "p", "y", 10)
    assert [r.p for r in top.collect()] == sorted(p, reverse=True)[:10]
    assert "TakeOrderedAndProject" in plan(top)
    review = ev.review_order(ev.review_list(frame, "p", "y", 0.2)).collect()
    assert len(review) == y.sum() + ((y == 0) & (p >= 0.2)).sum()
    assert [r.target for r in review] == sorted([r.target for r in review], reverse=True)
    assert review[0].link == "https://reddit.com/" + review[0].postId


def test_no_global_sort_in_rank_plans(spark, plan):
    """Only the slice offsets, a bounded few rows, ever meet in one partition."""
    p, y = sample(12, 500)
    text = plan(ev.auc_pr(scored(spark, p, y), "p", "y", slices=8))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_splits(spark):
    data = [(f"k{i}", int(i % 20 == 0)) for i in range(1000)]
    frame = spark.createDataFrame(data, "postId string, target int")
    out = stratified_splits(frame, "target", "postId", n=3)
    sizes = {(r.split, r.target, r.is_train): r["count"] for r in out.groupBy("split", "target", "is_train").count().collect()}
    assert sizes == {(s, t, k): n for s in range(3) for t, k, n in ((0, 1, 760), (0, 0, 190), (1, 1, 40), (1, 0, 10))}
    train = lambda s: {r.postId for r in out.where(f"split = {s} AND is_train = 1").collect()}
    assert train(0) != train(1)
    assert out.exceptAll(stratified_splits(frame.repartition(7), "target", "postId", n=3)).count() == 0
    other = stratified_splits(frame, "target", "postId", n=3, seed=1)
    assert out.exceptAll(other).count() > 0


def test_split_of_one_key_stays_together(spark):
    frame = spark.createDataFrame([("hot", 0)] * 500 + [(f"k{i}", 0) for i in range(1000)], "postId string, target int")
    sides = stratified_splits(frame, "target", "postId", n=2).where("postId = 'hot'")
    assert sides.groupBy("split").agg(F.countDistinct("is_train").alias("n")).where("n > 1").count() == 0


def test_split_with_a_missing_class(spark):
    frame = spark.createDataFrame([(f"k{i}", 0) for i in range(10)], "postId string, target int")
    assert stratified_splits(frame, "target", "postId", n=1).agg(F.sum("is_train")).first()[0] == 8


def test_describe(spark):
    p, y = sample(13, 400, ties=True)
    for r in explore.describe_by(scored(spark, p, y), "y", ["p"]).collect():
        part = p[y == r.y]
        assert (r["count"], r.min, r.max) == (len(part), part.min(), part.max())
        assert (r["mean"], r["std"]) == (pytest.approx(part.mean()), pytest.approx(part.std(ddof=1)))
        assert [r.p25, r.p50, r.p75] == pytest.approx(list(np.quantile(part, [0.25, 0.5, 0.75])))


def test_rates_and_histograms(spark, rows):
    frame = spark.createDataFrame([(3, 0), (17, 1), (29, 1), (31, 1)], "minute int, target int")
    assert rows(explore.hist(frame, F.col("minute"), 15)) == [(0, 1), (15, 2), (30, 1)]
    assert rows(explore.rate_by(frame, F.col("minute") < 20, "early")) == [(False, 1.0), (True, 0.5)]
    assert rows(explore.base_rate(frame)) == [(4, 3, 0.75)]
    bins = explore.feature_hist_by(frame, "target", {"minute": 10})
    assert rows(bins) == [("minute", 0, 0, 1, 1.0), ("minute", 1, 1, 1, 1 / 3), ("minute", 1, 2, 1, 1 / 3), ("minute", 1, 3, 1, 1 / 3)]


def test_groups_without_a_name_are_kept(spark):
    data = spark.createDataFrame([("a", 0.9, 1), ("a", 0.1, 0), (None, 0.8, 1), (None, 0.2, 1)], "feed string, p double, y int")
    assert {r.feed: r.aucpr for r in ev.auc_pr(data, "p", "y", by=["feed"]).collect()} == {"a": 1.0, None: 1.0}
    assert {r.feed: r.value for r in ev.quantiles(data, "p", [1.0], by=["feed"]).collect()} == {"a": 0.9, None: 0.8}


def test_columns_without_values_are_described(spark):
    from posttrend.operators.explore import describe_by

    data = spark.createDataFrame([(0, 1.0, None), (0, 3.0, None), (1, None, 5.0)], "target int, a double, b double")
    got = {(r.feature, r.target): (r["count"], r["mean"]) for r in describe_by(data, "target", ["a", "b"]).collect()}
    assert got == {("a", 0): (2, 2.0), ("a", 1): (0, None), ("b", 0): (0, None), ("b", 1): (1, 5.0)}


def test_cuts_found_by_more_digits_are_the_same(spark):
    from posttrend.operators.splits import split_cutoffs

    rows = [(f"k{i}", i % 3 % 2) for i in range(9000)] + [("same", 1)] * 40
    frame = spark.createDataFrame(rows, "k string, y int")
    find = lambda most: sorted(map(tuple, split_cutoffs(frame, "y", "k", 0.2, 3, 0, (0, 1), most).collect()))
    want = find(10**6)
    # 4,096 prefixes of three digits hold one or two rows each; with a limit of 0 all 32 digits are gone through.
    assert len(want) == 6 and find(1) == want == find(0)
    assert split_cutoffs(frame.where("y > 5"), "y", "k", 0.2, 2, 0, (0, 1)).count() == 0
