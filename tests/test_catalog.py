import inspect

import pytest

import __spark_entry__ as entry_module
from posttrend import catalog, oracles

duckdb = pytest.importorskip("duckdb")

SAMPLE = ["post_features", "labelled_features", "snapshot_normalize", "aucpr", "stratified_split", "monitor_metrics"]


def test_oracles_belong_to_queries():
    assert set(oracles.ORACLES) <= set(catalog.QUERIES)
    # Model fits have no SQL counterpart; everything else has one.
    assert set(catalog.QUERIES) - set(oracles.ORACLES) == {
        "train_lr", "coef_table", "train_gbt", "feature_importance", "cv_summary",
    }


def test_entry_runs(spark):
    out = entry_module.entry(spark)
    assert out.count() == 868


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_of_queries_matches_sql(spark, sf_small, name):
    got = catalog.QUERIES[name](spark, sf_small).toArrow()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_small}/events.parquet'")
    want = con.execute(oracles.ORACLES[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names)
    as_rows = lambda t: sorted(zip(*[t.column(n).to_pylist() for n in names]), key=repr)
    assert as_rows(got) == as_rows(want)


def test_data_paths_use_no_python_rows(spark, sf_small):
    for name in ("post_features", "labelled_features", "score_posts", "live_scoring", "aucpr", "monitor_metrics"):
        text = catalog.QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_scans_read_only_what_they_need(spark, sf_small):
    text = catalog.QUERIES["ids_by_date"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_no_local_checkpoints_or_python_udfs():
    import posttrend.operators as operators
    import pathlib

    root = pathlib.Path(inspect.getfile(operators)).parent.parent
    for path in root.rglob("*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and "crossJoin" not in text and ".toPandas(" not in text, path
