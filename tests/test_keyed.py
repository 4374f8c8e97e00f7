import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posttrend.sources.keyed import Conflict, KeyedTable, Manifest, is_keyed

SCHEMA = T.StructType(
    [T.StructField("day", T.DateType(), False), T.StructField("k", T.StringType(), False), T.StructField("v", T.IntegerType())]
)
D1, D2, D3 = (dt.date(2024, 1, n) for n in (1, 2, 3))


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, ["k"], "day")


def test_rows_are_replaced_by_key_and_read_by_day(spark, table, rows):
    make = lambda data: spark.createDataFrame(data, SCHEMA)
    assert not is_keyed(spark, table.path) and table.read().count() == 0
    table.put(make([(D1, "a", 1), (D1, "b", 2), (D2, "c", 3)]))
    table.put(make([(D1, "a", 9), (D3, "d", 4)]))
    assert is_keyed(spark, table.path)
    assert rows(table.read()) == [(D1, "a", 9), (D1, "b", 2), (D2, "c", 3), (D3, "d", 4)]
    # An untouched day keeps its files; earlier versions can still be read.
    first, second = table.manifest(1), table.manifest(2)
    assert first.days["2024-01-02"] == second.days["2024-01-02"] and first.days["2024-01-01"] != second.days["2024-01-01"]
    assert rows(table.read(version=1)) == [(D1, "a", 1), (D1, "b", 2), (D2, "c", 3)]
    assert rows(table.read(since=D2, until=D2)) == [(D2, "c", 3)]
    assert all("_day=2024-01-03" in f for f in table.read(since=D3).inputFiles())
    # Putting the same rows again changes nothing; a column that is missing keeps its value.
    table.put(make([(D1, "a", 9), (D3, "d", 4)]))
    table.put(make([(D1, "a", 0), (D1, "e", 0)]).select("day", "k"))
    assert rows(table.read()) == [(D1, "a", 9), (D1, "b", 2), (D1, "e", None), (D2, "c", 3), (D3, "d", 4)]


def test_repeated_keys_need_an_order(spark, table, rows):
    layout = "day date, k string, v int, at int"
    twice = spark.createDataFrame([(D1, "a", 1, 2), (D1, "a", 5, 1), (D1, "b", 7, 1)], layout)
    with pytest.raises(Exception, match="several new rows"):
        table.put(twice.drop("at"))
    assert table.versions() == [] and table.read().count() == 0
    table.put(twice, "at")
    assert rows(table.read()) == [(D1, "a", 1), (D1, "b", 7)]
    table.put(spark.createDataFrame([(D1, "a", 3, 0)], layout), "at")
    assert rows(table.read()) == [(D1, "a", 3), (D1, "b", 7)]


def test_delete_drops_rows_and_empty_days(spark, table, rows):
    table.put(spark.createDataFrame([(D1, "a", 1), (D2, "b", 2), (D2, "c", 3)], SCHEMA))
    table.delete(spark.createDataFrame([(D1, "a"), (D2, "c"), (D3, "zz")], "day date, k string"))
    assert rows(table.read()) == [(D2, "b", 2)] and set(table.manifest().days) == {"2024-01-02"}
    table.delete(spark.createDataFrame([], "day date, k string"))
    assert table.versions() == [1, 2]


def test_failed_writer_leaves_the_version_before(spark, table, rows):
    table.put(spark.createDataFrame([(D1, "a", 1)], SCHEMA))
    broken = spark.createDataFrame([(D1, "a", 2), (D1, "b", 3)], SCHEMA).withColumn(
        "v", F.when(F.col("k") == "b", F.raise_error(F.lit("the writer died")).cast("int")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="the writer died"):
        table.put(broken)
    assert rows(table.read()) == [(D1, "a", 1)] and table.versions() == [1]
    table.put(spark.createDataFrame([(D1, "b", 3)], SCHEMA))
    assert rows(table.read()) == [(D1, "a", 1), (D1, "b", 3)]


def test_slower_writer_starts_again(spark, table, rows, monkeypatch):
    """Another writer commits between the reading of a version and the commit of the next."""
    table.put(spark.createDataFrame([(D1, "a", 1)], SCHEMA))
    other = KeyedTable(*table)
    commit, raced = KeyedTable._commit, []

    def late(self, manifest):
        if not raced:
            raced.append(manifest.version)
            monkeypatch.setattr(KeyedTable, "_commit", commit)
            other.put(spark.createDataFrame([(D1, "b", 2)], SCHEMA))
        return commit(self, manifest)

    monkeypatch.setattr(KeyedTable, "_commit", late)
    table.put(spark.createDataFrame([(D1, "c", 3)], SCHEMA))
    assert raced == [2] and table.versions() == [1, 2, 3]
    assert rows(table.read()) == [(D1, "a", 1), (D1, "b", 2), (D1, "c", 3)]
    with pytest.raises(Conflict):
        table._commit(Manifest(3, {}))


def test_cleaning_keeps_what_kept_versions_name(spark, table, rows):
    for n in range(4):
        table.put(spark.createDataFrame([(D1, "a", n), (D2, f"k{n}", n)], SCHEMA))
    orphan = table.read().withColumn("_day", F.lit("2024-01-01"))
    orphan.write.partitionBy("_day").parquet(f"{table.path}/data/v0000000002-orphan")
    at_work = f"{table.path}/data/v0000000005-working"
    orphan.write.partitionBy("_day").parquet(at_work)
    assert table.clean(keep=2) == 3 and table.versions() == [3, 4]
    assert rows(table.read(version=3)) == [(D1, "a", 2), (D2, "k0", 0), (D2, "k1", 1), (D2, "k2", 2)]
    assert rows(table.read())[0] == (D1, "a", 3)
    assert spark.read.parquet(at_work).count() > 0
    assert table.clean(keep=2) == 0
