"""The scored table: a log of batches with a commit record for each, folded into one row per post by day.

A run is one stream with its checkpoint, or the jobs started by hand.  A batch is written as a whole into a folder of
the attempt, and counts once its commit record names that folder: readers obey the records, so what a failed or
unfinished attempt left is never seen, and a repeat replaces all of its batch at once, also by fewer rows or none.
Rows carry the moment their batch stands for, which orders batches of all runs; the newest row of a post counts.

``compact`` folds committed batches into a keyed table of current rows, touching only the days they concern.  The head
record names that table's version and the attempts in it; readers leave out records the head covers.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posttrend.operators.intake import dedupe_latest
from posttrend.schema import SCORED
from posttrend.sources.files import Files
from posttrend.sources.keyed import KeyedTable

JOBS = "jobs"
COMMITS, HEAD, BASE = "_commits", "head.json", "_base"
# Stored files may have NULL anywhere, as far as Spark is concerned.
_COLUMNS = [T.StructField(f.name, f.dataType) for f in SCORED.fields]
_MOMENT = T.StructField("moment", T.LongType())
_RUN, _BATCH = T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())
_DAY = T.StructField("createdDate", T.DateType())
LOGGED = T.StructType([*_COLUMNS, _MOMENT, _RUN, _BATCH, T.StructField("attempt", T.StringType()), _DAY])
CURRENT = T.StructType([*_COLUMNS, _MOMENT, _RUN, _BATCH, _DAY])


class Attempt(NamedTuple):
    """Rows written for a batch; they count once committed."""

    run: str
    batch: int
    moment: int
    folder: str


class Head(NamedTuple):
    """What has been folded: a version of the base table, the attempts in it, and the last moment among them."""

    version: int = 0
    covers: frozenset[str] = frozenset()
    upto: int | None = None


def batch_path(path: str, batch: int, run: str = JOBS) -> str:
    return f"{path}/run={run}/batch={batch}"


def _record_path(path: str, run: str, batch: int) -> str:
    return posixpath.join(path, COMMITS, f"{run}.{batch}.json")


def _json_files(spark: SparkSession, paths: list[str]) -> list[dict]:
    # A few records at a time; compaction keeps their number down.
    return [json.loads(r[0]) for r in spark.read.text(paths, wholetext=True).collect()] if paths else []


def committed(spark: SparkSession, path: str) -> list[Attempt]:
    """All committed batches that are not folded yet, in the order of their moments."""
    folder = posixpath.join(path, COMMITS)
    names = [posixpath.join(folder, n) for n in Files(spark, path).names(folder) if n.endswith(".json") and n != HEAD]
    covers = head(spark, path).covers
    found = [Attempt(**record) for record in _json_files(spark, names)]
    return sorted((a for a in found if a.folder not in covers), key=lambda a: (a.moment, a.run, a.batch))


def head(spark: SparkSession, path: str) -> Head:
    name = posixpath.join(path, COMMITS, HEAD)
    if not Files(spark, path).exists(name):
        return Head()
    record = _json_files(spark, [name])[0]
    return Head(record["version"], frozenset(record["covers"]), record["upto"])


def base_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, posixpath.join(path, BASE), CURRENT, ["postId"], "createdDate")


def write_attempt(scored: DataFrame, path: str, batch: int, run: str = JOBS, moment: int | None = None) -> Attempt:
    """Store a batch's rows; ``moment`` orders it, by default its number.  Nobody sees them before ``commit``."""
    at = batch if moment is None else moment
    folder = f"run={run}/batch={batch}/attempt={uuid.uuid4().hex}"
    typed = [F.col(f.name).cast(f.dataType) for f in SCORED.fields]
    rows = scored.select(*typed, F.lit(at).cast("long").alias("moment"), F.to_date("createdTSUTC").alias("createdDate"))
    rows.hint("rebalance", "createdDate").write.partitionBy("createdDate").parquet(posixpath.join(path, folder))
    return Attempt(run, batch, at, folder)


def commit(spark: SparkSession, path: str, attempt: Attempt) -> None:
    """Let the attempt be its batch from now on, in place of any attempt before it."""
    files = Files(spark, path)
    files.put(_record_path(path, attempt.run, attempt.batch), json.dumps(attempt._asdict()), replace=True)
    parent, own = posixpath.split(attempt.folder)
    for name in files.names(posixpath.join(path, parent)):
        if name.startswith("attempt=") and name != own:
            files.delete(posixpath.join(path, parent, name))


def append_scored(scored: DataFrame, path: str, batch: int, run: str = JOBS, moment: int | None = None) -> None:
    """Store a batch in place of what its number held."""
    commit(scored.sparkSession, path, write_attempt(scored, path, batch, run, moment))


def read_attempts(spark: SparkSession, path: str, attempts: list[Attempt]) -> DataFrame:
    """The rows of some attempts, with run, batch and moment; only their folders are listed."""
    if not attempts:
        return spark.createDataFrame([], CURRENT)
    reader = spark.read.schema(LOGGED).option("basePath", path)
    return reader.parquet(*[posixpath.join(path, a.folder) for a in attempts]).select(*CURRENT.names)


def read_scored_batch(spark: SparkSession, path: str, batch: int, run: str = JOBS) -> DataFrame:
    """The rows of one committed batch as stored."""
    own = [a for a in committed(spark, path) if (a.run, a.batch) == (run, batch)]
    return read_attempts(spark, path, own).select(*SCORED.names)


def _newest(rows: DataFrame) -> DataFrame:
    return dedupe_latest(rows, ["postId"], "moment", ["batch", "run", "createdTSUTC", "title"])


def read_scored(
    spark: SparkSession,
    path: str,
    since: dt.date | None = None,
    before_batch: int | None = None,
    run: str = JOBS,
    moment: int | None = None,
) -> DataFrame:
    """Current scored rows, one per post; ``since`` leaves out earlier creation days unread.

    ``before_batch`` leaves out the batch of that number in ``run`` and all that come after it: those of later
    moments, and of the same moment those of another run or a larger number.  A batch that stands before the last
    folded one cannot be asked for, as only the newest rows of those are left.
    """
    folded, attempts = head(spark, path), committed(spark, path)
    if not attempts and not folded.version:
        raise FileNotFoundError(f"no scored batch in {path}")
    if before_batch is not None:
        at = before_batch if moment is None else moment
        if folded.upto is not None and at <= folded.upto:
            raise ValueError(f"batches up to moment {folded.upto} have been folded; batch {before_batch} of {run} is earlier")
        earlier = lambda a: a.moment < at or (a.moment == at and a.run == run and a.batch < before_batch)
        attempts = [a for a in attempts if earlier(a) and (a.run, a.batch) != (run, before_batch)]
    rows = read_attempts(spark, path, attempts)
    if since is not None:
        rows = rows.where(F.col("createdDate") >= F.lit(since))
    if folded.version:
        rows = base_table(spark, path).read(folded.version, since=since).unionByName(rows)
    return _newest(rows).select(*SCORED.names)


def compact(spark: SparkSession, path: str, before: int | None = None) -> Head:
    """Fold the committed batches of moments before ``before`` (all if left out) into the table of current rows.

    Only the creation days of their rows are written anew.  The head record makes the step at once; what it covers is
    removed after that, and left out by readers should the removal not come to its end.
    """
    table, last = base_table(spark, path), head(spark, path)
    batches = [a for a in committed(spark, path) if before is None or a.moment < before]
    if not batches:
        return last
    rows = read_attempts(spark, path, batches)
    days = rows.select("createdDate").distinct()
    # As many days as the batches have posts from.
    kept = table.read(last.version).join(F.broadcast(days), "createdDate", "left_semi").select(*CURRENT.names)
    manifest = table.put(_newest(kept.unionByName(rows)))
    upto = max([a.moment for a in batches] + ([] if last.upto is None else [last.upto]))
    now = Head(manifest.version, frozenset(a.folder for a in batches), upto)
    record = {"version": now.version, "covers": sorted(now.covers), "upto": now.upto}
    files = Files(spark, path)
    files.put(posixpath.join(path, COMMITS, HEAD), json.dumps(record), replace=True)
    for a in batches:
        files.delete(_record_path(path, a.run, a.batch))
        files.delete(posixpath.join(path, a.folder))
    table.clean(keep=2)
    return now
