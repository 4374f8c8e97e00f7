"""Stored tables with a key: rows are put, replaced and deleted by key, and readers always see one whole version.

A table is a folder of data files and a folder of manifests.  A manifest names the folder that holds each day of one
version.  A write touches the days of its rows only: these are written anew beside the old ones, then the next manifest
is put in place by a rename that fails if another writer was faster.  Until then, and if the writer dies, readers go on
seeing the version before.  The day must follow from the key, so that equal keys meet in one day.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posttrend.operators.merge import delete_by_key, empty_like, upsert
from posttrend.sources.files import Files

VERSIONS, DATA, FOLDER = "_versions", "data", "_day"
ATTEMPTS = 5


class Conflict(RuntimeError):
    """Another writer has put the version in place that this one was about to write."""


class Manifest(NamedTuple):
    """One version: its number, and the folder below the table's path that holds each day."""

    version: int
    days: dict[str, str]


class KeyedTable(NamedTuple):
    """A table at ``path`` of rows of ``schema``, unique on ``keys`` and divided by the date column ``day``."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    day: str

    # ------------------------------------------------------------ versions

    def _files(self) -> Files:
        return Files(self.spark, self.path)

    def versions(self) -> list[int]:
        """Numbers of the stored versions, oldest first."""
        names = self._files().names(posixpath.join(self.path, VERSIONS))
        return sorted(int(name.removesuffix(".json")) for name in names if name[0].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """A stored version, by default the newest; version 0 is the empty table."""
        number = max(self.versions(), default=0) if version is None else version
        if number == 0:
            return Manifest(0, {})
        text = self.spark.read.text(self._manifest_path(number), wholetext=True).first()[0]
        return Manifest(number, json.loads(text))

    def _manifest_path(self, version: int) -> str:
        return posixpath.join(self.path, VERSIONS, f"{version:010d}.json")

    def _commit(self, manifest: Manifest) -> None:
        text = json.dumps(manifest.days, sort_keys=True)
        if not self._files().put(self._manifest_path(manifest.version), text, replace=False):
            raise Conflict(f"version {manifest.version} of {self.path} was written meanwhile")

    # ------------------------------------------------------------ reading

    def read(self, version: int | None = None, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """The rows of a version; days outside ``since`` to ``until`` are not even listed."""
        return self._rows(self.manifest(version), lambda d: (since is None or d >= since.isoformat()) and (until is None or d <= until.isoformat()))

    def _rows(self, manifest: Manifest, wanted: Callable[[str], bool]) -> DataFrame:
        paths = [posixpath.join(self.path, folder) for d, folder in sorted(manifest.days.items()) if wanted(d)]
        if not paths:
            return empty_like(self.spark, self.schema)
        # Stored files may have NULL anywhere, as far as Spark is concerned.
        layout = T.StructType([T.StructField(f.name, f.dataType) for f in self.schema])
        return self.spark.read.schema(layout).parquet(*paths)

    # ------------------------------------------------------------ writing

    def _days_of(self, rows: DataFrame) -> list[str]:
        """The days that occur: as many as the table has at most."""
        return [r[0] for r in rows.select(F.col(self.day).cast("string")).distinct().collect() if r[0] is not None]

    def _write(self, days: list[str], change: Callable[[DataFrame], DataFrame], attempts: int) -> Manifest:
        """Replace the rows of some days by ``change`` of them; tried again from the newest version after a conflict."""
        for attempt in range(attempts):
            before = self.manifest()
            after = before.version + 1
            folder = posixpath.join(DATA, f"v{after:010d}-{uuid.uuid4().hex}")
            rows = change(self._rows(before, set(days).__contains__))
            rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
            rows = rows.withColumn(FOLDER, F.col(self.day).cast("string")).hint("rebalance", FOLDER)
            rows.write.partitionBy(FOLDER).parquet(posixpath.join(self.path, folder))
            written = {d: posixpath.join(folder, f"{FOLDER}={d}") for d in days}
            kept = {d: f for d, f in before.days.items() if d not in written}
            there = self._existing(written)
            manifest = Manifest(after, {**kept, **there})
            try:
                self._commit(manifest)
                return manifest
            except Conflict:
                if attempt + 1 == attempts:
                    raise
        raise AssertionError("no attempt was made")

    def _existing(self, folders: dict[str, str]) -> dict[str, str]:
        """The days that have rows left."""
        files = self._files()
        return {d: f for d, f in folders.items() if files.exists(posixpath.join(self.path, f))}

    def put(self, rows: DataFrame, order: str | None = None, attempts: int = ATTEMPTS) -> Manifest:
        """Insert rows and replace those whose key is there already.

        Of several rows of a key the one with the largest ``order`` counts (a column that may be no part of the table);
        without it keys must be unique, or the write fails.  What is put later replaces what was put earlier, whatever
        the files' times.  A column that ``rows`` lacks keeps its value where the key is known.
        """
        days = self._days_of(rows)
        if not days:
            return self.manifest()
        rows = rows.where(F.col(self.day).isNotNull())

        def change(old: DataFrame) -> DataFrame:
            # ``order`` ranks the new rows only; where it is no column of the table it is dropped after that.
            known = old if order is None or order in self.schema.names else old.withColumn(order, F.lit(None).cast(rows.schema[order].dataType))
            return upsert(known, rows, self.keys, order, unique=order is None)

        return self._write(days, change, attempts)

    def replace_groups(self, groups: DataFrame, rows: DataFrame, by: list[str], attempts: int = ATTEMPTS) -> Manifest:
        """Put ``rows`` in place of all rows of some groups: the values of ``by`` and the day that ``groups`` has.

        Rows of other groups stay, but for those whose key comes again.
        """
        days = sorted({*self._days_of(groups), *self._days_of(rows)})
        if not days:
            return self.manifest()
        return self._write(days, lambda old: upsert(delete_by_key(old, groups, by), rows, self.keys, unique=True), attempts)

    def delete(self, bad: DataFrame, attempts: int = ATTEMPTS) -> Manifest:
        """Delete the rows whose key is in ``bad``, which also has the day; a day without rows goes."""
        days = self._days_of(bad)
        if not days:
            return self.manifest()
        return self._write(days, lambda old: delete_by_key(old, bad, self.keys), attempts)

    def clean(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions, and data that no kept one names; returns the folders removed.

        Data of writers at work stays: it is for versions after the newest.
        """
        files, versions = self._files(), self.versions()
        kept = versions[-max(keep, 1):]
        used = {posixpath.dirname(f) for v in kept for f in self.manifest(v).days.values()}
        for version in versions[: len(versions) - len(kept)]:
            files.delete(self._manifest_path(version))
        removed = 0
        for name in files.names(posixpath.join(self.path, DATA)):
            if posixpath.join(DATA, name) not in used and int(name[1:].split("-")[0]) <= max(kept, default=0):
                files.delete(posixpath.join(self.path, DATA, name))
                removed += 1
        return removed


def is_keyed(spark: SparkSession, path: str) -> bool:
    """Whether a stored table of versions is at ``path``."""
    return Files(spark, path).exists(posixpath.join(path, VERSIONS))
