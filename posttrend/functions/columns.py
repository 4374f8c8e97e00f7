"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def _elapsed_seconds(load: Column, created_epoch: Column) -> Column:
    return F.floor(F.unix_timestamp(load).cast("double") - created_epoch.cast("double"))


def age_minute_of_day(load: Column, created_epoch: Column) -> Column:
    """Minutes of age within the current day of age; wraps at 1440, so pair it with ``age_days``."""
    return F.floor(F.pmod(_elapsed_seconds(load, created_epoch), F.lit(DAY_SECONDS)) / 60).cast("int")


def age_days(load: Column, created_epoch: Column) -> Column:
    return F.floor(_elapsed_seconds(load, created_epoch) / DAY_SECONDS).cast("int")


def age_minutes(load: Column, created_epoch: Column) -> Column:
    """Whole minutes of age without the daily wrap."""
    return F.floor(_elapsed_seconds(load, created_epoch) / 60).cast("long")


def map_value_sum(counts: Column) -> Column:
    """Sum of a map's values; 0 for an empty map, NULL for a NULL map."""
    return F.aggregate(F.map_values(counts), F.lit(0), lambda acc, n: acc + F.coalesce(n, F.lit(0)))


def max_between(age: str, value: str, low: int | None, high: int, name: str) -> Column:
    """Largest ``value`` seen at an age in [low, high]; NULL when no snapshot falls in there."""
    inside = f"`{age}` <= {high}" if low is None else f"`{age}` BETWEEN {low} AND {high}"
    return F.expr(f"max(CASE WHEN {inside} THEN `{value}` END) AS `{name}`")


def growth(later: str, earlier: str, name: str) -> Column:
    """Relative growth, NULL when either side is NULL or the base is zero."""
    return F.expr(f"try_divide(`{later}` - `{earlier}`, `{earlier}`) AS `{name}`")


def local_hour(ts: Column, zone: str) -> Column:
    return F.hour(F.from_utc_timestamp(ts, zone))


def local_weekday(ts: Column, zone: str) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(F.from_utc_timestamp(ts, zone))


def row_hash(*parts: Column | int | str) -> Column:
    """md5 of the parts joined by '|': the same order in every engine, run and partitioning."""
    return F.md5(F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def hash_fraction(*parts: Column | int | str) -> Column:
    """Deterministic uniform number in [0, 1) from the first 32 bits of ``row_hash``."""
    return F.conv(F.substring(row_hash(*parts), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def to_double(*names: str) -> list[str]:
    """Cast expressions for ``selectExpr``."""
    return [f"cast(`{n}` AS double) AS `{n}`" for n in names]


def utc_date(ts: dt.datetime) -> dt.date:
    """The UTC date of a time; a naive time is UTC, as in ``utc``."""
    return (ts.astimezone(dt.timezone.utc) if ts.tzinfo else ts).date()


def utc(ts: dt.datetime) -> Column:
    """A timestamp literal; a naive time is UTC, whatever zone the driver's machine is in."""
    return F.lit(ts if ts.tzinfo else ts.replace(tzinfo=dt.timezone.utc))
