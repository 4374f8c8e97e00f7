from posttrend.functions.columns import (
    age_days,
    age_minute_of_day,
    age_minutes,
    growth,
    hash_fraction,
    local_hour,
    local_weekday,
    map_value_sum,
    max_between,
    row_hash,
    to_double,
    utc,
    utc_date,
)

__all__ = [
    "age_days",
    "age_minute_of_day",
    "age_minutes",
    "growth",
    "hash_fraction",
    "local_hour",
    "local_weekday",
    "map_value_sum",
    "max_between",
    "row_hash",
    "to_double",
    "utc",
    "utc_date",
]
