"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlane.schema import WEEKDAY_NAMES


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_kwh(power_kw: str | Column, intervals_per_hour: int = 4) -> Column:
    """Energy of one interval from the mean power over it."""
    return col(power_kw) / F.lit(intervals_per_hour)


def epoch_seconds(ts: str | Column) -> Column:
    """Wall-clock seconds since 1970-01-01, independent of the session time zone."""
    ts = col(ts)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    ).cast("bigint")


def floor_day(ts: str | Column) -> Column:
    return F.to_date(col(ts)).cast("timestamp_ntz")


def floor_hour(ts: str | Column) -> Column:
    ts = col(ts)
    return floor_day(ts) + F.make_dt_interval(hours=F.hour(ts))


def floor_minute(ts: str | Column) -> Column:
    ts = col(ts)
    return floor_day(ts) + F.make_dt_interval(hours=F.hour(ts), mins=F.minute(ts))


def hour_of_day(ts: str | Column) -> Column:
    """Hour plus the minute as a fraction of an hour."""
    return F.hour(col(ts)) + F.minute(col(ts)) / F.lit(60.0)


def weekday_name(weekday: str | Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(name) for name in WEEKDAY_NAMES]), col(weekday).cast("int") + 1
    )


def calendar_fields(ts: str | Column) -> dict[str, Column]:
    """Calendar parts of a timestamp; weekday counts from Monday = 0."""
    ts = col(ts)
    return {
        "year": F.year(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
        "weekday": F.weekday(ts).cast("bigint"),
        "hour": F.hour(ts).cast("bigint"),
        "hour_of_day": hour_of_day(ts),
        "day_of_year": F.dayofyear(ts).cast("bigint"),
        "day": F.to_date(ts),
        "time_of_day": F.date_format(ts, "HH:mm:ss"),
    }


def finite(value: str | Column) -> Column:
    """Null in place of NaN or an infinity, as rolling means treat both as missing."""
    v = col(value).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def row_hash(seed: int, keys: list[str | Column]) -> Column:
    """md5 over a seed and the key columns as text: a draw tied to the row, not its partition."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))


def hex_number(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def value_bin(value: str | Column, per_unit: int = 1024) -> Column:
    """Monotone bin of any finite double, with bins about 1/per_unit wide in relative terms.

    The bin depends on the value alone, so it needs no pass over the data, is the same on
    every retry, and one group has at most a few hundred thousand of them.
    """
    v = col(value).cast("double")
    # ln spans about -745..710, so the offset keeps positive numbers above 0.
    size = F.floor((F.log(F.least(F.abs(v), F.lit(1e308))) + 750) * per_unit).cast("bigint")
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("bigint"))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
