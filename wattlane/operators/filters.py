"""Row filters. Time filters are ranges on ``ts``, so Parquet can skip row groups."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.schema import SERIES, TS, VALUE, require_columns


def stamp(text: str | date) -> Column:
    return F.lit(str(text)).cast("timestamp_ntz")


def keep_series(panel: DataFrame, allowed: DataFrame, salts: int = 16) -> DataFrame:
    """Rows of the listed series.

    Spark broadcasts the list if its measured size allows. For longer lists the join key is
    salted by time, so the rows of a dominant series meet their id in ``salts`` places.
    """
    salt = F.pmod(F.xxhash64(TS), F.lit(salts)).cast("int")
    ids = allowed.select(SERIES).distinct()
    ids = ids.select(SERIES, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return panel.withColumn("_salt", salt).join(ids, [SERIES, "_salt"], "left_semi").select(
        *panel.columns
    )


def existing_series(panel: DataFrame, requested: DataFrame) -> DataFrame:
    """The requested ids that occur in the panel."""
    return requested.select(SERIES).distinct().join(
        panel.select(SERIES).distinct(), SERIES, "left_semi"
    )


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    if subset:
        require_columns(df, subset)
    return df.na.drop(subset=subset)


def date_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Whole days from ``start`` to ``end``, both included; either side may be open."""
    if start is not None:
        df = df.where(F.col(TS) >= stamp(start))
    if end is not None:
        df = df.where(F.col(TS) < stamp(date.fromisoformat(end) + timedelta(days=1)))
    return df


def label_slice(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Partial-date slice: ``2000``, ``2000-03`` or ``2000-03-05``, ends included."""
    if start is not None:
        df = df.where(F.col(TS) >= stamp(_period(start)[0]))
    if end is not None:
        df = df.where(F.col(TS) < stamp(_period(end)[1]))
    return df


def _period(label: str) -> tuple[date, date]:
    """First day of the labelled period and first day after it."""
    parts = [int(p) for p in label.split("-")]
    first = date(parts[0], *(parts[1:] + [1, 1])[:2])
    if len(parts) == 3:
        return first, first + timedelta(days=1)
    if len(parts) == 2:
        return first, date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first, date(first.year + 1, 1, 1)


def in_years(years: list[int]) -> Column:
    """Membership in years as ranges on the timestamp."""
    spans = [
        (F.col(TS) >= stamp(date(y, 1, 1))) & (F.col(TS) < stamp(date(y + 1, 1, 1))) for y in years
    ]
    return reduce(lambda a, b: a | b, spans)


def year_in(df: DataFrame, years: list[int]) -> DataFrame:
    return df.where(in_years(years))


def at_timestamp(df: DataFrame, when: str) -> DataFrame:
    return df.where(F.col(TS) == stamp(when))


def at_time_of_day(df: DataFrame, time_of_day: str) -> DataFrame:
    return df.where(F.date_format(TS, "HH:mm:ss") == time_of_day)


def complete_history(panel: DataFrame, year: int) -> DataFrame:
    """Ids of the series without a zero reading in ``year``."""
    return (
        year_in(panel, [year])
        .groupBy(SERIES)
        .agg(F.every(F.coalesce(F.col(VALUE) != 0, F.lit(True))).alias("_full"))
        .where("_full")
        .select(SERIES)
    )
