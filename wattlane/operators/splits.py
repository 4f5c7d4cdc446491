"""Temporal splits and cross-validation folds.

A split is a ``part`` column, not three copies. Cut points are read once as a handful of
timestamps and then used as literals, so they reach the scan as range filters.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.columns import any_of
from wattlane.functions.ranking import time_index
from wattlane.operators.filters import in_years, stamp
from wattlane.schema import PART, TS
from wattlane.session import materialize

# Named splits by date, both ends included.
DATE_SPLITS: dict[str, dict[str, tuple[str, str]]] = {
    "full_history": {
        "train": ("2011-01-01", "2012-12-31"),
        "validation": ("2013-01-01", "2013-12-31"),
        "test": ("2014-01-01", "2014-12-31"),
    },
    "recent_history": {
        "train": ("2013-01-01", "2013-12-31"),
        "validation": ("2014-01-01", "2014-05-31"),
        "test": ("2014-06-01", "2014-12-31"),
    },
}


@dataclass(frozen=True)
class Fold:
    """Training is ts <= train_end; validation is val_start <= ts <= val_end."""

    fold: int
    train_end: datetime
    val_start: datetime
    val_end: datetime


def part_of(conditions: dict[str, Column]) -> Column:
    part = F.lit(None).cast("string")
    for name, condition in reversed(conditions.items()):
        part = F.when(condition, name).otherwise(part)
    return part


def _keep_parts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    # The plain disjunction of ranges is what the Parquet reader can use.
    return df.where(any_of(list(conditions.values()))).withColumn(PART, part_of(conditions))


def year_parts(
    train: list[int], validation: list[int], test: list[int]
) -> dict[str, Column]:
    sets = {"train": train, "validation": validation, "test": test}
    return {name: in_years(years) for name, years in sets.items() if years}


def cutoff_parts(train_year: int, cutoff: str) -> dict[str, Column]:
    ts = F.col(TS)
    return {
        "train": in_years([train_year]),
        "validation": (ts >= stamp(f"{train_year + 1}-01-01")) & (ts < stamp(cutoff)),
        "test": ts >= stamp(cutoff),
    }


def split_by_years(
    df: DataFrame, train: list[int], validation: list[int], test: list[int]
) -> DataFrame:
    return _keep_parts(df, year_parts(train, validation, test))


def split_v1(df: DataFrame, years: tuple[int, int, int, int] = (2011, 2012, 2013, 2014)) -> DataFrame:
    """Two years of training, one of validation, one of test; the test year is closed."""
    return split_by_years(df, [years[0], years[1]], [years[2]], [years[3]])


def split_v2(df: DataFrame, train_year: int = 2013, cutoff: str = "2014-07-01") -> DataFrame:
    """One year of training, validation up to the cutoff, test open-ended from there."""
    return _keep_parts(df, cutoff_parts(train_year, cutoff))


def build_temporal_split(df: DataFrame, name: str, **options) -> DataFrame:
    builders = {"v1": split_v1, "v2": split_v2}
    if name not in builders:
        raise ValueError(f"unknown split {name!r}, expected one of {sorted(builders)}")
    return builders[name](df, **options)


def split_by_ranges(df: DataFrame, ranges: str | dict[str, tuple[str, str]]) -> DataFrame:
    """Parts as inclusive date ranges, given or by a name of ``DATE_SPLITS``."""
    if isinstance(ranges, str):
        ranges = DATE_SPLITS[ranges]
    day = F.make_dt_interval(days=F.lit(1))
    return _keep_parts(
        df,
        {
            name: (F.col(TS) >= stamp(start)) & (F.col(TS) < stamp(end) + day)
            for name, (start, end) in ranges.items()
        },
    )


def _stamps_at(index: DataFrame, positions: set[int]) -> dict[int, datetime]:
    rows = index.where(F.col("pos").isin(sorted(positions))).select("pos", TS).collect()
    return {row["pos"]: row[TS] for row in rows}


def split_chronological(df: DataFrame, train_frac: float = 0.8) -> DataFrame:
    """Cut at a fraction of the distinct timestamps; no timestamp is on both sides.

    This also stands for a cut at a fraction of the time-ordered rows, which would divide
    the rows of one timestamp.
    """
    index = materialize(time_index(df), "times")
    n = index.count()
    if n < 2:
        raise ValueError("at least two distinct timestamps are needed")
    last = min(max(int(n * train_frac), 1), n - 1) - 1
    cutoff = F.lit(_stamps_at(index, {last})[last]).cast("timestamp_ntz")
    return df.withColumn(PART, F.when(F.col(TS) <= cutoff, "train").otherwise("test"))


def warmup_steps(features: list[str], steps_per_day: int) -> int:
    """History the features need, read from their names."""
    need = 1
    for name in features:
        label = name.rsplit("_", 1)[-1]
        if name.startswith(("lag_", "rolling_mean_")) and label.endswith("d"):
            extra = 1 if name.startswith("rolling_mean_") else 0
            need = max(need, int(label[:-1]) * steps_per_day + extra)
    return need


def expanding_cv_warmup(df: DataFrame, n_folds: int, warmup: int) -> list[Fold]:
    """Folds over equal blocks after the warm-up; the last one takes the remainder."""
    if n_folds < 1:
        raise ValueError("at least one fold is needed")
    index = materialize(time_index(df), "times")
    n = index.count()
    if n <= warmup + n_folds:
        raise ValueError("too few timestamps for the requested folds")
    block = (n - warmup) // (n_folds + 1)
    if block < 1:
        raise ValueError("too few timestamps to form blocks")
    spans = []
    for fold in range(1, n_folds + 1):
        start = warmup + fold * block
        spans.append((fold, start - 1, start, start + block - 1 if fold < n_folds else n - 1))
    return _folds(index, spans)


def expanding_cv_timeseries(
    df: DataFrame,
    n_folds: int = 3,
    gap: int = 0,
    min_train: int | None = None,
    min_validation: int | None = None,
) -> list[Fold]:
    """Folds of equal validation length that end at the last timestamp."""
    index = materialize(time_index(df), "times")
    n = index.count()
    if n < n_folds + 1:
        raise ValueError(f"{n} timestamps cannot form {n_folds} folds")
    length = n // (n_folds + 1)
    if n - length * n_folds - gap <= 0:
        raise ValueError("the gap leaves no training data")
    floor = max(1, n // (n_folds + 2))
    min_train = floor if min_train is None else min_train
    min_validation = floor if min_validation is None else min_validation
    spans = []
    for fold in range(1, n_folds + 1):
        start = n - (n_folds - fold + 1) * length
        if start - gap >= min_train and length >= min_validation:
            spans.append((fold, start - gap - 1, start, start + length - 1))
    if not spans:
        raise ValueError("no fold is large enough")
    return _folds(index, spans)


def _folds(index: DataFrame, spans: list[tuple[int, int, int, int]]) -> list[Fold]:
    at = _stamps_at(index, {p for _, *positions in spans for p in positions})
    return [Fold(fold, at[a], at[b], at[c]) for fold, a, b, c in spans]


def _lit(when: datetime) -> Column:
    return F.lit(when).cast("timestamp_ntz")


def in_training(fold: Fold) -> Column:
    return F.col(TS) <= _lit(fold.train_end)


def in_validation(fold: Fold) -> Column:
    return (F.col(TS) >= _lit(fold.val_start)) & (F.col(TS) <= _lit(fold.val_end))


def fold_rows(df: DataFrame, folds: list[Fold]) -> DataFrame:
    """One row per fold a row takes part in, with its ``role``; no join is needed."""
    roles = [
        F.when(in_training(f), F.struct(F.lit(f.fold).alias("fold"), F.lit("train").alias("role")))
        .when(
            in_validation(f),
            F.struct(F.lit(f.fold).alias("fold"), F.lit("validation").alias("role")),
        )
        for f in folds
    ]
    out = df.select("*", F.explode(F.array_compact(F.array(*roles))).alias("_f"))
    return out.select(*df.columns, F.col("_f.fold").cast("bigint").alias("fold"), "_f.role")


def fold_segment(folds: list[Fold]) -> tuple[Column, dict[int, list[int]], dict[int, list[int]]]:
    """Cut time at every fold boundary, so that each row lies in exactly one segment.

    Returns the segment column and, per fold, the segments of its training and validation
    part. Statistics per segment then add up to those of any fold.
    """
    ends = sorted({f.train_end for f in folds} | {f.val_end for f in folds})
    starts = {f.val_start for f in folds}
    # A cut is "ts <= bound" or "ts < bound"; the pair orders an open bound before a closed one.
    cuts = sorted({(t, 1) for t in ends} | {(t, 0) for t in starts})
    segment = F.lit(len(cuts))
    for i, (bound, closed) in reversed(list(enumerate(cuts))):
        inside = F.col(TS) <= _lit(bound) if closed else F.col(TS) < _lit(bound)
        segment = F.when(inside, i).otherwise(segment)
    at = {cut: i for i, cut in enumerate(cuts)}
    train = {f.fold: list(range(at[(f.train_end, 1)] + 1)) for f in folds}
    validation = {
        f.fold: list(range(at[(f.val_start, 0)] + 1, at[(f.val_end, 1)] + 1)) for f in folds
    }
    return segment, train, validation


def segment_roles(
    pieces: DataFrame, folds: list[Fold], train: dict[int, list[int]], validation: dict[int, list[int]]
) -> DataFrame:
    """One row per fold that a piece, a row for each ``_segment``, takes part in, with its ``role``."""
    roles = [
        F.struct(
            F.lit(f.fold).cast("bigint").alias("fold"),
            F.when(F.col("_segment").isin(train[f.fold]), "train")
            .when(F.col("_segment").isin(validation[f.fold]), "validation")
            .alias("role"),
        )
        for f in folds
    ]
    out = pieces.select("*", F.explode(F.array(*roles)).alias("_f")).where(F.col("_f.role").isNotNull())
    return out.select(*[c for c in pieces.columns if c != "_segment"], "_f.fold", "_f.role")


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(PART).agg(
        F.count("*").alias("rows"), F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts")
    )
