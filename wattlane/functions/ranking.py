"""Ranks and running sums over sets too large, or too lopsided, for one sort task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import all_of, epoch_seconds
from wattlane.schema import SERIES, TS
from wattlane.session import materialize, shuffle_width


def ranked(
    df: DataFrame,
    order: list[Column],
    group: list[str] | None = None,
    running: dict[str, str] | None = None,
    rank: str = "rank",
) -> DataFrame:
    """Exact ``row_number`` (and running sums) per group, without one task per group.

    Rows are range-partitioned on (group, order), so a group holding a third of the rows is
    spread over a third of the partitions. The partition a row fell into is written out with
    it; the offsets are then totals per (group, partition), at most one row per partition
    and group, and the final windows run inside (group, partition).

    ``running`` maps an output column to the column it sums. ``order`` should end in a
    unique key, both to fix ties and to let equal values split over partitions.
    """
    group = group or []
    running = running or {}
    sliced = materialize(
        df.repartitionByRange(
            shuffle_width(df.sparkSession), *[F.col(g) for g in group], *order
        ).withColumn("_slice", F.spark_partition_id()),
        "ranked",
    )
    keys = [*group, "_slice"]
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    totals = sliced.groupBy(*keys).agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_t_{o}") for o, c in running.items()]
    )
    mirror = {key: f"_key_{key}" for key in keys}
    offsets = totals.select(
        *[F.col(key).alias(name) for key, name in mirror.items()],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0)).alias(f"_b_{o}") for o in running],
    )
    same = all_of([F.col(key).eqNullSafe(F.col(name)) for key, name in mirror.items()])
    inside = W.partitionBy(*keys).orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    return sliced.join(offsets, same).select(
        *df.columns,
        (F.row_number().over(inside) + F.col("_before")).cast("bigint").alias(rank),
        *[(F.sum(c).over(upto) + F.col(f"_b_{o}")).alias(o) for o, c in running.items()],
    )


def time_index(df: DataFrame, ts: str = TS) -> DataFrame:
    """Distinct timestamps with their 0-based position, as ``(ts, pos)``.

    Positions are counted per hour and shifted by the hours before, so the only window that
    sees the whole calendar runs over one row per hour. The timestamps are written first, so ``df`` is read once.
    """
    times = materialize(df.select(ts).where(F.col(ts).isNotNull()).distinct(), "distinct-times")
    times = times.withColumn("_hour", F.floor(epoch_seconds(ts) / F.lit(3600)))
    return _positions(times, [], "_hour", ts)


def series_positions(df: DataFrame) -> DataFrame:
    """0-based position of each row in its series by time, as column ``pos``.

    A long series is counted day by day, so no task holds more than one day of it.
    """
    return _positions(df.withColumn("_day", F.to_date(TS)), [SERIES], "_day", TS)


def _positions(df: DataFrame, group: list[str], bucket: str, order: str) -> DataFrame:
    keys = [*group, bucket]
    before = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = W.partitionBy(*keys).orderBy(order)
    return (
        df.join(offsets, keys)
        .withColumn("pos", F.row_number().over(inside) - 1 + F.col("_before"))
        .drop("_before", bucket)
    )
