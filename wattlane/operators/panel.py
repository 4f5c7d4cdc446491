"""The panel: one row per series and timestamp on a regular grid."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import to_kwh
from wattlane.schema import KEYS, SERIES, TS, VALUE

PANEL_BLOCK = 1 << 16  # positions of a series that are unfolded together
TASK_ROWS = 500_000  # rows of the panel that a task makes


def aggregate_facts(facts: DataFrame) -> DataFrame:
    """Sum of the facts per (series, timestamp); the partial sums happen before the shuffle."""
    return facts.groupBy(*KEYS).agg(F.sum(VALUE).alias(VALUE))


def dense_panel(
    facts: DataFrame,
    step_seconds: int,
    start: str | None = None,
    end: str | None = None,
    within: DataFrame | None = None,
) -> DataFrame:
    """Every series on every step between the first and last fact, absent readings as 0.

    With ``start`` and ``end`` only the steps from ``start`` up to, not including, ``end`` are
    made, with the positions they have in the whole panel. ``within`` can hold the facts of that
    period alone, with the range put on the raw time column, so that only the ids and time
    limits are read from the rest. ``pos`` is the 0-based step of the row.
    """
    blocks = dense_blocks(facts, step_seconds, PANEL_BLOCK, 0, start, end, within)
    return blocks.select(*KEYS, VALUE, "pos")


def dense_blocks(
    facts: DataFrame,
    step_seconds: int,
    size: int,
    lookback: int,
    start: str | None = None,
    end: str | None = None,
    within: DataFrame | None = None,
    asked: DataFrame | None = None,
) -> DataFrame:
    """The dense panel in blocks of ``size`` positions, each with the ``lookback`` rows before it (``_lead_in``).

    Facts are summed first, so a dominant series spreads over all partitions. Only these sums and the first
    position of every block are shuffled, by (series, ``_block``); each then unfolds into the steps up to
    the next, so no row of the grid travels, and windows over blocks need no further shuffle. With ``asked``,
    some (series, timestamp), the column ``_asked`` tells which rows are among them; they travel as the sums do.
    """
    spans = facts.groupBy(SERIES).agg(F.min(TS).alias("_lo"), F.max(TS).alias("_hi"))
    moments = [m.cast("timestamp_ntz") for m in (F.min("_lo"), F.max("_hi"))]
    edge = spans.agg(*moments, F.count("*")).toDF("lo", "hi", "n").first()
    sums = aggregate_facts(facts if within is None else within)
    kind = sums.select(F.coalesce(VALUE, F.lit(0)).alias(VALUE)).schema[VALUE].dataType
    step, first, last, origin = timedelta(seconds=step_seconds), 0, -1, edge["lo"]
    if origin is not None:
        last = (edge["hi"] - origin) // step
        if start is not None:
            first = max(first, -((origin - datetime.fromisoformat(start)) // step))
        if end is not None:
            last = min(last, -((origin - datetime.fromisoformat(end)) // step) - 1)
    lo = F.lit(origin and origin.isoformat()).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", lo, F.col(TS))
    unit = F.lit(step_seconds * 1_000_000)
    own = F.floor(F.col("pos") / F.lit(size)).cast("bigint")
    given, wanted = F.lit(True).alias("_given"), F.lit(False).alias("_asked")
    sums = sums.select(*KEYS, F.coalesce(VALUE, F.lit(0)).alias(VALUE), wanted)
    if asked is not None:
        keys = asked.select(*KEYS).distinct().select(*KEYS, F.lit(0).cast(kind).alias(VALUE), F.lit(True).alias("_asked"))
        sums = sums.unionByName(keys).groupBy(*KEYS).agg(F.sum(VALUE).cast(kind).alias(VALUE), F.max("_asked").alias("_asked"))
    # Facts off the grid, and those without a series, are no reading of a step.
    sums = sums.where(F.col(SERIES).isNotNull() & (F.pmod(micros, unit) == 0)).select(
        SERIES, F.floor(micros / unit).cast("bigint").alias("pos"), VALUE, "_asked"
    )
    sums = sums.where(F.col("pos").between(first, last))
    owners = F.array(own)
    if lookback:
        shared = (F.pmod(F.col("pos"), F.lit(size)) >= size - lookback) & ((own + 1) * size <= last)
        owners = F.when(shared, F.array(own, own + 1)).otherwise(owners)
    sums = sums.select(SERIES, F.explode(owners).alias("_block"), "pos", VALUE, given, "_asked")
    numbers = F.sequence(F.lit(first // size), F.lit(last // size)).cast("array<bigint>")
    marks = spans.where(F.lit(first <= last)).select(SERIES, F.explode(numbers).alias("_block"))
    marks = marks.select(
        SERIES,
        "_block",
        F.greatest(F.lit(first), F.col("_block") * size - lookback).cast("bigint").alias("pos"),
        F.lit(0).cast(kind).alias(VALUE),
        F.lit(False).alias("_given"),
        wanted,
    )
    rows = edge["n"] * max(0, last - first + 1)
    width = max(facts.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    # A width by the rows of the grid, since what is shuffled tells little of what it unfolds into.
    runs = sums.unionByName(marks).repartition(width, SERIES, "_block")
    w = W.partitionBy(SERIES, "_block").orderBy("pos", "_given")
    stop = F.least((F.col("_block") + 1) * size, F.lit(last + 1))
    runs = runs.withColumn("_next", F.coalesce(F.lead("pos").over(w), stop))
    if asked is not None:
        # A series that is only asked for has no mark, which is first in every block of the others.
        runs = runs.withColumn("_known", ~F.first("_given").over(w)).where("_known")
    # A block's mark at the position of a fact gives no row.
    steps = F.when(F.col("_next") > F.col("pos"), F.sequence("pos", F.col("_next") - 1))
    hit = [] if asked is None else [(F.col("_asked") & (F.col("pos") == F.col("_at"))).alias("_asked")]
    return runs.select(SERIES, "_block", F.col("pos").alias("_at"), VALUE, "_asked", F.explode(steps).alias("pos")).select(
        SERIES,
        (lo + F.make_dt_interval(secs=F.col("pos") * F.lit(step_seconds))).alias(TS),
        F.when(F.col("pos") == F.col("_at"), F.col(VALUE)).otherwise(F.lit(0).cast(kind)).alias(VALUE),
        "pos",
        "_block",
        (F.col("pos") < F.col("_block") * size).alias("_lead_in"),
        *hit,
    )


def calendar_fill(daily: DataFrame, day: str, measures: list[str], zero: bool) -> DataFrame:
    """Add the days missing between the first and last: sums become 0, means stay null."""
    edge = daily.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.struct("lo", "hi")
    ).scalar()
    spark = daily.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(edge["lo"], edge["hi"])).alias(day))
    full = days.join(daily, day, "left")
    return full.fillna(0, subset=measures) if zero else full


def wide_to_long(wide: DataFrame, ts: str = TS, intervals_per_hour: int = 4) -> DataFrame:
    """One row per (timestamp, column); nulls kept; energy and year-month added."""
    names = [c for c in wide.columns if c != ts]
    return wide.unpivot([ts], names, SERIES, VALUE).select(
        SERIES,
        F.col(ts).alias(TS),
        VALUE,
        to_kwh(VALUE, intervals_per_hour).alias("value_kwh"),
        F.date_format(ts, "yyyy-MM").alias("year_month"),
    )


def wide_to_long_dropna(wide: DataFrame, ts: str = TS, intervals_per_hour: int = 4) -> DataFrame:
    return wide_to_long(wide, ts, intervals_per_hour).na.drop()


def weekday_hour_matrix(profile: DataFrame, value: str = VALUE) -> DataFrame:
    """Weekday rows by hour columns; the 24 columns are known, so no pass finds them."""
    wide = profile.groupBy("weekday").pivot("hour", list(range(24))).agg(F.max(value))
    return wide.select("weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def timestamp_slice_transpose(panel: DataFrame, stamps: dict[str, str]) -> DataFrame:
    """Series become rows and the given timestamps (column name -> time) become columns."""
    times = {name: F.lit(text).cast("timestamp_ntz") for name, text in stamps.items()}
    return (
        panel.where(F.col(TS).isin(list(times.values())))
        .groupBy(SERIES)
        .agg(*[F.max(F.when(F.col(TS) == t, F.col(VALUE))).alias(n) for n, t in times.items()])
    )


def downcast(df: DataFrame, names: list[str]) -> DataFrame:
    """Single precision for storage."""
    return df.withColumns({name: F.col(name).cast("float") for name in names})
