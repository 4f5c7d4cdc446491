"""Data quality and profiling of a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import all_of, epoch_seconds
from wattlane.functions.quantiles import exact_quantiles
from wattlane.operators.filters import label_slice
from wattlane.schema import KEYS, SERIES, TS, VALUE
from wattlane.session import materialize


def column_quality(df: DataFrame) -> DataFrame:
    """Type, missing count and missing percentage of every column, from one pass."""
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"_m{i}") for i, (name, _) in enumerate(fields)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("dtype"),
                F.col(f"_m{i}").alias("missing"),
                F.round(100.0 * F.col(f"_m{i}") / F.col("_rows"), 3).alias("missing_pct"),
            )
            for i, (name, kind) in enumerate(fields)
        ]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def negatives_and_zeros(panel: DataFrame) -> DataFrame:
    """Number of negative readings and the mean over series of each one's share of zeros."""
    return (
        panel.groupBy(SERIES)
        .agg(
            F.count_if(F.col(VALUE) < 0).alias("_neg"),
            F.avg(F.when(F.col(VALUE) == 0, 1.0).otherwise(0.0)).alias("_zero"),
        )
        .agg(F.sum("_neg").alias("negatives"), F.avg("_zero").alias("mean_zero_share"))
    )


def dataset_extent(panel: DataFrame) -> DataFrame:
    """Rows, distinct timestamps, series and time bounds."""
    return panel.agg(
        F.count("*").alias("rows"),
        F.count_distinct(TS).alias("timestamps"),
        F.count_distinct(SERIES).alias("series"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
    )


def describe(
    df: DataFrame,
    value: str = VALUE,
    percentiles: dict[str, float] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles, overall or per group."""
    by = by or []
    percentiles = percentiles or {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    number = F.col(value).cast("double")
    moments = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(number).alias("mean"),
        F.stddev_samp(number).alias("std"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
    )
    return with_quantiles(moments, df, value, percentiles, by)


def with_quantiles(
    moments: DataFrame, df: DataFrame, value: str, percentiles: dict[str, float], by: list[str]
) -> DataFrame:
    """Add exact percentile columns to a frame with one row per group."""
    quantiles = exact_quantiles(df, value, percentiles, by)
    if not by:
        row = quantiles.select(F.struct(*percentiles)).scalar()
        return moments.withColumns({name: row[name] for name in percentiles})
    mirror = quantiles.select(*[F.col(c).alias(f"_q_{c}") for c in by], *percentiles)
    same = all_of([F.col(c).eqNullSafe(F.col(f"_q_{c}")) for c in by])
    return moments.join(mirror, same, "left").drop(*[f"_q_{c}" for c in by])


def zero_share(panel: DataFrame) -> DataFrame:
    """Percentage of zero readings per series."""
    return panel.groupBy(SERIES).agg(
        (F.avg(F.when(F.col(VALUE) == 0, 1.0).otherwise(0.0)) * 100).alias("zero_pct")
    )


def zero_share_ranking(panel: DataFrame, k: int = 15) -> DataFrame:
    return zero_share(panel).orderBy(F.desc("zero_pct"), SERIES).limit(k)


def zero_share_counts(panel: DataFrame) -> DataFrame:
    """Series with any zero, and series with more than half zeros."""
    return zero_share(panel).agg(
        F.count("*").alias("series"),
        F.count_if(F.col("zero_pct") > 0).alias("with_zero"),
        F.count_if(F.col("zero_pct") > 50).alias("mostly_zero"),
    )


def first_active(panel: DataFrame) -> DataFrame:
    """First non-zero timestamp per series; a series of zeros gives its first timestamp."""
    return panel.groupBy(SERIES).agg(
        F.coalesce(F.min(F.when(F.col(VALUE) != 0, F.col(TS))), F.min(TS)).alias("first_active")
    )


def first_active_by_year(panel: DataFrame) -> DataFrame:
    return (
        first_active(panel)
        .groupBy(F.year("first_active").cast("bigint").alias("year"))
        .agg(F.count("*").alias("series"))
    )


def consecutive_steps(panel: DataFrame) -> DataFrame:
    """Seconds between consecutive rows of each series, as (series_id, step_seconds, n).

    Repeated keys are first collapsed to counts, which are steps of 0. Steps inside a day
    come from windows over one series and day, and steps across days from the first and
    last row of each day, so no task holds a whole series.
    """
    keys = panel.groupBy(*KEYS).agg(F.count("*").alias("_n")).withColumn("_day", F.to_date(TS))
    repeated = keys.where(F.col("_n") > 1).select(
        SERIES, F.lit(0).cast("bigint").alias("step_seconds"), (F.col("_n") - 1).alias("n")
    )
    inside = W.partitionBy(SERIES, "_day").orderBy(TS)
    within = keys.select(
        SERIES,
        (epoch_seconds(TS) - epoch_seconds(F.lag(TS).over(inside))).alias("step_seconds"),
        F.lit(1).cast("bigint").alias("n"),
    )
    edges = keys.groupBy(SERIES, "_day").agg(F.min(TS).alias("_lo"), F.max(TS).alias("_hi"))
    days = W.partitionBy(SERIES).orderBy("_day")
    between = edges.select(
        SERIES,
        (epoch_seconds("_lo") - epoch_seconds(F.lag("_hi").over(days))).alias("step_seconds"),
        F.lit(1).cast("bigint").alias("n"),
    )
    steps = repeated.unionByName(within).unionByName(between)
    return steps.where(F.col("step_seconds").isNotNull())


def step_histogram(panel: DataFrame) -> DataFrame:
    return consecutive_steps(panel).groupBy("step_seconds").agg(F.sum("n").alias("n"))


def irregular_steps(panel: DataFrame, step_seconds: int) -> DataFrame:
    """Number of steps of another length per series; no rows when the cadence is regular."""
    return (
        consecutive_steps(panel)
        .where(F.col("step_seconds") != step_seconds)
        .groupBy(SERIES)
        .agg(F.sum("n").alias("violations"))
    )


def assert_regular(panel: DataFrame, step_seconds: int) -> None:
    bad = irregular_steps(panel, step_seconds).limit(5).collect()
    if bad:
        raise ValueError(f"cadence is not {step_seconds} s in series {[r[SERIES] for r in bad]}")


def duplicate_keys(panel: DataFrame) -> DataFrame:
    return panel.groupBy(*KEYS).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def irregular_days(
    panel: DataFrame, steps_per_day: int = 96, by: list[str] | None = None
) -> DataFrame:
    """Days whose number of distinct timestamps differs from the expected one, per ``by`` if given."""
    return (
        panel.groupBy(*(by or []), F.to_date(TS).alias("day"))
        .agg(F.count_distinct(TS).alias("intervals"))
        .where(F.col("intervals") != steps_per_day)
    )


def keys_match(left: DataFrame, right: DataFrame, step_seconds: int | None = None) -> DataFrame:
    """Keys found on one side only, with multiplicity, and whether the sides agree.

    With ``step_seconds`` the keys are held as bits of pieces of 64 steps, so that a 64th of them travels. Pieces with a key
    twice or off the grid are compared key by key, as all are without ``step_seconds``.
    """
    both = left.select(*KEYS, F.lit(1).alias("_side")).unionByName(right.select(*KEYS, F.lit(-1).alias("_side")))
    if step_seconds is None:
        return _agreement(_net_keys(both))
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast(both.schema[TS].dataType), F.col(TS))
    unit = F.lit(step_seconds * 1_000_000)
    pieces = both.withColumn("_at", micros)
    pieces = pieces.withColumn("_piece", F.floor(F.col("_at") / (unit * 64)).cast("bigint"))
    slot = F.floor(F.pmod("_at", unit * 64) / unit).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot)
    on_left = F.col("_side") > 0
    found = materialize(
        pieces.groupBy(SERIES, "_piece").agg(
            F.coalesce(F.bit_or(F.when(on_left, bit)), F.lit(0)).alias("_l"),
            F.coalesce(F.bit_or(F.when(~on_left, bit)), F.lit(0)).alias("_r"),
            F.count("*").alias("_n"),
            F.max(F.coalesce(F.pmod("_at", unit) != 0, F.lit(True))).alias("_off"),
        ),
        "key-pieces",
    )
    l, r = F.col("_l"), F.col("_r")
    even = ~F.col("_off") & (F.bit_count(l) + F.bit_count(r) == F.col("_n"))
    sure = found.where(even).select(
        F.bit_count(l.bitwiseAND(F.bitwise_not(r))).cast("bigint").alias("_left"),
        F.bit_count(r.bitwiseAND(F.bitwise_not(l))).cast("bigint").alias("_right"),
    )
    odd = found.where(~even).select(F.col(SERIES).alias("_s"), F.col("_piece").alias("_p"))
    if not odd.isEmpty():
        same = F.col(SERIES).eqNullSafe(F.col("_s")) & F.col("_piece").eqNullSafe(F.col("_p"))
        sure = sure.unionByName(_net_keys(pieces.join(odd, same, "left_semi")))
    return _agreement(sure)


def _net_keys(both: DataFrame) -> DataFrame:
    """How often each key is more on the left and on the right."""
    net = both.groupBy(*KEYS).agg(F.sum("_side").alias("_net"))
    return net.select(F.greatest("_net", F.lit(0)).alias("_left"), F.greatest(-F.col("_net"), F.lit(0)).alias("_right"))


def _agreement(net: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(f"_{side}"), F.lit(0)).alias(f"only_{side}") for side in ("left", "right")]
    return net.agg(*sums).withColumn("matches", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def dst_profile(panel: DataFrame, days: list[str]) -> DataFrame:
    """Fleet curve of given days beside the same weekday seven days earlier."""
    wanted = [F.lit(d).cast("date") for d in days]
    day = F.to_date(TS)
    earlier = [F.date_sub(d, 7) for d in wanted]
    fleet = (
        panel.where(day.isin(wanted) | day.isin(earlier))
        .groupBy(TS)
        .agg(F.avg(F.col(VALUE).cast("double")).alias("fleet_mean"))
    )
    week = F.make_dt_interval(days=F.lit(7))
    before = fleet.select(
        (F.col(TS) + week).alias(TS), F.col("fleet_mean").alias("week_before_mean")
    )
    return (
        fleet.where(F.to_date(TS).isin(wanted))
        .join(before, TS, "left")
        .select(
            F.to_date(TS).alias("day"),
            (F.hour(TS) + F.minute(TS) / F.lit(60.0)).alias("hour_of_day"),
            "fleet_mean",
            "week_before_mean",
        )
    )


def rows_after_dropna(df: DataFrame, subsets: dict[str, list[str]]) -> DataFrame:
    """Rows left by dropping nulls in each subset, and the total, from one pass."""
    counts = df.agg(
        F.count("*").alias("total_rows"),
        *[
            F.count_if(all_of([F.col(c).isNotNull() for c in cols])).alias(name)
            for name, cols in subsets.items()
        ],
    )
    names = ["total_rows", *subsets]
    return counts.unpivot([], names, "subset", "rows")


def rows_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy(F.year(TS).cast("bigint").alias("year")).agg(F.count("*").alias("rows"))


def kpi_summary(panel: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Bounds, timestamps, series, mean of series means and total of a period."""
    number = F.col(VALUE).cast("double")
    cut = label_slice(panel, start, end)
    per_series = cut.groupBy(SERIES).agg(
        F.min(TS).alias("lo"), F.max(TS).alias("hi"), F.avg(number).alias("m"), F.sum(VALUE).alias("s")
    )
    stamps = cut.agg(F.count_distinct(TS).alias("n")).scalar()
    return per_series.agg(
        F.min("lo").alias("first_ts"),
        F.max("hi").alias("last_ts"),
        F.count("*").alias("series"),
        F.avg("m").alias("mean_of_series"),
        F.sum("s").alias("total"),
    ).withColumn("timestamps", stamps)
