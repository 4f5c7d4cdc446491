"""Aggregates and seasonal profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import hour_of_day, weekday_name
from wattlane.functions.gram import pair_correlations
from wattlane.functions.lagged import lag_correlations
from wattlane.functions.quantiles import exact_quantiles
from wattlane.functions.ranking import ranked, time_index
from wattlane.operators.filters import complete_history, in_years, keep_series, label_slice
from wattlane.operators.panel import calendar_fill
from wattlane.operators.quality import with_quantiles
from wattlane.schema import SERIES, TS, VALUE
from wattlane.session import materialize


def number(name: str = VALUE) -> Column:
    return F.col(name).cast("double")


def fleet_total(panel: DataFrame) -> DataFrame:
    return panel.groupBy(TS).agg(F.sum(VALUE).alias("total"))


def fleet_mean(panel: DataFrame) -> DataFrame:
    return panel.groupBy(TS).agg(F.avg(number()).alias("fleet_mean"))


def resample_daily_sum(panel: DataFrame, series: object | None = None) -> DataFrame:
    """Daily totals of the fleet or of one series; days without a row give 0."""
    if series is not None:
        panel = panel.where(F.col(SERIES) == F.lit(series))
    daily = panel.groupBy(F.to_date(TS).alias("day")).agg(F.sum(VALUE).alias("total"))
    return calendar_fill(daily, "day", ["total"], zero=True)


def daily_fleet_mean(panel: DataFrame) -> DataFrame:
    """Daily mean of the fleet mean, for the days that have rows."""
    return (
        fleet_mean(panel)
        .groupBy(F.to_date(TS).alias("day"))
        .agg(F.avg("fleet_mean").alias("fleet_mean"))
    )


def resample_daily_mean(panel: DataFrame) -> DataFrame:
    """Daily mean of the fleet mean; days without a row stay null."""
    return calendar_fill(daily_fleet_mean(panel), "day", ["fleet_mean"], zero=False)


def resample_month_sum(panel: DataFrame) -> DataFrame:
    return panel.groupBy(
        F.year(TS).cast("bigint").alias("year"), F.month(TS).cast("bigint").alias("month")
    ).agg(F.sum(VALUE).alias("total"))


def profile_time_of_day(panel: DataFrame) -> DataFrame:
    """Mean of the fleet mean by hour and minute."""
    return (
        fleet_mean(panel)
        .groupBy(hour_of_day(TS).alias("hour_of_day"))
        .agg(F.avg("fleet_mean").alias("mean_value"))
    )


def profile_weekday(panel: DataFrame) -> DataFrame:
    return (
        fleet_mean(panel)
        .groupBy(F.weekday(TS).cast("bigint").alias("weekday"))
        .agg(F.avg("fleet_mean").alias("mean_value"))
        .withColumn("weekday_name", weekday_name("weekday"))
        .orderBy("weekday")
    )


def profile_weekday_hour(panel: DataFrame) -> DataFrame:
    return (
        fleet_mean(panel)
        .groupBy(
            F.weekday(TS).cast("bigint").alias("weekday"), F.hour(TS).cast("bigint").alias("hour")
        )
        .agg(F.avg("fleet_mean").alias(VALUE))
    )


def daily_cycle_summary(panel: DataFrame) -> DataFrame:
    """Trough and peak hour of the fleet, their ratio, and weekend over weekday level."""
    fleet = fleet_mean(panel)
    hours = fleet.groupBy(F.hour(TS).cast("bigint").alias("h")).agg(F.avg("fleet_mean").alias("m"))
    days = fleet.groupBy(F.weekday(TS).alias("d")).agg(F.avg("fleet_mean").alias("m"))
    # Equal means fall to the earlier hour.
    low = F.min(F.struct("m", "h"))
    high = F.min(F.struct((-F.col("m")).alias("m"), "h"))
    ratio = days.agg(
        (F.avg(F.when(F.col("d") >= 5, F.col("m"))) / F.avg(F.when(F.col("d") < 5, F.col("m"))))
    ).scalar()
    return hours.agg(low.alias("low"), high.alias("high")).select(
        F.col("low.h").alias("min_hour"),
        F.col("low.m").alias("min_value"),
        F.col("high.h").alias("max_hour"),
        (-F.col("high.m")).alias("max_value"),
        F.when(F.col("low.m") != 0, -F.col("high.m") / F.col("low.m")).alias("peak_to_trough"),
        ratio.alias("weekend_to_weekday"),
    )


def series_stats(panel: DataFrame) -> DataFrame:
    """Mean, median, sample deviation, maximum and zero percentage per series."""
    moments = panel.groupBy(SERIES).agg(
        F.avg(number()).alias("mean"),
        F.stddev_samp(number()).alias("std"),
        F.max(number()).alias("max"),
        (F.avg(F.when(F.col(VALUE) == 0, 1.0).otherwise(0.0)) * 100).alias("zero_pct"),
    )
    return with_quantiles(moments, panel, VALUE, {"median": 0.5}, [SERIES])


def year_stats(panel: DataFrame, years: list[int], value: str = VALUE) -> DataFrame:
    """Mean, median, sample deviation and extremes by year."""
    cut = panel.where(in_years(years)).withColumn("year", F.year(TS).cast("bigint"))
    moments = cut.groupBy("year").agg(
        F.avg(number(value)).alias("mean"),
        F.stddev_samp(number(value)).alias("std"),
        F.min(number(value)).alias("min"),
        F.max(number(value)).alias("max"),
    )
    return with_quantiles(moments, cut, value, {"median": 0.5}, ["year"])


def series_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy(SERIES).agg(F.sum(VALUE).alias("total"))


def concentration(panel: DataFrame) -> DataFrame:
    """Series by descending total, with rank and cumulative share."""
    totals = materialize(series_totals(panel), "totals")
    grand = totals.agg(F.sum("total")).scalar()
    order = [F.desc("total"), F.asc(SERIES)]
    return ranked(totals, order, running={"cum_total": "total"}).withColumn(
        "cum_share", F.col("cum_total") / grand
    )


def concentration_summary(panel: DataFrame, tops: tuple[int, ...] = (10, 50)) -> DataFrame:
    """Shares of the largest series, and the largest over the median."""
    totals = materialize(series_totals(panel), "totals")
    median = exact_quantiles(totals, "total", {"m": 0.5}).scalar()
    grand = totals.agg(F.sum("total")).scalar()
    order = [F.desc("total"), F.asc(SERIES)]
    out = totals.agg(
        F.min("total").alias("smallest"), F.max("total").alias("largest")
    ).withColumn("median", median)
    for k in tops:
        top = totals.orderBy(*order).limit(k).agg(F.sum("total")).scalar()
        out = out.withColumn(f"top_{k}_share", top / grand)
    return out.withColumn("largest_to_median", F.col("largest") / F.col("median"))


def lowest_days(
    panel: DataFrame, start: str, end: str, ref_start: str, ref_end: str, k: int = 6
) -> DataFrame:
    """The k lowest days of a period and their percentage of a reference period's median."""
    daily = daily_fleet_mean(panel)
    day = F.col("day")
    reference = (
        daily.where((day >= F.lit(ref_start).cast("date")) & (day <= F.lit(ref_end).cast("date")))
        .agg(F.median("fleet_mean"))
        .scalar()
    )
    return (
        daily.where((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))
        .orderBy("fleet_mean", "day")
        .limit(k)
        .withColumn("pct_of_median", 100 * F.col("fleet_mean") / reference)
    )


def composition_effect(panel: DataFrame, year: int) -> DataFrame:
    """Mean by year of all series against those with a full ``year``, with change on the year."""

    def by_year(rows: DataFrame, name: str) -> DataFrame:
        per_series = rows.groupBy(F.year(TS).cast("bigint").alias("year"), SERIES).agg(
            F.avg(number()).alias("m")
        )
        return per_series.groupBy("year").agg(F.avg("m").alias(name))

    complete = keep_series(panel, complete_history(panel, year))
    both = by_year(panel, "all_series").join(by_year(complete, "complete_series"), "year", "left")
    # One row per year.
    years = W.orderBy("year")
    change = {
        f"{name}_change_pct": 100 * (F.col(name) / F.lag(name).over(years) - 1)
        for name in ("all_series", "complete_series")
    }
    return both.withColumns(change)


def series_vs_fleet(panel: DataFrame, series: object, start: str, end: str) -> DataFrame:
    """Daily totals of one series beside the daily total of the fleet mean."""
    per_stamp = (
        label_slice(panel, start, end)
        .groupBy(TS)
        .agg(
            F.sum(F.when(F.col(SERIES) == F.lit(series), number())).alias("_one"),
            F.avg(number()).alias("_fleet"),
        )
    )
    return per_stamp.groupBy(F.to_date(TS).alias("day")).agg(
        F.coalesce(F.sum("_one"), F.lit(0.0)).alias("series_total"),
        F.sum("_fleet").alias("fleet_total"),
    )


def compare_series(panel: DataFrame, ids: DataFrame) -> DataFrame:
    """Daily totals of chosen series in long form."""
    return (
        keep_series(panel, ids)
        .groupBy(SERIES, F.to_date(TS).alias("day"))
        .agg(F.sum(VALUE).alias("total"))
    )


def seasonal_overlay(panel: DataFrame) -> DataFrame:
    return daily_fleet_mean(panel).select(
        F.year("day").cast("bigint").alias("year"),
        F.dayofyear("day").cast("bigint").alias("day_of_year"),
        "fleet_mean",
    )


def bin_index(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin, the last one closed on the right."""
    width = (high - low) / F.lit(bins)
    place = F.when(width > 0, F.floor((x - low) / width)).otherwise(F.lit(0))
    return F.least(place, F.lit(bins - 1)).cast("bigint")


def _limits(df: DataFrame, value: str) -> Column:
    return df.agg(
        F.struct(F.min(number(value)).alias("lo"), F.max(number(value)).alias("hi"))
    ).scalar()


def _all_bins(df: DataFrame, bins: int, name: str = "bin") -> DataFrame:
    return df.sparkSession.range(bins).select(F.col("id").alias(name))


def histogram(df: DataFrame, value: str = VALUE, bins: int = 10) -> DataFrame:
    """Counts of equal-width bins between the extremes; empty bins included."""
    limits = _limits(df, value)
    x = number(value)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(bin_index(x, limits["lo"], limits["hi"], bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (limits["hi"] - limits["lo"]) / F.lit(bins)
    return (
        _all_bins(df, bins)
        .join(counts, "bin", "left")
        .select(
            "bin",
            (limits["lo"] + F.col("bin") * width).alias("left_edge"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def histogram_density(df: DataFrame, group: str, value: str = VALUE, bins: int = 10) -> DataFrame:
    """Density histogram per group over shared edges; bins with rows only."""
    limits = _limits(df, value)
    width = (limits["hi"] - limits["lo"]) / F.lit(bins)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(group, bin_index(number(value), limits["lo"], limits["hi"], bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    # At most ``bins`` rows per group from here on.
    size = F.sum("n").over(W.partitionBy(group))
    return counts.withColumn("density", F.col("n") / (size * width))


def histogram_2d(df: DataFrame, x: str, y: str, bins: int = 120) -> DataFrame:
    """Two-dimensional counts and their ``log10(n + 1)``; bins with rows only."""
    ends = [f(number(c)).alias(f"{n}_{c}") for c in (x, y) for n, f in (("lo", F.min), ("hi", F.max))]
    edge = df.agg(*ends).select(F.struct(*[f"{n}_{c}" for c in (x, y) for n in ("lo", "hi")])).scalar()
    lx, ly = ({n: edge[f"{n}_{c}"] for n in ("lo", "hi")} for c in (x, y))
    return (
        df.groupBy(
            bin_index(number(x), lx["lo"], lx["hi"], bins).alias("x_bin"),
            bin_index(number(y), ly["lo"], ly["hi"], bins).alias("y_bin"),
        )
        .agg(F.count("*").alias("n"))
        .withColumn("log_n", F.log10(F.col("n") + 1))
    )


def quantile_bins(df: DataFrame, value: str, bins: int = 10, name: str = "bucket") -> DataFrame:
    """Bucket of each value between exact quantiles: right-closed, repeated edges merged."""
    probabilities = {f"e{i}": i / bins for i in range(1, bins)}
    ends = {"e0": 0.0, f"e{bins}": 1.0}
    edges = exact_quantiles(df, value, {**ends, **probabilities}).select(
        F.array_sort(F.array_distinct(F.array(*[f"e{i}" for i in range(bins + 1)])))
    )
    edge = edges.scalar()
    above = [
        F.when((F.size(edge) - 1 > i) & (F.get(edge, F.lit(i)) < number(value)), 1).otherwise(0)
        for i in range(1, bins)
    ]
    bucket = sum(above[1:], above[0]).cast("bigint")
    return df.withColumn(name, F.when(F.col(value).isNotNull(), bucket))


def correlation_matrix(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlations in long form, from one pass that copies no row."""
    return pair_correlations(df, columns, by or [])


def target_correlation(
    df: DataFrame, features: list[str], target: str, by: list[str] | None = None
) -> DataFrame:
    """Correlation of each feature with the target, strongest first."""
    by = by or []
    wide = df.groupBy(*by).agg(*[F.corr(number(f), number(target)).alias(f) for f in features])
    return wide.unpivot(by, features, "feature", "correlation").orderBy(
        *by, F.desc("correlation"), "feature"
    )


def _located_fleet(panel: DataFrame) -> DataFrame:
    """The fleet mean with the position of each timestamp."""
    fleet = fleet_mean(panel)
    return materialize(fleet.join(time_index(fleet), TS).select("pos", F.col("fleet_mean").alias("value")), "fleet")


def autocorrelation(panel: DataFrame, lags: dict[str, int]) -> DataFrame:
    """Correlation of the fleet mean with itself ``lag`` positions back."""
    found = lag_correlations(_located_fleet(panel), list(lags.values()))
    wanted = F.array(*[F.struct(F.lit(n).alias("label"), F.lit(k).cast("bigint").alias("at")) for n, k in lags.items()])
    return (
        found.withColumn("l", F.explode(F.filter(wanted, lambda l: l["at"] == F.col("lag"))))
        .select("l.label", "lag", "autocorrelation")
    )


def autocorrelation_profile(panel: DataFrame, longest: int = 767) -> DataFrame:
    """The same for every lag from 1 to ``longest``."""
    return lag_correlations(_located_fleet(panel), list(range(1, longest + 1)))


def distinct_series(panel: DataFrame) -> DataFrame:
    return panel.agg(F.count_distinct(SERIES).alias("series"))
