"""Metrics, residual tables and comparisons on a scored panel (``value``, ``prediction``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.columns import weekday_name
from wattlane.functions.quantiles import exact_quantiles
from wattlane.operators.features import persistence_errors
from wattlane.operators.filters import in_years, label_slice
from wattlane.operators.profiles import histogram, histogram_2d, histogram_density, quantile_bins
from wattlane.operators.profiles import year_stats
from wattlane.schema import SERIES, TS, VALUE

PREDICTION = "prediction"


def residual(actual: str = VALUE, predicted: str = PREDICTION) -> Column:
    return F.col(actual).cast("double") - F.col(predicted).cast("double")


def rmse(error: Column) -> Column:
    return F.sqrt(F.avg(error * error))


def with_residual(scored: DataFrame) -> DataFrame:
    return scored.withColumn("residual", residual())


def regression_metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row count, RMSE, MAE, R² and mean residual; R² is null for a constant target."""
    e, y = residual(), F.col(VALUE).cast("double")
    spread = F.var_pop(F.when(e.isNotNull(), y))
    return scored.groupBy(*(by or [])).agg(
        F.count(e).alias("n"),
        rmse(e).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.when(spread > 0, 1 - F.avg(e * e) / spread).alias("r2"),
        F.avg(e).alias("bias"),
    )


def _mae_by(scored: DataFrame, key: Column) -> DataFrame:
    return scored.groupBy(key).agg(F.avg(F.abs(residual())).alias("mae"))


def residual_mae_by_hour(scored: DataFrame) -> DataFrame:
    return _mae_by(scored, F.hour(TS).cast("bigint").alias("hour"))


def residual_mae_by_month(scored: DataFrame) -> DataFrame:
    return _mae_by(scored, F.month(TS).cast("bigint").alias("month"))


def residual_mae_by_weekday(scored: DataFrame) -> DataFrame:
    """Always seven rows; a weekday without rows has a null error."""
    week = scored.sparkSession.range(7).select(F.col("id").alias("weekday"))
    found = _mae_by(scored, F.weekday(TS).cast("bigint").alias("weekday"))
    return week.join(found, "weekday", "left").withColumn("weekday_name", weekday_name("weekday"))


def residual_mae_by_series(scored: DataFrame, k: int | None = 25) -> DataFrame:
    """Series by descending error; the worst ``k``, or all."""
    table = _mae_by(scored, F.col(SERIES))
    return table if k is None else table.orderBy(F.desc("mae"), SERIES).limit(k)


def residual_rmse_by_weekday(scored: DataFrame) -> DataFrame:
    return scored.groupBy(F.weekday(TS).cast("bigint").alias("weekday")).agg(
        rmse(residual()).alias("rmse")
    )


def residual_rmse_by_hour(scored: DataFrame) -> DataFrame:
    return scored.groupBy(F.hour(TS).cast("bigint").alias("hour")).agg(
        rmse(residual()).alias("rmse")
    )


def residual_distribution(scored: DataFrame, bins: int = 80) -> DataFrame:
    return histogram(with_residual(scored), "residual", bins)


def residual_density_2d(scored: DataFrame, bins: int = 120) -> DataFrame:
    return histogram_2d(with_residual(scored), PREDICTION, "residual", bins)


def error_by_level(scored: DataFrame, buckets: int = 10) -> DataFrame:
    """Error by quantile bucket of the actual value, also relative to the bucket's level."""
    e = residual()
    return (
        quantile_bins(scored, VALUE, buckets)
        .groupBy("bucket")
        .agg(F.avg(F.col(VALUE).cast("double")).alias("mean_actual"), rmse(e).alias("rmse"))
        .withColumn(
            "rmse_pct_of_level",
            100 * F.col("rmse") / F.greatest(F.col("mean_actual"), F.lit(1e-9)),
        )
    )


def rmse_per_series(scored: DataFrame) -> DataFrame:
    e = residual()
    return scored.groupBy(SERIES).agg(
        rmse(e).alias("rmse"), F.sum(e * e).alias("_sq"), F.count(e).alias("_n")
    )


def rmse_per_series_summary(scored: DataFrame) -> DataFrame:
    """Pooled error beside the worst, median and best series."""
    table = rmse_per_series(scored)
    median = exact_quantiles(table, "rmse", {"m": 0.5}).scalar()
    return table.agg(
        F.sqrt(F.sum("_sq") / F.sum("_n")).alias("pooled"),
        F.max("rmse").alias("worst"),
        F.min("rmse").alias("best"),
    ).withColumn("median", median)


def day_curves(scored: DataFrame, day: str, series: list, baseline: str = "lag_1d") -> DataFrame:
    """Actual, prediction and baseline by timestamp of one day: the fleet and chosen series."""
    curves = [
        F.avg(F.col(c).cast("double")).alias(name)
        for name, c in (("actual", VALUE), ("predicted", PREDICTION), ("baseline", baseline))
    ]
    cut = label_slice(scored, day, day)
    chosen = F.when(F.col(SERIES).isin(series), F.col(SERIES).cast("string"))
    panels = F.array_compact(F.array(F.lit("all"), chosen))
    return cut.withColumn("panel", F.explode(panels)).groupBy("panel", TS).agg(*curves)


def observed_vs_predicted(scored: DataFrame) -> DataFrame:
    """Pairs with the bounds both axes share."""
    y, p = F.col(VALUE).cast("double"), F.col(PREDICTION)
    bounds = scored.agg(
        F.struct(
            F.least(F.min(y), F.min(p)).alias("low"), F.greatest(F.max(y), F.max(p)).alias("high")
        )
    ).scalar()
    return scored.select(
        SERIES,
        TS,
        y.alias("actual"),
        p.alias("predicted"),
        bounds["low"].alias("axis_low"),
        bounds["high"].alias("axis_high"),
    )


def metric_comparison(results: DataFrame, label: str, metric: str) -> DataFrame:
    return results.select(label, metric).orderBy(metric, label)


def beats_naive(
    scored: DataFrame,
    panel: DataFrame,
    lags: dict[str, int],
    start: str,
    end: str,
    slack: float = 1.01,
) -> DataFrame:
    """The model's RMSE against each persistence baseline over the same period."""
    model = regression_metrics(scored).select("rmse").scalar()
    naive = persistence_errors(panel, lags, start, end)
    return naive.select(
        "baseline",
        F.col("rmse").alias("naive_rmse"),
        model.alias("model_rmse"),
        (model <= slack * F.col("rmse")).alias("beats"),
    )


def year_drift_stats(df: DataFrame, columns: list[str], years: list[int]) -> DataFrame:
    """Statistics of each column in each year."""
    stats = [year_stats(df, years, name).select(F.lit(name).alias("column"), "*") for name in columns]
    return reduce(DataFrame.unionByName, stats)


def year_drift_densities(df: DataFrame, columns: list[str], years: list[int], bins: int = 20) -> DataFrame:
    """Density histogram of each column in each year, over limits shared by the years."""
    cut = df.where(in_years(years)).withColumn("year", F.year(TS).cast("bigint"))
    shapes = [histogram_density(cut, "year", name, bins).select(F.lit(name).alias("column"), "*") for name in columns]
    return reduce(DataFrame.unionByName, shapes)
