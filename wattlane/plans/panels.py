"""Panels derived from the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.columns import floor_day, floor_hour
from wattlane.operators.features import features_of_facts
from wattlane.operators.panel import dense_panel
from wattlane.schema import KEYS, SERIES, TS, VALUE

DAY = 86400
HOUR = 3600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def between(rows: DataFrame, time: str, start: str | None, end: str | None) -> DataFrame:
    """Rows with ``start`` <= time < ``end``, on the raw column, so the scan can skip files."""
    if start is not None:
        rows = rows.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        rows = rows.where(F.col(time) < F.lit(end).cast("timestamp_ntz"))
    return rows


def daily_facts(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    return between(table(spark, sf_dir, "lineitem"), "l_shipdate", start, end).select(
        F.col("l_suppkey").alias(SERIES),
        floor_day("l_shipdate").alias(TS),
        F.col("l_quantity").cast("bigint").alias(VALUE),
    )


def daily_panel(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Quantity shipped per supplier and day, of the days from ``start`` until before ``end``."""
    facts = daily_facts(spark, sf_dir)
    return dense_panel(facts, DAY, start, end, daily_facts(spark, sf_dir, start, end))


def daily_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timestamps of the daily panel, of which every series has each: the days from the first fact to the last."""
    edge = daily_facts(spark, sf_dir).agg(F.min(TS).alias("lo"), F.max(TS).alias("hi"))
    return edge.select(F.explode(F.sequence("lo", "hi", F.make_dt_interval(days=F.lit(1)))).alias(TS))


def nation_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias(SERIES), F.col("s_nationkey").alias("n_nationkey")
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Sum per supplier before the joins, so they see suppliers and days instead of line items.
    per_supplier = daily_facts(spark, sf_dir).groupBy(*KEYS).agg(F.sum(VALUE).alias(VALUE))
    return (
        per_supplier.join(supplier, SERIES)
        .join(nation, "n_nationkey")
        .select(F.col("n_name").alias(SERIES), TS, VALUE)
    )


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity shipped per supplier nation and day."""
    return dense_panel(nation_facts(spark, sf_dir), DAY)


def hourly_facts(spark: SparkSession, sf_dir: str, key: str = "user_id") -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col(key).alias(SERIES),
        floor_hour("ts").alias(TS),
        F.col("value").cast("decimal(18,2)").alias(VALUE),
    )


def hourly_panel(spark: SparkSession, sf_dir: str, key: str = "user_id") -> DataFrame:
    """Event value per user (or event type) and hour."""
    return dense_panel(hourly_facts(spark, sf_dir, key), HOUR)


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event value per user and day."""
    facts = table(spark, sf_dir, "events").select(
        F.col("user_id").alias(SERIES),
        floor_day("ts").alias(TS),
        F.col("value").cast("decimal(18,2)").alias(VALUE),
    )
    return dense_panel(facts, DAY)


def daily_features(
    spark: SparkSession,
    sf_dir: str,
    start: str | None = None,
    end: str | None = None,
    lags: dict[str, int] | None = None,
    windows: dict[str, int] | None = None,
    blocks: bool = False,
) -> DataFrame:
    """The daily panel with the six default features, or those given, of the days from ``start`` until before ``end``."""

    def within(early: str | None, late: str | None) -> DataFrame:
        return daily_facts(spark, sf_dir, early, late)

    return features_of_facts(
        daily_facts(spark, sf_dir), DAY, 1, lags, windows, start=start, end=end, within=within, blocks=blocks
    )


def hourly_features(spark: SparkSession, sf_dir: str, asked: DataFrame | None = None) -> DataFrame:
    """The hourly panel with lags and means that fit its 30 days; with ``asked``, only the rows of these keys."""
    return features_of_facts(
        hourly_facts(spark, sf_dir),
        HOUR,
        steps_per_day=24,
        lags={"lag_1d": 24, "lag_7d": 168},
        windows={"rolling_mean_7d": 168},
        asked=asked,
    )
