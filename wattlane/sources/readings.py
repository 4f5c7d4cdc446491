"""Readers for meter readings and key lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.columns import to_kwh
from wattlane.schema import KEYS, SERIES, TS

# Fixed value: timestamp format of the readings file.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def decimal_comma(name: str) -> Column:
    return F.translate(F.col(f"`{name}`"), ",", ".").try_cast("float")


def read_readings_csv(
    spark: SparkSession, path: str, nrows: int | None = None, intervals_per_hour: int = 4
) -> DataFrame:
    """Wide frame of energy per interval from a ``;`` separated file with decimal commas.

    The first column, unnamed in the header, is the timestamp. Only the header is read to
    learn the columns; a cell that is no number becomes null. ``nrows`` keeps the first rows by time.
    """
    raw = spark.read.csv(path, sep=";", header=True)
    first, *meters = raw.columns
    out = raw.select(
        F.to_timestamp_ntz(F.col(f"`{first}`"), F.lit(TIME_FORMAT)).alias(TS),
        *[to_kwh(decimal_comma(m), intervals_per_hour).cast("float").alias(m) for m in meters],
    )
    return out if nrows is None else out.orderBy(TS).limit(nrows)


def read_panel(spark: SparkSession, path: str, nrows: int | None = None) -> DataFrame:
    """Wide frame by file suffix: Parquet as stored, anything else as a readings file."""
    if not path.rstrip("/").endswith(".parquet"):
        return read_readings_csv(spark, path, nrows)
    df = spark.read.parquet(path)
    if "timestamp" in df.columns:
        df = df.withColumnRenamed("timestamp", TS)
    return df.orderBy(TS).limit(nrows) if nrows is not None else df


def pruned_scan(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Keys and the named columns in single precision; the scan reads no other column."""
    return spark.read.parquet(path).select(*KEYS, *[F.col(n).cast("float").alias(n) for n in names])


def read_allow_list(spark: SparkSession, path: str, column: str = "individual") -> DataFrame:
    return spark.read.csv(path, header=True).select(F.col(column).alias(SERIES)).distinct()
