"""Day sums of a stream of readings: watermark, event-time windows, repeated and late rows.

State is kept for the days that rows may still come for, and for the keys seen in that time; both go with the
watermark. The query appends a day once no row for it can come any more, so what it has written never changes, and a
restart from the checkpoint goes on where it ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlane.schema import SERIES, TS, VALUE


def day_sums(readings: DataFrame, lateness: str = "2 days", by_series: bool = False) -> DataFrame:
    """(day, [series_id,] total, readings) of a stream of (series_id, ts, value).

    A row that comes again with the same series and time counts once. Rows later than ``lateness`` behind
    the latest time seen are left out. Days start at midnight in the session's time zone.
    """
    rows = readings.select(SERIES, F.col(TS).cast("timestamp").alias(TS), VALUE).withWatermark(TS, lateness)
    once = rows.dropDuplicatesWithinWatermark([SERIES, TS])
    keys = [F.window(TS, "1 day"), *([F.col(SERIES)] if by_series else [])]
    sums = once.groupBy(*keys).agg(F.sum(VALUE).alias("total"), F.count(VALUE).alias("readings"))
    return sums.select(F.to_date("window.start").alias("day"), *([SERIES] if by_series else []), "total", "readings")


def write_day_sums(
    readings: DataFrame, output: str, checkpoint: str, lateness: str = "2 days", by_series: bool = False
) -> StreamingQuery:
    """Append the day sums of all readings available now to Parquet files and stop."""
    return (
        day_sums(readings, lateness, by_series)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_of_table(spark: SparkSession, path: str, files_at_once: int = 64) -> DataFrame:
    """The files of a Parquet table as a stream, with the table's own columns."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        # A stream watches folders, so a single file is picked by its name.
        return stream.option("pathGlobFilter", place.getName()).option("recursiveFileLookup", "true").parquet(str(place.getParent()))
    return stream.parquet(path)
