from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wattlane.operators.profiles import resample_daily_sum
from wattlane.streaming.daily import stream_of_table, write_day_sums

START = datetime(2024, 3, 1)


def readings(days, hours=(0, 5, 23), series=("a", "b")):
    return [(s, START + timedelta(days=d, hours=h), d * 100 + h + (s == "b")) for d in days for h in hours for s in series]


def test_late_and_repeated_files_equal_the_batch_query(spark, tmp_path):
    source, output, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "series_id string, ts timestamp_ntz, value long"

    def drop(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        write_day_sums(stream_of_table(spark, source, 1), output, checkpoint).awaitTermination()
        return {r.day: (r.total, r.readings) for r in spark.read.parquet(output).collect()}

    late = readings([1], hours=(7,))
    drop(readings([0, 1]))
    assert run() == {}  # two days may still get rows
    drop(readings([2]) + late + readings([1]))  # a late file, and one day again
    drop(late)
    drop(readings([5]))
    first = run()
    assert sorted(first) == [(START + timedelta(days=d)).date() for d in (0, 1, 2)]
    drop(readings([0], hours=(9,)))  # too late: its day is written
    drop(readings([9]))
    second = run()
    assert first.items() <= second.items() and spark.read.parquet(output).count() == len(second) == 4
    every = spark.createDataFrame(readings([0, 1, 2, 5]) + late, schema)
    batch = {r.day: r.total for r in resample_daily_sum(every).collect() if r.total}
    assert {d: t for d, (t, _) in second.items()} == batch
    assert second[(START + timedelta(days=1)).date()][1] == 8


def test_sums_by_series(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame(readings([0, 4]), "series_id string, ts timestamp_ntz, value long").write.parquet(source)
    write_day_sums(stream_of_table(spark, source), str(tmp_path / "out"), str(tmp_path / "state"), "1 day", True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).where(F.col("series_id") == "b").collect()
    assert [(r.day, r.total) for r in got] == [(START.date(), 31)]
