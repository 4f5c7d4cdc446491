from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattlane.operators import linear, sampling, scoring
from wattlane.session import scratch_path
from wattlane.sources import readings, sinks
from wattlane.streaming.online import score_stream

MODEL = linear.LinearModel(("lag_1d", "lag_7d"), (0.5, 0.25), 1.0)
CSV = '"";"MT_001";"MT_002"\n2011-01-01 00:15:00;1,5;8\n2011-01-01 00:30:00;;-2,25\n2011-01-01 00:45:00;4;x\n'


@pytest.fixture(scope="module")
def features(spark):
    rows = [
        ("MT_001", datetime(2014, 7, 1, 0, 0), 6.0, 4.0),
        ("MT_001", datetime(2014, 7, 1, 0, 15), 8.0, None),
    ]
    return spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, lag_1d double, lag_7d double")


@pytest.fixture(scope="module")
def requests(spark):
    rows = [
        (1, "MT_001", datetime(2014, 7, 1, 0, 0, 42)),
        (2, "MT_001", datetime(2014, 7, 1, 0, 1)),
        (3, "MT_009", datetime(2014, 7, 1, 0, 0)),
        (4, "MT_001", datetime(2014, 7, 1, 0, 15)),
    ]
    return spark.createDataFrame(rows, "id int, series_id string, ts timestamp_ntz")


def check(rows):
    got = {r.id: r for r in rows}
    assert got[1].prediction == 5.0 and got[1].features.lag_7d == 4.0 and got[1].error is None
    assert got[2].error == "no features for MT_001 at 2014-07-01T00:01"
    assert got[3].error == "no features for MT_009 at 2014-07-01T00:00"
    assert got[4].error == "features missing for MT_001 at 2014-07-01T00:15: lag_7d"
    assert all(got[i].prediction is None and got[i].features is None for i in (2, 3, 4))


def test_requests_fail_one_by_one(features, requests):
    check(scoring.score_requests(requests, features, MODEL).collect())
    with pytest.raises(ValueError):
        scoring.require_requests(requests.limit(0))


def test_stream_gives_the_batch_result(spark, features, requests):
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    requests.write.parquet(source)
    stream = spark.readStream.schema(requests.schema).parquet(source)
    query = score_stream(stream, features, MODEL, out, state)
    query.awaitTermination(60)
    check(spark.read.parquet(out).collect())


def test_champion_is_resolved_before_scoring(spark, features):
    table = linear.coefficient_table(spark, {"1": MODEL}).select(
        F.lit("m").alias("model_name"), F.col("model_id").alias("version"), "feature", "weight"
    )
    events = spark.createDataFrame(
        [("m", "champion", "2", 1), ("m", "champion", "1", 2)],
        "model_name string, alias string, version string, seq long",
    )
    rows = scoring.score_with_champion(features, table, events, "m").collect()
    assert [r.prediction for r in rows] == [5.0, None]
    with pytest.raises(KeyError):
        scoring.model_at_alias(table, events, "m", "shadow")


def test_readings_file(spark, tmp_path):
    path = tmp_path / "raw.txt"
    path.write_text(CSV)
    rows = readings.read_readings_csv(spark, str(path)).orderBy("ts").collect()
    assert [r.ts.minute for r in rows] == [15, 30, 45]
    assert [r.MT_001 for r in rows] == [0.375, None, 1.0]
    assert [r.MT_002 for r in rows] == [2.0, -0.5625, None]
    assert readings.read_readings_csv(spark, str(path), nrows=2).count() == 2
    report = sinks.convert_to_parquet(spark, str(path), str(tmp_path / "wide.parquet")).first()
    assert (report.rows, report.clients) == (3, 2)
    assert readings.read_panel(spark, str(tmp_path / "wide.parquet")).count() == 3


def test_allow_list_and_head(spark, tmp_path, make_panel):
    path = tmp_path / "kept.csv"
    path.write_text("individual\na\na\nc\n")
    allowed = readings.read_allow_list(spark, str(path))
    assert {r.series_id for r in allowed.collect()} == {"a", "c"}
    panel = make_panel({"a": [1.0] * 30})
    sinks.write_head_csv(panel, str(tmp_path / "head"))
    assert spark.read.csv(str(tmp_path / "head"), header=True).count() == 30
    assert sinks.head_rows(panel, 7).count() == 7
    assert sampling.sample_n(panel, 7, sinks.HEAD_SEED).count() == 7


def test_later_metadata_wins(spark):
    rows = [("r", "old", 1.0, 1), ("r", "new", 2.0, 2), ("q", "one", 3.0, 1)]
    df = spark.createDataFrame(rows, "run_id string, run_name string, rmse double, seq int")
    got = {r.run_id: r for r in sinks.metadata_table(df, ["run_name"], ["rmse"], ["rmse"], "seq").collect()}
    assert got["r"].metrics_json == '{"rmse":2.0}' and len(got) == 2
