from types import SimpleNamespace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattlane.functions.columns import epoch_seconds, floor_minute, value_bin
from wattlane.functions.quantiles import exact_quantiles
from wattlane.functions.ranking import ranked, series_positions, time_index
from wattlane.session import shared_folder


def test_quantiles_equal_numpy_per_group(spark):
    rng = np.random.default_rng(3)
    groups = {
        "wide": rng.normal(0, 1e6, 701),
        "ties": rng.integers(-3, 4, 500).astype(float),
        "one": np.array([4.5]),
        "zero": np.zeros(50),
    }
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows + [("one", None)], "g string, v double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    for row in exact_quantiles(df, "v", probs, ["g"]).collect():
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(groups[row["g"]], p), rel=1e-12, abs=1e-12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=2, max_size=60))
def test_value_bins_are_monotone(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = df.select("v", value_bin("v").alias("b")).orderBy("v").collect()
    assert all(a["b"] <= b["b"] for a, b in zip(rows, rows[1:]))


def test_rank_and_running_sum_with_one_dominant_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i % 5, i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v long, id long")
    got = ranked(df, [F.desc("v"), F.asc("id")], ["g"], {"cum": "v"}).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values(["v", "id"], ascending=[False, True]).reset_index(drop=True)
        assert list(part["rank"]) == list(range(1, len(part) + 1))
        assert list(part["cum"]) == list(part["v"].cumsum())


def test_rank_splits_ties_over_partitions(spark):
    df = spark.range(400).withColumn("v", F.lit(1))
    got = ranked(df, [F.asc("v"), F.asc("id")]).toPandas().sort_values("id")
    assert list(got["rank"]) == list(range(1, 401))


def test_positions_follow_time(spark, make_panel):
    panel = make_panel({"a": range(70), "b": range(3)}, kind="long")
    rows = series_positions(panel).toPandas().sort_values(["series_id", "ts"])
    assert list(rows[rows.series_id == "a"]["pos"]) == list(range(70))
    index = time_index(panel).toPandas().sort_values("ts")
    assert list(index["pos"]) == list(range(70))


def test_wall_clock_does_not_depend_on_the_session_zone(spark, make_panel):
    panel = make_panel({"a": [1.0] * 8}, step_seconds=1800)
    zone = spark.conf.get("spark.sql.session.timeZone")
    want = [r[0] for r in panel.select(epoch_seconds("ts")).collect()]
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
        got = panel.select(epoch_seconds("ts"), floor_minute("ts"), "ts").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in got] == want
    assert all(r[1] == r[2] for r in got)


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):  # noqa: N802
        return self.folder

    def setCheckpointDir(self, folder):  # noqa: N802
        self.folder = folder


def test_the_clusters_folder_is_used_and_required():
    def session(master, conf, folder=None):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)),
            sparkContext=FakeContext(master, folder),
        )

    cluster = session("spark://host", {"spark.checkpoint.dir": "hdfs://shared/cut/"})
    assert shared_folder(cluster) == "hdfs://shared/cut"
    assert cluster.sparkContext.folder == "hdfs://shared/cut/"
    with pytest.raises(RuntimeError):
        shared_folder(session("spark://host", {}))


def test_weighted_quantiles_equal_repeated_rows(spark):
    rows = [(1.0, 3), (2.0, 1), (10.0, 4)]
    df = spark.createDataFrame(rows, "v double, n int")
    values = [v for v, n in rows for _ in range(n)]
    row = exact_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.9}, weight="n").first()
    assert list(row) == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.9])))


def test_discard_deletes_only_the_tables_that_are_read(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    from wattlane.session import discard, materialize

    one, two = materialize(spark.range(5), "one"), materialize(spark.range(7), "two")
    paths = [Path(urlparse(df.inputFiles()[0]).path).parent for df in (one, two)]
    discard(one.where("id > 2"), spark.range(3).toDF("id"))
    assert not paths[0].exists() and two.count() == 7
    discard(two)
    assert not paths[1].exists()


def test_quantiles_narrow_until_bins_fit(spark):
    from wattlane.functions.quantiles import narrow

    # A million distinct values within 0.1 % and one value a third of the rows.
    df = spark.range(1_000_000).select(
        F.lit("dense").alias("g"), (F.lit(1000.0) + F.col("id") / 1e6).alias("_v"), F.lit(1).cast("bigint").alias("_n")
    )
    hot = spark.range(500_000).select(F.lit("hot"), F.lit(7.25), F.lit(1).cast("bigint"))
    df = df.union(hot).cache()
    probs = {"a": 0.25, "b": 0.5, "c": 0.999999}
    found = narrow(df, ["g"], list(probs.values()), limit=1000)
    sizes = [r["count"] for part in found.to_sort for r in part.groupBy("g", "_parent", "_bin").count().collect()]
    assert len(found.to_sort) > 1 and sizes and max(sizes) <= 1000
    assert [r.g for r in found.points.select("g").distinct().collect()] == ["hot"]
    got = {r.g: r for r in exact_quantiles(df, "_v", probs, ["g"], limit=1000).collect()}
    values = 1000 + np.arange(1_000_000) / 1e6
    for name, p in probs.items():
        assert got["hot"][name] == 7.25 and got["dense"][name] == pytest.approx(np.quantile(values, p), rel=1e-15)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([0.0, -0.0, 1.5, 1.5000001, -3.0, 5e-324, -1e-310, 1e300, -1e308, 2.0**-1030]), min_size=1, max_size=40), st.integers(1, 4))
def test_quantiles_of_extreme_values_at_any_limit(spark, values, limit):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    row = exact_quantiles(df, "v", {"a": 0.0, "b": 0.3, "c": 1.0}, limit=limit).first()
    low = np.sort(values)
    place = 0.3 * (len(values) - 1)
    a, b = low[int(np.floor(place))], low[int(np.ceil(place))]
    assert (row.a, row.c) == (min(values), max(values))
    assert row.b == pytest.approx(a + (b - a) * (place - np.floor(place)), rel=1e-12, abs=0)


def test_settled_keeps_its_result_only(spark):
    from wattlane import session

    kept = session.materialize(spark.range(4), "kept")
    inner = []

    def make():
        inner.append(session.materialize(spark.range(6).repartition(3, "id"), "inner"))
        return inner[0].where("id > 1")

    result = session.settled(make, spark, "result")
    assert result.count() == 4 and kept.count() == 4
    assert not any("wattlane-inner" in p for p in session._made)
