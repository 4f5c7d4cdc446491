"""Properties of the physical plans that the scale of the library rests on."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattlane.functions.ranking import series_positions
from wattlane.operators import features, filters, panel, splits
from wattlane.plans.catalog import catalog
from wattlane.session import scratch_path
from wattlane.sources import readings


SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, make_panel):
    path = scratch_path(spark, "panel")
    df = make_panel({"a": [float(i) for i in range(50)], "b": [1.0] * 50})
    features.build_features(df, 1, {"lag_1d": 1}, {"rolling_mean_7d": 7}).write.parquet(path)
    return path


@pytest.mark.parametrize(
    "cut",
    [
        lambda df: filters.date_range(df, "2020-01-03", "2020-01-09"),
        lambda df: filters.label_slice(df, "2020-01", "2020-02"),
        lambda df: filters.year_in(df, [2019, 2020]),
        lambda df: splits.split_v1(df, (2018, 2019, 2020, 2021)),
        lambda df: splits.split_v2(df, 2019, "2020-01-15"),
    ],
)
def test_time_filters_reach_the_scan(spark, stored, cut):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = physical(cut(spark.read.parquet(stored)))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert "ThanOrEqual(ts" in pushed or "LessThan(ts" in pushed


def test_scan_reads_only_what_is_asked(spark, stored):
    plan = physical(readings.pruned_scan(spark, stored, ["lag_1d"]))
    assert "ReadSchema: struct<series_id:string,ts:timestamp_ntz,lag_1d:double>" in plan


def test_windows_share_one_shuffle_by_block(spark, stored):
    panel = spark.read.parquet(stored).select("series_id", "ts", "value", "pos")
    plan = physical(features.build_features(panel, 1))
    assert plan.count("Exchange hashpartitioning") == 1
    assert re.search(r"hashpartitioning\(series_id#\d+, _block#\d+L", plan)


def test_no_window_over_a_whole_series(spark, stored):
    panel = spark.read.parquet(stored).select("series_id", "ts", "value")
    plan = physical(series_positions(panel))
    # The only window by series alone runs over one row per day.
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len([w for w in windows if "_day" in w or "_n" in w]) == len(windows)


def test_python_is_not_in_the_row_path(spark, stored):
    df = features.build_features(spark.read.parquet(stored).drop("lag_1d", "rolling_mean_7d"), 1)
    plan = physical(df.groupBy("series_id").agg(F.avg("rolling_mean_7d")))
    assert "Python" not in plan and "Pandas" not in plan


PRUNED = [
    "date_range", "year_in", "label_slice", "at_timestamp", "split_v1", "split_v2", "split_by_ranges",
    "kpi_summary", "persistence_baseline", "timestamp_slice_transpose", "union_parts",
]


@pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")
@pytest.mark.parametrize("name", PRUNED)
def test_registered_queries_prune_their_facts(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = physical(catalog().queries[name](spark, SF))
    scans = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", plan)
    facts = [pushed for pushed, columns in scans if "l_quantity" in columns]
    assert facts
    for pushed in facts:
        assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


def test_part_of_a_panel_equals_the_cut_of_the_whole(spark, make_panel):
    facts = make_panel({"a": [1.0] * 9, "b": [2.0] * 3}).where("series_id = 'a' OR value > 1")
    whole = panel.dense_panel(facts, 86400)
    for start, end in (("2020-01-03", "2020-01-06"), (None, "2020-01-02"), ("2020-01-08", None), ("2019-01-01", "2019-02-01")):
        cut = whole
        if start:
            cut = cut.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
        if end:
            cut = cut.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        got = panel.dense_panel(facts, 86400, start, end)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, cut.collect()))


@pytest.mark.parametrize("name", ["join_features_target", "rejoin_target"])
def test_rows_of_one_panel_are_joined_in_their_blocks(spark, name):
    from __spark_entry__ import queries

    joined = queries()[name](spark, SF)
    joined.collect()
    plan = physical(joined).partition("== Initial Plan")[0]
    # The first exchange below the join is the one that the blocks unfold from: rows that are made are not dealt out again.
    assert "SortMergeJoin" in plan
    below = plan[plan.index("SortMergeJoin") :]
    assert 0 < below.find("Generate explode") < below.index("Exchange")
    queries()["series_stats"](spark, SF)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
