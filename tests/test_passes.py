"""How often a query reads the rows it is made of, and how many rows it makes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wattlane.operators import features, filters
from wattlane.operators.drift import drift_report
from wattlane.operators.splits import expanding_cv_warmup
from wattlane.plans import model_queries, panels
from wattlane.plans.catalog import catalog
from wattlane.schema import FEATURES

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")


def counted(df):
    """``df`` and a counter of the rows that are read from it."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def count_features(monkeypatch, made):
    """Count the rows that are read of every panel of features made from here on."""
    whole = panels.daily_features

    def watched(*args, **options):
        df, seen = counted(whole(*args, **options))
        made.append(seen)
        return df

    monkeypatch.setattr(panels, "daily_features", watched)


def test_timestamps_are_read_once(make_panel):
    df, seen = counted(make_panel({"a": [1.0] * 31, "b": [2.0] * 31}))
    folds = expanding_cv_warmup(df, 3, 7)
    assert [f.val_start.day for f in folds] == [14, 20, 26]
    assert seen.value == 62


@needs_tables
@pytest.mark.parametrize("name", ["overfit_table", "drift_by_year", "drift_by_year_density"])
def test_features_are_made_once(spark, monkeypatch, name):
    made = []
    count_features(monkeypatch, made)
    assert catalog().queries[name](spark, SF).collect()
    days = model_queries.V1_DAYS if name != "overfit_table" else ()
    monkeypatch.undo()
    assert [s.value for s in made] == [panels.daily_features(spark, SF, *days).count()]


def test_drift_reads_its_rows_three_times(make_panel):
    df = make_panel({"a": [float(i % 37) for i in range(400)], "b": [float(i) for i in range(400)]})
    df = df.withColumn("part", F.when(F.dayofyear("ts") < 200, "train").otherwise("test"))
    rows, seen = counted(df)
    drift_report(rows, ["value"]).collect()
    assert seen.value == 3 * 800


def test_features_of_a_period(spark, make_panel):
    facts = make_panel({"a": [float(i * i % 17) for i in range(60)], "b": [float(i) for i in range(7, 67)]})
    facts = facts.where("value % 3 <> 1").withColumn("value", F.col("value").cast("bigint"))
    made = []

    def within(start, end):
        made.append((start, end))
        return panels.between(facts, "ts", start, end)

    def change(rows):
        df, seen = counted(rows)
        made.append(seen)
        return df

    options = {"lags": {"lag_1d": 1, "lag_7d": 7}, "windows": {"mean_3": 3, "mean_7": 7}}
    whole = features.features_of_facts(facts, 86400, 1, **options)
    for start, end in (("2020-02-01", "2020-02-11"), ("2020-01-04", "2020-01-06"), ("2019-01-01", None)):
        got = features.features_of_facts(facts, 86400, 1, **options, start=start, end=end, within=within)
        want = panels.between(whole, "ts", start, end)
        assert sorted(got.collect()) == sorted(want.collect()) and got.count()
    assert made[0] == ("2020-01-24T00:00:00", "2020-02-11")
    made.clear()
    cut = features.features_of_facts(facts, 86400, 1, **options, change=change, start="2020-02-01", end="2020-02-11")
    assert len(cut.collect()) == 20
    # Ten days and the eight that these look back on, of both series.
    assert made[0].value == 36


@needs_tables
def test_a_split_makes_the_rows_of_its_days(spark, monkeypatch):
    made = []
    count_features(monkeypatch, made)
    got = model_queries.prepared(spark, SF)
    monkeypatch.undo()
    whole = filters.drop_incomplete(panels.daily_features(spark, SF), FEATURES)
    assert got.count() == model_queries.split_v1(whole).count()
    assert made[0].value == panels.daily_panel(spark, SF, *model_queries.V1_DAYS).count()


def test_only_asked_rows_of_features_leave_their_blocks(spark, make_panel):
    facts = make_panel({"a": [float(i * i % 17) for i in range(60)], "b": [float(i) for i in range(60)]})
    facts = facts.where("value % 3 <> 1").withColumn("value", F.col("value").cast("bigint"))
    options = {"lags": {"lag_1d": 1, "lag_7d": 7}, "windows": {"mean_7": 7}, "min_block": 16}
    whole = features.features_of_facts(facts, 86400, 1, **options)
    # Unknown series, times off the grid and outside of the panel, a null series, repeated keys and steps without a fact.
    keys = [("a", "2020-01-01"), ("a", "2020-01-17"), ("a", "2020-01-28"), ("b", "2020-02-01"), ("b", "2020-02-02"), ("a", "2020-01-17"),
            ("c", "2020-01-05"), ("a", "2020-01-05 12:00:00"), ("b", "2021-01-01"), (None, "2020-01-05")]
    asked = spark.createDataFrame(keys, "series_id string, t string").select("series_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    got = features.features_of_facts(facts, 86400, 1, **options, asked=asked)
    want = whole.join(asked.distinct(), ["series_id", "ts"], "left_semi")
    assert got.columns == whole.columns
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 5
    assert {r["value"] for r in got.collect()} > {0}


@needs_tables
def test_lookups_join_requested_rows_only(spark, monkeypatch):
    made = []
    whole = panels.hourly_features

    def watched(*args):
        df, seen = counted(whole(*args))
        made.append(seen)
        return df

    monkeypatch.setattr(panels, "hourly_features", watched)
    rows = catalog().queries["lookup_features"](spark, SF).collect()
    assert len(rows) == 1000 and 0 < made[0].value <= 1000


@needs_tables
def test_alpha_cv_writes_no_features(spark, monkeypatch):
    """The folds come from the days of the panel; the features go to the moments at once, and are made once."""
    times = panels.daily_times(spark, SF)
    assert times.exceptAll(panels.daily_panel(spark, SF).select("ts").distinct()).isEmpty()
    assert times.count() == panels.daily_panel(spark, SF).select("ts").distinct().count()
    made, written = [], []
    count_features(monkeypatch, made)
    monkeypatch.setattr(model_queries, "materialize", lambda df, label: written.append(label) or df)
    assert catalog().queries["alpha_cv"](spark, SF).count() == 3
    assert not written and [seen.value for seen in made] == [panels.daily_panel(spark, SF).count()]
