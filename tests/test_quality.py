from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.operators import evaluate, filters, panel, profiles, quality
from wattlane.operators.drift import drift_report


def test_gap_and_duplicate_are_found(spark, make_panel):
    full = make_panel({"a": [1.0] * 10, "b": [2.0] * 10}, 900)
    gone = datetime(2020, 1, 1, 1, 0)
    odd = full.where((F.col("series_id") != "a") | (F.col("ts") != F.lit(gone).cast("timestamp_ntz")))
    odd = odd.unionByName(full.where("series_id = 'b'").limit(1))
    steps = {r["step_seconds"]: r["n"] for r in quality.step_histogram(odd).collect()}
    assert steps == {900: 16, 1800: 1, 0: 1}
    assert quality.duplicate_keys(odd).count() == 1
    quality.assert_regular(full, 900)
    with pytest.raises(ValueError):
        quality.assert_regular(odd, 900)
    match = quality.keys_match(full, odd).first()
    assert (match.only_left, match.only_right, match.matches) == (1, 1, False)


def test_key_comparison_of_any_rows(spark):
    rng = np.random.default_rng(3)
    start = datetime(1969, 12, 1)

    def rows(seed):
        out = [("r", start + timedelta(hours=int(h))) for h in range(400) if h % (97 + seed)]
        out += [("odd", start + timedelta(seconds=int(s))) for s in rng.integers(0, 300, 200)]
        out += [(None, start + timedelta(days=d)) for d in range(70 + seed)] + [("r", None)] * (2 + seed) + [("late", start)] * seed
        return [out[i] for i in rng.permutation(len(out))] if seed == 1 else out

    a, b = rows(0), rows(1)
    left, right = (spark.createDataFrame(x, "series_id string, ts timestamp_ntz").repartition(n) for x, n in ((a, 1), (b, 3)))
    have, want = Counter(a), Counter(b)
    want = (sum((have - want).values()), sum((want - have).values()))
    for step in (None, 3600, 7200, 1):
        match = quality.keys_match(left, right, step).first()
        assert (match.only_left, match.only_right) == want
        assert quality.keys_match(left, left.repartition(5), step).first().matches
        assert quality.keys_match(left.where("false"), left.where("false"), step).first().matches


def test_regular_keys_travel_as_bits(spark, monkeypatch):
    keys = spark.range(100_000).selectExpr("id div 25000 AS series_id", "timestamp_ntz'2020-01-01' + make_dt_interval(cast(id % 25000 as int)) AS ts")
    kept = []
    monkeypatch.setattr(quality, "materialize", lambda df, label, write=quality.materialize: kept.append(write(df, label)) or kept[-1])
    match = quality.keys_match(keys, keys.where("ts <> timestamp_ntz'2021-01-01'"), 86400).first()
    assert (match.only_left, match.only_right) == (4, 0)
    assert len(kept) == 1 and kept[0].count() < 100_000 / 60


def test_steps_across_months(make_panel):
    rows = quality.step_histogram(make_panel({"a": [1.0] * 90})).collect()
    assert [(r["step_seconds"], r["n"]) for r in rows] == [(86400, 89)]


def test_zero_series(make_panel):
    p = make_panel({"zero": [0.0] * 4, "late": [0.0, 0.0, 3.0, 1.0]})
    first = {r.series_id: r.first_active for r in quality.first_active(p).collect()}
    assert first == {"zero": datetime(2020, 1, 1), "late": datetime(2020, 1, 3)}
    assert [r.series_id for r in quality.zero_share_ranking(p, 1).collect()] == ["zero"]
    assert filters.complete_history(p, 2020).count() == 0


def test_column_quality_counts_nulls(make_panel):
    rows = {r["column"]: r for r in quality.column_quality(make_panel({"a": [1.0, None, 2.0]})).collect()}
    assert rows["value"]["missing"] == 1 and rows["value"]["missing_pct"] == 33.333
    assert rows["ts"]["dtype"] == "timestamp_ntz"


def test_histogram_closes_last_bin_and_keeps_empty_ones(make_panel):
    p = make_panel({"a": [0.0, 0.0, 1.0, 4.0, 10.0]})
    rows = profiles.histogram(p, bins=5).orderBy("bin").collect()
    want, edges = np.histogram([0, 0, 1, 4, 10], 5)
    assert [r.n for r in rows] == list(want)
    np.testing.assert_allclose([r.left_edge for r in rows], edges[:-1])


def test_quantile_bins_merge_repeated_edges(make_panel):
    values = [0.0] * 6 + [1.0, 2.0, 3.0, 4.0]
    rows = profiles.quantile_bins(make_panel({"a": values}), "value", 5).collect()
    got = {r.value: r.bucket for r in rows}
    # Edges 0, 0, 0, 0.4, 2.2, 4 leave the intervals [0, 0.4], (0.4, 2.2] and (2.2, 4].
    assert got == {0.0: 0, 1.0: 1, 2.0: 1, 3.0: 2, 4.0: 2}


def test_autocorrelation_of_a_daily_cycle(make_panel):
    cycle = [float(np.sin(2 * np.pi * i / 24)) for i in range(240)]
    got = profiles.autocorrelation(make_panel({"a": cycle}, 3600), {"day": 24, "half": 12})
    by = {r.label: r.autocorrelation for r in got.collect()}
    assert by["day"] == pytest.approx(1) and by["half"] == pytest.approx(-1)


def test_correlations_skip_nulls_pairwise(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 7.0, 5.0), (4.0, 8.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.x, r.y): r.correlation for r in profiles.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9
    assert got[("a", "c")] == got[("c", "a")] == pytest.approx(np.corrcoef([2, 3, 4], [1, 5, 2])[0, 1])


def test_long_wide_round_trip(spark):
    rows = [(datetime(2020, 1, 31, 23, 45), 4.0, None), (datetime(2020, 2, 1), 2.0, 8.0)]
    wide = spark.createDataFrame(rows, "ts timestamp_ntz, m1 double, m2 double")
    long = panel.wide_to_long(wide).collect()
    assert len(long) == 4 and {r.year_month for r in long} == {"2020-01", "2020-02"}
    assert panel.wide_to_long_dropna(wide).count() == 3


def test_label_slices(make_panel):
    p = make_panel({"a": [1.0] * 60})
    assert filters.label_slice(p, "2020-02", "2020-02").count() == 29
    assert filters.label_slice(p, None, "2020-01-05").count() == 5
    assert filters.date_range(p, "2020-01-03", "2020-01-04").count() == 2


def test_calendar_fill(make_panel):
    p = make_panel({"a": [1.0, 5.0, 9.0]}).where("value <> 5")
    assert [r.total for r in profiles.resample_daily_sum(p).orderBy("day").collect()] == [1, 0, 9]
    assert [r.fleet_mean for r in profiles.resample_daily_mean(p).orderBy("day").collect()] == [1, None, 9]


def test_weekday_errors_always_have_seven_rows(make_panel):
    scored = make_panel({"a": [4.0, 6.0]}).withColumn("prediction", F.lit(3.0))
    rows = evaluate.residual_mae_by_weekday(scored).orderBy("weekday").collect()
    assert [r.mae for r in rows] == [None, None, 1.0, 3.0, None, None, None]
    assert rows[2].weekday_name == "Wed"


def test_day_curves_have_the_fleet_and_chosen_series(make_panel):
    scored = make_panel({"a": [4.0], "b": [6.0], "c": [8.0]}).withColumn("prediction", F.lit(3.0))
    rows = evaluate.day_curves(scored, "2020-01-01", ["b"], baseline="value").collect()
    assert {r.panel: r.actual for r in rows} == {"all": 6.0, "b": 6.0}


def test_drift_of_a_shifted_feature(make_panel):
    same = [float(i % 50) for i in range(400)]
    df = make_panel({"a": same, "b": same}).withColumn(
        "part", F.when(F.col("series_id") == "a", "train").otherwise("test")
    )
    moved = F.when(F.col("part") == "test", F.col("value") + 20).otherwise(F.col("value"))
    rows = {r.feature: r for r in
            drift_report(df.withColumn("moved", moved), ["value", "moved"]).collect()}
    assert rows["value"].ks == 0 and not rows["value"].drifted and rows["value"].psi < 1e-9
    assert rows["moved"].drifted and rows["moved"].ks == pytest.approx(0.4)
    assert rows["moved"].wasserstein == pytest.approx(20 / np.std(same), rel=0.01)
    assert rows["moved"].drift_share == 0.5 and rows["moved"].dataset_drift


def test_block_lags_equal_pairs_of_rows(spark):
    import numpy as np

    from wattlane.functions import lagged

    rng = np.random.default_rng(8)
    x = np.cumsum(rng.normal(size=900)) + 1e6
    gone = rng.random(900) < 0.1
    series = spark.createDataFrame([(i, None if g else float(v)) for i, (v, g) in enumerate(zip(x, gone))], "pos long, value double").where("pos not in (5, 6, 400)")
    lags = [1, 2, 24, 130, 167, 898, 950]
    block, lagged.BLOCK = lagged.BLOCK, 64
    try:
        got = {r.lag: r.autocorrelation for r in lagged.lag_correlations(series, lags).collect()}
    finally:
        lagged.BLOCK = block
    x[gone | np.isin(np.arange(900), [5, 6, 400])] = np.nan
    for k in lags[:5]:
        both = ~np.isnan(x[k:]) & ~np.isnan(x[:-k])
        assert got[k] == pytest.approx(np.corrcoef(x[k:][both], x[:-k][both])[0, 1], abs=1e-8)
    assert 950 not in got
    flat = spark.range(100).select(F.col("id").alias("pos"), F.lit(0.1).alias("value"))
    assert all(np.isnan(r.autocorrelation) for r in lagged.lag_correlations(flat, [1, 5]).collect())
    plan = lagged.lag_correlations(series, list(range(1, 800)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1


def test_drift_equals_a_plain_version(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    ref, cur = np.round(rng.normal(0, 1, 700), 2), np.round(rng.normal(0.3, 2, 400), 2)
    few = (np.repeat([0.0, 5.0], [350, 350]), np.tile([1.0, 2.5, 4.0, 9.0], 100))
    rows = [("train", float(a), float(b), None) for a, b in zip(ref, few[0])] + [("test", float(a), float(b), float("nan")) for a, b in zip(cur, few[1])]
    got = {r.feature: r for r in drift_report(spark.createDataFrame(rows, "part string, a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert set(got) == {"a", "b"}
    for name, (p, q) in {"a": (ref, cur), "b": few}.items():
        edges = np.quantile(p, np.arange(1, 10) / 10)
        counts = [np.bincount((edges[None] < v[:, None]).sum(1), minlength=10) for v in (p, q)]
        a, b = ((c + 0.5) / (c.sum() + 5.0) for c in counts)
        assert got[name].psi == pytest.approx(((b - a) * np.log(b / a)).sum(), rel=1e-12)
        lo, hi = min(p.min(), q.min()), max(p.max(), q.max())
        shares = [np.cumsum(np.bincount(np.minimum((v - lo) // ((hi - lo) / 1000), 999).astype(int), minlength=1000)) / len(v) for v in (p, q)]
        assert got[name].ks == pytest.approx(np.abs(shares[0] - shares[1]).max(), abs=1e-12)
