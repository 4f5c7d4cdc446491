import numpy as np
import pandas as pd
import pytest

from wattlane.functions.ranking import series_positions
from wattlane.operators.features import (
    build_features,
    features_of_facts,
    in_blocks,
    persistence_errors,
    step_label,
    sub_day_lags,
)
from wattlane.operators.joins import rejoin_target
from wattlane.operators.panel import dense_panel


def expected(values, lags, windows, inclusive):
    s = pd.Series(values, dtype="float64")
    out = {f"l{k}": s.shift(k) for k in lags}
    base = s if inclusive else s.shift(1)
    out |= {f"w{k}": base.rolling(k).mean() for k in windows}
    return pd.DataFrame(out)


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("min_block", [16, 100000])
def test_blocks_equal_whole_series_windows(make_panel, inclusive, min_block):
    rng = np.random.default_rng(1)
    series = {"ramp": [float(i) for i in range(140)], "noise": rng.normal(50, 9, 137).tolist()}
    series["holes"] = [None if i in (5, 60, 61) else float(i % 11) for i in range(90)]
    got = build_features(
        make_panel(series),
        1,
        lags={"l1": 1, "l4": 4},
        windows={"w3": 3, "w7": 7},
        inclusive=inclusive,
        min_block=min_block,
    ).toPandas()
    for name, values in series.items():
        mine = got[got.series_id == name].sort_values("ts").reset_index(drop=True)
        want = expected(values, [1, 4], [3, 7], inclusive)
        assert len(mine) == len(values)
        for column in want:
            np.testing.assert_allclose(mine[column], want[column], rtol=1e-9, atol=1e-9)


def test_nan_counts_as_missing_only_while_in_the_window(make_panel):
    values = [1.0, float("nan"), 3.0, 4.0, 5.0, float("inf"), 7.0, 8.0, 9.0]
    got = build_features(make_panel({"a": values}), 1, lags={}, windows={"w2": 2}).toPandas()
    w2 = list(got.sort_values("ts")["w2"])
    assert w2[4] == 3.5 and w2[8] == 7.5
    assert all(pd.isna(w2[i]) for i in (0, 1, 2, 3, 6, 7))


def test_features_at_a_time_ignore_that_time(make_panel):
    base = [float(i * i % 17) for i in range(40)]
    changed = base.copy()
    changed[25] = 999.0
    a, b = (
        build_features(make_panel({"a": v}), 1, {"l1": 1}, {"w5": 5}).toPandas().sort_values("ts")
        for v in (base, changed)
    )
    np.testing.assert_allclose(a["w5"][:26], b["w5"][:26])
    assert a["l1"].iloc[25] == b["l1"].iloc[25] and a["l1"].iloc[26] != b["l1"].iloc[26]


def test_sub_day_lags_have_their_own_names(make_panel):
    got = sub_day_lags(make_panel({"a": [float(i) for i in range(800)]}, 900), 96).toPandas()
    last = got.sort_values("ts").iloc[-1]
    assert (last.lag_1_step, last.lag_1h, last.lag_24h, last.lag_7d) == (798, 795, 703, 127)
    assert [step_label(k, 96) for k in (672, 4, 1)] == ["7d", "1h", "1s"]


def test_persistence_lags_before_cutting(make_panel):
    panel = make_panel({"a": [float(i % 7) for i in range(30)]})
    rows = persistence_errors(panel, {"day": 1, "week": 7}, "2020-01-20", "2020-01-31").collect()
    by = {r["baseline"]: r for r in rows}
    assert by["week"]["rmse"] == 0 and by["week"]["n"] == 11
    assert by["day"]["rmse"] > 1


def test_dense_panel_fills_gaps_with_zero(make_panel, spark):
    facts = make_panel({"a": [5, 0, 2], "b": [1]}, kind="long").where("value > 0")
    rows = dense_panel(facts, 86400).orderBy("series_id", "pos").collect()
    assert [(r.series_id, r.pos, r.value) for r in rows] == [
        ("a", 0, 5), ("a", 1, 0), ("a", 2, 2), ("b", 0, 1), ("b", 1, 0), ("b", 2, 0)
    ]


def test_a_dominant_series_is_spread_over_bounded_groups(make_panel):
    panel = make_panel({"hot": [1.0] * 2000, **{f"s{i}": [1.0] * 40 for i in range(100)}})
    blocked = in_blocks(series_positions(panel), lookback=10, min_block=64)
    sizes = [r["count"] for r in blocked.groupBy("series_id", "_block").count().collect()]
    assert max(sizes) <= 64 + 10
    assert blocked.where("not _lead_in").count() == 6000
    assert blocked.count() <= 6000 * 1.25


def test_means_of_doubles_forget_what_has_left_the_window(make_panel):
    values = [1e6 + i * 0.37 for i in range(2000)] + [0.1] * 40
    for inclusive in (False, True):
        panel = make_panel({"a": values})
        rows = build_features(
            panel, 1, lags={}, windows={"m": 7}, inclusive=inclusive, min_block=100
        ).orderBy("ts").collect()
        shift = 0 if inclusive else 1
        for i, row in enumerate(rows):
            window = values[max(0, i - shift - 6) : i - shift + 1]
            if len(window) < 7:
                assert row.m is None
            else:
                assert abs(row.m - sum(window) / 7) <= 1e-9 * max(1, abs(row.m))
        assert abs(rows[-1].m - 0.1) < 1e-12


def sparse_facts(spark, series=40, steps=3000):
    """Two facts for each series, at its own place and at the end; the first series has one on the first day."""
    days = "timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(d)"
    return spark.range(series).selectExpr(
        "id AS series_id", f"explode(array(int(id * 7), {steps - 1})) AS d", "id + 1 AS value"
    ).selectExpr("series_id", f"{days} AS ts", "value")


@pytest.mark.parametrize("doubles", [False, True])
def test_features_unfolded_in_blocks_equal_those_of_the_panel(spark, doubles):
    facts = sparse_facts(spark, 5, 400)
    lags, windows = {"l3": 3, "l10": 10}, {"w7": 7}
    change = (lambda df: df.withColumn("value", df.value.cast("double") / 3)) if doubles else (lambda df: df)
    got = features_of_facts(facts, 86400, 1, lags, windows, min_block=16, change=change)
    want = build_features(change(dense_panel(facts, 86400)), 1, lags, windows, min_block=100000)
    assert got.columns == want.columns
    assert got.count() == 5 * 400
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_dense_panel_keeps_positions_in_a_period_and_skips_what_is_off_the_grid(spark):
    facts = spark.sql(
        """SELECT series_id, CAST(ts AS TIMESTAMP_NTZ) AS ts, value FROM VALUES ('a', '2000-01-01', 5),
        ('a', '2000-01-09', 4), ('a', '2000-01-04', 2), ('a', '2000-01-05 06:00:00', 9), (NULL, '2000-01-04', 3),
        ('b', NULL, 1) AS t(series_id, ts, value)"""
    )
    rows = dense_panel(facts, 86400, "2000-01-03", "2000-01-05 12:00:00").collect()
    got = {(r.series_id, r.ts.day, r.pos): r.value for r in rows}
    assert got == {(s, d, d - 1): 2 if (s, d) == ("a", 4) else 0 for s in ("a", "b", None) for d in (3, 4, 5)}


def test_a_panel_that_unfolds_from_little_is_not_broadcast(spark):
    facts = sparse_facts(spark)
    target = dense_panel(facts, 86400).where("value > 0").select("series_id", "ts", "value")
    features = features_of_facts(facts, 86400, 1, {"l7": 7}, {}).select("series_id", "ts", "l7")
    joined = rejoin_target(features, target)
    assert joined.where("value IS NOT NULL").count() == 80 and joined.count() == 120000
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "BroadcastExchange" not in plan
