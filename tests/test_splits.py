from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattlane.operators import sampling, splits


def times(df, condition):
    return {r.ts for r in df.where(condition).collect()}


@pytest.mark.parametrize(("n", "train"), [(2, 1), (5, 4), (10, 8)])
def test_chronological_split_keeps_timestamps_whole(make_panel, n, train):
    df = splits.split_chronological(make_panel({"a": [1.0] * n, "b": [2.0] * n}), 0.8)
    a, b = times(df, "part = 'train'"), times(df, "part = 'test'")
    assert len(a) == train and not a & b and max(a) < min(b)


def test_chronological_split_clamps_and_fails(make_panel):
    df = splits.split_chronological(make_panel({"a": [1.0] * 5}), 0.0)
    assert df.where("part = 'train'").count() == 1
    df = splits.split_chronological(make_panel({"a": [1.0] * 5}), 1.0)
    assert df.where("part = 'test'").count() == 1
    with pytest.raises(ValueError):
        splits.split_chronological(make_panel({"a": [1.0]}), 0.5)


def test_year_splits_at_midnight(make_panel):
    df = make_panel({"a": [1.0] * 4}, 900, datetime(2014, 12, 31, 23, 30))
    assert splits.split_v1(df).count() == 2
    assert splits.split_v2(df).where("part = 'test'").count() == 4
    with pytest.raises(ValueError):
        splits.build_temporal_split(df, "v3")


def test_warmup_folds(make_panel):
    df = make_panel({"a": [1.0] * 31})
    folds = splits.expanding_cv_warmup(df, 3, 7)
    assert [(f.val_start.day, f.val_end.day) for f in folds] == [(14, 19), (20, 25), (26, 31)]
    assert all(f.train_end < f.val_start for f in folds)
    for bad in ((0, 7), (3, 29), (31, 0)):
        with pytest.raises(ValueError):
            splits.expanding_cv_warmup(df, *bad)
    assert splits.warmup_steps(["lag_7d", "rolling_mean_30d"], 96) == 30 * 96 + 1


def test_series_folds_and_gap(make_panel):
    df = make_panel({"a": [1.0] * 10, "b": [1.0] * 10})
    folds = splits.expanding_cv_timeseries(df, 3)
    assert [(f.train_end.day, f.val_start.day, f.val_end.day) for f in folds] == [
        (4, 5, 6), (6, 7, 8), (8, 9, 10)
    ]
    gapped = splits.expanding_cv_timeseries(df, 3, gap=1)
    assert [f.train_end.day for f in gapped] == [3, 5, 7]
    # A gap that leaves too little training drops the fold.
    assert [f.fold for f in splits.expanding_cv_timeseries(df, 3, gap=3)] == [2, 3]
    with pytest.raises(ValueError):
        splits.expanding_cv_timeseries(df, 10)
    rows = splits.fold_rows(df, folds).groupBy("fold", "role").count().collect()
    assert {(r.fold, r.role): r["count"] for r in rows}[(2, "train")] == 12


def test_segments_add_up_to_folds(make_panel):
    df = make_panel({"a": [1.0] * 10})
    folds = splits.expanding_cv_timeseries(df, 3, gap=1)
    segment, train, validation = splits.fold_segment(folds)
    counts = {r.s: r.n for r in df.groupBy(segment.alias("s")).agg(F.count("*").alias("n")).collect()}
    for fold in folds:
        assert sum(counts.get(s, 0) for s in train[fold.fold]) == fold.train_end.day
        assert sum(counts.get(s, 0) for s in validation[fold.fold]) == 2


def test_samples_are_exact_and_stable(make_panel):
    df = make_panel({"a": [1.0] * 500, "b": [1.0] * 40})
    first = {(r.series_id, r.ts) for r in sampling.sample_n(df, 123).collect()}
    again = {(r.series_id, r.ts) for r in sampling.sample_n(df.repartition(7), 123).collect()}
    assert len(first) == 123 and first == again
    assert sampling.sample_n(df, 540).count() == 540
    assert sampling.sample_n(df, 9999).count() == 540
    assert sampling.sample_n(df, None) is df
    smaller = {(r.series_id, r.ts) for r in sampling.sample_n(df, 50).collect()}
    assert smaller < first
    part = sampling.random_split(df, 0.3)
    assert part.count() == 540 and 100 < part.where("part = 'test'").count() < 230
