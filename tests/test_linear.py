import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.operators import evaluate, linear, scoring, splits, trees
from wattlane.operators.features import build_features


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1000, 3, (400, 2))
    x[:, 1] = 0.9 * x[:, 0] + 0.1 * x[:, 1]
    y = 2 * x[:, 0] - x[:, 1] + rng.normal(0, 1, 400)
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, value double"), x, y


def ridge(x, y, alpha, scaled=False):
    xc, yc = x - x.mean(0), y - y.mean()
    s = x.std(0) if scaled else np.ones(x.shape[1])
    w = np.linalg.solve((xc / s).T @ (xc / s) + alpha * np.eye(x.shape[1]), (xc / s).T @ yc) / s
    return w, y.mean() - w @ x.mean(0)


@pytest.mark.parametrize("scaled", [False, True])
@pytest.mark.parametrize("alpha", [0.0, 1.0, 1e3])
def test_fit_equals_numpy(data, alpha, scaled):
    df, x, y = data
    stats = linear.moments(df, ["a", "b"])[None]
    model = stats.fit(alpha, standardize=scaled)
    w, b = ridge(x, y, alpha, scaled)
    np.testing.assert_allclose(model.weights, w, rtol=1e-7)
    assert model.intercept == pytest.approx(b, rel=1e-7)
    error = y - x @ w - b
    score = stats.score(model)
    assert score["rmse"] == pytest.approx(np.sqrt(np.mean(error**2)), rel=1e-8)
    assert score["r2"] == pytest.approx(1 - np.sum(error**2) / np.sum((y - y.mean()) ** 2), rel=1e-8)
    row = evaluate.regression_metrics(scoring.score_table(df, model)).first()
    assert row.rmse == pytest.approx(score["rmse"], rel=1e-8)
    assert row.mae == pytest.approx(np.mean(np.abs(error)), rel=1e-8)


def test_many_features_use_several_lanes(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (200, 9))
    y = x @ np.arange(9.0) + 3
    names = [f"f{i}" for i in range(9)]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)],
                               ", ".join(f"{n} double" for n in names) + ", value double")
    model = linear.moments(df, names)[None].fit()
    np.testing.assert_allclose(model.weights, np.arange(9.0), atol=1e-8)
    assert model.intercept == pytest.approx(3)


def test_moments_add_up(data):
    df, x, y = data
    parts = linear.moments(df, ["a", "b"], by=F.col("a") > 1000)
    whole = linear.moments(df, ["a", "b"])[None]
    joined = linear.total(list(parts.values()))
    assert joined.n == whole.n
    np.testing.assert_allclose(joined.cross, whole.cross, rtol=1e-8, atol=1e-6)


def test_spark_trainer_agrees(data):
    df, x, y = data
    for alpha in (1.0, 1e3):
        ours = linear.moments(df, ["a", "b"])[None].fit(alpha)
        theirs = trees.fit_ridge_library(df, ["a", "b"], alpha).stages[-1]
        np.testing.assert_allclose(ours.weights, theirs.coefficients.toArray(), rtol=1e-6)


def test_bayesian_ridge_is_close_to_least_squares(data):
    df, x, y = data
    stats = linear.moments(df, ["a", "b"])[None]
    np.testing.assert_allclose(stats.fit_bayesian().weights, stats.fit().weights, atol=0.1)


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, value double")
    stats = linear.moments(df, ["a"])[None]
    assert stats.score(stats.fit(1.0))["r2"] is None
    assert evaluate.regression_metrics(df.withColumn("prediction", F.lit(4.0))).first().r2 is None


@pytest.fixture(scope="module")
def cycle(make_panel):
    rng = np.random.default_rng(2)
    hours = np.arange(24 * 40)
    series = {
        f"s{k}": [float(v) for v in
                  10 + k + 3 * np.sin(2 * np.pi * hours / 24) + (hours // 24 % 7) * 0.5
                  + rng.normal(0, 0.3, len(hours))]
        for k in range(3)
    }
    panel = make_panel(series, 3600)
    feats = build_features(
        panel, 24, {"lag_1d": 24, "lag_7d": 168}, {"rolling_mean_7d": 168}
    )
    return panel, feats.cache()


def test_cross_validated_penalty(cycle):
    _, feats = cycle
    names = ["lag_1d", "lag_7d", "rolling_mean_7d"]
    folds = splits.expanding_cv_warmup(feats, 3, splits.warmup_steps(names, 24))
    best, rows = linear.alpha_cv(feats, folds, names, [0.1, 1.0, 1e9])
    assert best in (0.1, 1.0) and rows[-1]["alpha"] == 1e9
    pdf = feats.toPandas().dropna()
    scores = []
    for f in folds:
        tr, va = pdf[pdf.ts <= f.train_end], pdf[(pdf.ts >= f.val_start) & (pdf.ts <= f.val_end)]
        w, b = ridge(tr[names].to_numpy(), tr.value.to_numpy(), 1.0)
        scores.append(np.sqrt(np.mean((va.value - va[names].to_numpy() @ w - b) ** 2)))
    assert {r["alpha"]: r["rmse"] for r in rows}[1.0] == pytest.approx(np.mean(scores), rel=1e-9)


def test_candidates_and_strategies(cycle):
    _, feats = cycle
    names = ["lag_1d", "lag_7d"]
    rows = linear.model_cv(feats, splits.expanding_cv_timeseries(feats, 3), names)
    assert rows[-1]["name"] == "dummy_mean" and rows[0]["rmse"] < rows[-1]["rmse"]
    df = splits.split_by_ranges(
        feats,
        {"train": ("2020-01-01", "2020-01-25"), "validation": ("2020-01-26", "2020-02-02"),
         "test": ("2020-02-03", "2020-02-09")},
    )
    sweep = linear.strategy_sweep(df, {"one": ["lag_1d"], "two": names})
    assert sweep[0]["strategy"] == "two" and sweep[0]["mae"] < sweep[1]["mae"]
    model, test = linear.refit_and_test(df, names, 1.0)
    again, same = linear.refit_and_test(df, names, 1.0)
    assert model == again and test == same


def test_model_beats_persistence(cycle):
    panel, feats = cycle
    model = linear.moments(feats.where("ts < '2020-02-01'"), ["lag_1d", "lag_7d"])[None].fit(1.0)
    test = feats.where("ts >= '2020-02-01'")
    rows = evaluate.beats_naive(
        scoring.score_table(test, model), panel, {"day": 24}, "2020-02-01", "2020-03-01"
    ).collect()
    assert rows[0].beats and rows[0].model_rmse < rows[0].naive_rmse


def test_trees_learn_the_signal(cycle):
    _, feats = cycle
    names = ["lag_1d", "lag_7d"]
    for model in (
        trees.fit_tree(feats, names),
        trees.fit_forest(feats, names, 5, 6),
        trees.fit_gbt(feats, names, rounds=3, learning_rate=0.5),
    ):
        row = evaluate.regression_metrics(trees.score(model, feats, names)).first()
        assert row.r2 > 0.8


def test_coefficients_round_trip(spark, data):
    model = linear.moments(data[0], ["a", "b"])[None].fit(1.0)
    table = linear.coefficient_table(spark, {"m": model})
    back = linear.model_from_table(table, "m")
    assert dict(zip(back.features, back.weights)) == dict(zip(model.features, model.weights))
    with pytest.raises(KeyError):
        scoring.score_table(data[0].drop("b"), model)


def test_ranks_do_not_depend_on_the_unit():
    rows = [{"name": "a", "rmse": 4e-7}, {"name": "b", "rmse": 1e-7}, {"name": "c", "rmse": 1e-7 * (1 + 1e-14)}]
    assert [r["name"] for r in linear._ranked_rows(rows)] == ["b", "c", "a"]
