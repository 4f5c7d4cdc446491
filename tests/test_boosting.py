import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.operators import boosting, evaluate, linear, scoring, trees
from wattlane.operators.features import build_features


def plain_tree(x, y, max_leaves, min_leaf):
    """Best-first growth by looking at every cut of every leaf; predictions of the rows."""
    leaves = {0: np.arange(len(y))}

    def cut(rows):
        best = None
        for j in range(x.shape[1]):
            values = np.unique(x[rows, j])
            for a, b in zip(values, values[1:]):
                left = x[rows, j] <= a + (b - a) / 2
                n, m = left.sum(), (~left).sum()
                if n >= min_leaf and m >= min_leaf:
                    s, t = y[rows[left]].sum(), y[rows[~left]].sum()
                    gain = s * s / n + t * t / m - (s + t) ** 2 / (n + m)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, rows[left], rows[~left])
        return best

    cuts = {0: cut(leaves[0])}
    while len(leaves) < max_leaves and any(cuts[k] for k in leaves):
        k = max((k for k in leaves if cuts[k]), key=lambda k: cuts[k][0])
        _, a, b = cuts[k]
        del leaves[k]
        for rows in (a, b):
            leaves[len(cuts)] = rows
            cuts[len(cuts)] = cut(rows)
    out = np.zeros(len(y))
    for rows in leaves.values():
        out[rows] = y[rows].mean()
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 40, 600), rng.integers(-5, 5, 600), np.round(rng.normal(size=600), 1)]).astype(float)
    y = np.sin(x[:, 0] / 6) * 5 + x[:, 1] ** 2 * 0.3 + rng.normal(0, 0.2, 600)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, value double").repartition(5)
    return df.cache(), x, y


def test_the_first_trees_equal_a_plain_version(data):
    df, x, y = data
    model = boosting.fit_leafwise(df, ["a", "b", "c"], learning_rate=0.5, rounds=3, max_leaves=9, min_leaf=15)
    score = np.full(len(y), y.mean())
    for k in range(3):
        score = score + 0.5 * plain_tree(x, y - score, 9, 15)
        ends = [*model.roots, len(model.feature)]
        assert sum(f < 0 for f in model.feature[ends[k] : ends[k + 1]]) == 9
    np.testing.assert_allclose(model.predict(x), score, atol=1e-9)


def test_scores_written_between_trees_change_nothing(data, monkeypatch):
    df, x, y = data
    settings = {"learning_rate": 0.3, "rounds": 5, "max_leaves": 6}
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    often = boosting.fit_leafwise(df, ["a", "b", "c"], **settings)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 100)
    never = boosting.fit_leafwise(df, ["a", "b", "c"], **settings)
    np.testing.assert_allclose(often.predict(x), never.predict(x), atol=1e-9)


def test_tables_give_the_same_predictions(spark, data):
    df, x, y = data
    names = ["a", "b", "c"]
    model = boosting.fit_leafwise(df, names, rounds=4, max_leaves=7)
    forest, single, boosted = trees.fit_forest(df, names, 4, 5, 5), trees.fit_tree(df, names, None), trees.fit_gbt(df, names, rounds=3)
    models = {"own": model, **{k: boosting.from_spark(m, names) for k, m in (("forest", forest), ("tree", single), ("gbt", boosted))}}
    table = boosting.tree_table(spark, models).repartition(3).cache()
    back = {k: boosting.tree_model_from_table(table, k) for k in models}
    # A matrix is by position, a table by name; a feature that is never used is not in the table.
    used = [names.index(n) for n in back["own"].features]
    np.testing.assert_allclose(back["own"].predict(x[:, used]), model.predict(x), atol=1e-12)
    for k, m in (("forest", forest), ("tree", single), ("gbt", boosted)):
        both = scoring.score_table(trees.score(m, df, names).withColumnRenamed("prediction", "theirs"), back[k])
        assert both.where("abs(prediction - theirs) > 1e-9 OR prediction IS NULL").count() == 0
    got = scoring.score_table(df, back["own"]).toPandas()
    np.testing.assert_allclose(got["prediction"], model.predict(got[names].to_numpy()), atol=1e-9)
    missing = scoring.score_table(spark.createDataFrame([(None, 1.0, 1.0)], "a double, b double, c double"), back["own"])
    assert missing.first().prediction is None
    with pytest.raises(KeyError):
        boosting.tree_model_from_table(table, "none")


def test_a_champion_of_trees_is_found_by_its_alias(spark, data):
    df, x, _ = data
    versions = {"1": ["a"], "2": ["a", "b"]}
    models = {v: boosting.fit_leafwise(df, names, rounds=1, max_leaves=4) for v, names in versions.items()}
    nodes = boosting.tree_table(spark, models).withColumnsRenamed({"model_id": "version"}).withColumn("model_name", F.lit("m"))
    events = spark.createDataFrame(
        [("m", "champion", "1", 1), ("m", "champion", "2", 2), ("m", "other", "1", 3)], "model_name string, alias string, version string, seq long"
    )
    got = scoring.score_with_champion(df, nodes, events, "m", boosting.tree_model_from_table).toPandas()
    np.testing.assert_allclose(got["prediction"], models["2"].predict(got[["a", "b"]].to_numpy()), atol=1e-9)


def test_boosting_beats_ridge_on_a_daily_cycle(make_panel):
    rng = np.random.default_rng(2)
    hours = np.arange(24 * 40)
    panel = make_panel({f"s{k}": [float(v) for v in 10 + k + 3 * np.abs(np.sin(np.pi * hours / 24)) ** 3 * (1 + hours // 24 % 2) + rng.normal(0, 0.1, len(hours))] for k in range(3)}, 3600)
    names = ["lag_1d", "lag_2d"]
    feats = build_features(panel, 24, {"lag_1d": 24, "lag_2d": 48}, {}).cache()
    train, test = feats.where("ts < '2020-02-01'"), feats.where("ts >= '2020-02-01'").na.drop(subset=names)
    errors = [
        evaluate.regression_metrics(scoring.score_table(test, m)).first().rmse
        for m in (boosting.fit_leafwise(train, names, rounds=12, learning_rate=0.3), linear.moments(train, names)[None].fit(1.0))
    ]
    assert errors[0] < errors[1]


def test_one_row_and_equal_targets(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 1.0)], "a double, value double")
    model = boosting.fit_leafwise(df, ["a"], rounds=3, min_leaf=1)
    assert model.base == 5.0 and model.depth == 0 and scoring.score_table(df, model).where("prediction = 5").count() == 2
    with pytest.raises(ValueError):
        boosting.fit_leafwise(df.where("false"), ["a"])


def test_edges_of_many_values_are_percentiles():
    values = np.arange(10_000.0)
    edges = boosting.bin_edges(values)
    assert len(edges) == 255 and np.bincount(np.searchsorted(edges, values)).max() <= 41
    assert boosting.bin_edges(np.array([3.0, 1.0, 3.0])).tolist() == [2.0]


def test_rows_of_the_edges_are_those_of_least_hash(spark, monkeypatch):
    monkeypatch.setattr(boosting, "EDGE_SAMPLE", 300)
    df = spark.range(5000).selectExpr("id", "cast(id as double) AS a", "1 AS same")
    for keys in (["id"], ["same"]):
        want = boosting.sample_n(df, 300, seed=42, keys=[*keys]).select("a").toPandas()["a"]
        got = boosting._drawn(df, [F.col("a")], keys, 5000)
        assert len(got) == 300 and (keys == ["same"] or sorted(got[:, 0]) == sorted(want))


def test_a_prediction_needs_no_step_by_step_expression(spark, data):
    df, x, _ = data
    model = boosting.fit_leafwise(df, ["a", "b", "c"], rounds=3, max_leaves=8)
    plan = df.select(model.prediction())._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    nan = spark.createDataFrame([(float("nan"), 1.0, 2.0)], "a double, b double, c double").select(model.prediction().alias("p"))
    assert nan.first().p == pytest.approx(model.predict(np.array([[np.nan, 1.0, 2.0]]))[0])
