import numpy as np
import pytest

from wattlane.operators import boosting, deeptree
from wattlane.operators.trees import fit_tree


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(3000, 2)), 2)
    y = np.round(rng.normal(size=3000) * 10)
    x[:400], y[3:9] = 0.0, 7.0
    rows = [(float(a), float(b), float(v)) for (a, b), v in zip(x, y)]
    return spark.createDataFrame([*rows, (None, 1.0, 2.0)], "a double, b double, value double").repartition(4), x, y


def means(x, y):
    _, at = np.unique(x, axis=0, return_inverse=True)
    at = at.ravel()
    return (np.bincount(at, y) / np.bincount(at))[at]


@pytest.mark.parametrize("limit", [100, 200_000])
def test_a_tree_without_bounds_gives_the_mean_of_equal_rows(data, limit, monkeypatch):
    df, x, y = data
    monkeypatch.setattr(deeptree, "SCORED", 150)
    model = deeptree.fit_deep_tree(df, ["a", "b"], limit=limit)
    got = model.score(df).toPandas().sort_values(["a", "b", "value"])
    want = means(x, y)[np.lexsort((y, x[:, 1], x[:, 0]))]
    assert len(got) == 3000
    np.testing.assert_allclose(got["prediction"], want, atol=1e-9)
    # Spark's trainer has the whole tree in the driver; here it gets the top only.
    assert (len(model.top.feature) > 1) == (limit == 100)
    assert model.nodes.groupBy("leaf").count().agg({"count": "max"}).first()[0] <= 2 * limit - 1


def test_the_first_splits_are_the_best_of_all(spark):
    rng = np.random.default_rng(6)
    x, n = rng.normal(size=(300, 3)), rng.integers(1, 5, 300).astype(float)
    total = n * (np.where(x[:, 1] > 0.3, 5.0, 0.0) + rng.normal(0, 0.01, 300))
    feature, threshold, left, right, value = deeptree.grow(x, n, total)
    below, above = x[x[:, 1] <= 0.3, 1].max(), x[x[:, 1] > 0.3, 1].min()
    assert feature[0] == 1 and threshold[0] == pytest.approx((below + above) / 2)
    low = x[:, 1] <= 0.3
    assert value[left[0]] == pytest.approx(total[low].sum() / n[low].sum())
    assert (feature < 0).sum() == 300


def test_an_exclusive_or_is_split_though_the_first_cut_gains_nothing():
    x = np.array([[0.0, 0.0], [0.0, 1.0], [1.0, 0.0], [1.0, 1.0]])
    feature, _, _, _, value = deeptree.grow(x, np.ones(4), np.array([0.0, 1.0, 1.0, 0.0]))
    assert (feature < 0).sum() == 4 and sorted(value[feature < 0]) == [0, 0, 1, 1]


def test_trained_rows_are_dealt_to_more_tasks(data, monkeypatch):
    from wattlane.operators import trees

    df, x, y = data
    monkeypatch.setattr(trees, "TASK_ROWS", 300)
    rows = trees._spread(df)
    assert rows.rdd.getNumPartitions() == 11 and rows.count() == 3001
    model = boosting.from_spark(fit_tree(df, ["a", "b"], 4), ["a", "b"])
    assert model.depth == 4
