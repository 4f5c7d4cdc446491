"""The registered tree queries train what the reference trains: no fewer trees, levels or rounds."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.operators import trees
from wattlane.plans import model_queries
from wattlane.plans.catalog import catalog
from wattlane.schema import FEATURES


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(900, len(FEATURES))), 2)
    y = np.round(10 * np.sin(x[:, 0]) + 3 * x[:, 1])
    parts = ["train", "train", "validation", "test"]
    data = [(*map(float, r), float(v), parts[i % 4]) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in FEATURES) + ", value double, part string")
    return df.repartition(2).cache()


def trained(spark, rows, monkeypatch, name, fit):
    """What the query hands to the trainer ``fit`` (with its defaults), the model it gets and its rows."""
    calls, real = [], getattr(trees, fit)

    def recorded(*args, **named):
        call = inspect.signature(real).bind(*args, **named)
        call.apply_defaults()
        calls.append((call.arguments, real(*args, **named)))
        return calls[-1][1]

    monkeypatch.setattr(trees, fit, recorded)
    monkeypatch.setattr(model_queries, "prepared", lambda *a, **k: rows)
    found = {r.part: r for r in catalog().queries[name](spark, "").collect()}
    (given, model), = calls
    return given, model.stages[-1], found


@pytest.mark.parametrize(
    "name, count, depth, leaf",
    [("fit_forest", 40, 10, 20), ("fit_forest_deep", 60, 16, 10), ("fit_forest_from_nodes", 40, 10, 20)],
)
def test_forests_have_all_trees_and_levels(spark, rows, monkeypatch, name, count, depth, leaf):
    given, forest, found = trained(spark, rows, monkeypatch, name, "fit_forest")
    assert (given["trees"], given["max_depth"], given["min_leaf"], given["fraction"]) == (count, depth, leaf, 0.3)
    assert given["df"].count() == rows.where(F.col("part") == "train").count()
    assert forest.getNumTrees == count and forest.getOrDefault("maxDepth") == depth
    assert forest.getOrDefault("minInstancesPerNode") == leaf
    assert {p: r.n for p, r in found.items()} == {"train": 450, "validation": 225, "test": 225}
    assert found["train"].below_mean_model and all(r.within_targets for r in found.values())


def test_boosting_is_asked_for_all_rounds(spark, rows, monkeypatch):
    # 150 rounds take a minute on any rows, so the trainer notes what it is asked for and makes three.
    asked, real = [], trees.GBTRegressor
    monkeypatch.setattr(trees, "GBTRegressor", lambda **k: asked.append(k) or real(**{**k, "maxIter": 3}))
    given, _, found = trained(spark, rows, monkeypatch, "fit_gbt", "fit_gbt")
    (call,) = asked
    assert (call["stepSize"], call["maxIter"], call["maxDepth"], call["maxBins"]) == (0.08, 150, 5, 256)
    assert given["df"].count() == rows.where(F.col("part") == "train").count()
    assert {p: r.n for p, r in found.items()} == {"train": 450, "validation": 225, "test": 225}
    assert found["train"].below_mean_model
