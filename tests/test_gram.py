import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.functions import gram
from wattlane.operators import linear, profiles


def frame(spark, x, names, parts=5):
    rows = [[None if v is None else float(v) for v in row] for row in x]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts)


def test_cross_products_merge_to_those_of_all_rows(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(1e9, 1, 900), rng.normal(0, 1e-3, 900), np.full(900, 0.1)])
    x[:, 1] += 1e-3 * (x[:, 0] - 1e9)
    df = frame(spark, x, ["a", "b", "c"]).withColumn("g", F.when(F.col("b") > 0, "up").when(F.col("b") > -5e-4, "down"))
    n, mean, cross = gram.cross_products(df, ["a", "b", "c"])[None]
    z = x - x.mean(0)
    assert n == 900 and cross[2, 2] == 0
    np.testing.assert_allclose(mean, x.mean(0), rtol=1e-14)
    np.testing.assert_allclose(cross[:2, :2], (z.T @ z)[:2, :2], rtol=1e-7)
    groups = gram.cross_products(df, ["a", "b"], F.col("g"))
    assert set(groups) == {"up", "down", None} and sum(g[0] for g in groups.values()) == 900
    for part in range(3):
        own = x[:, :2][(x[:, 1] > 0, (x[:, 1] <= 0) & (x[:, 1] > -5e-4), x[:, 1] <= -5e-4)[part]]
        n, mean, cross = groups[("up", "down", None)[part]]
        assert n == len(own)
        np.testing.assert_allclose(cross[1, 1], ((own - own.mean(0))[:, 1] ** 2).sum(), rtol=1e-9)


def test_sixty_features_in_one_pass(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 60))
    y = x @ np.arange(60.0) + 3
    names = [f"f{i}" for i in range(60)]
    df = frame(spark, np.column_stack([x, y]), [*names, "value"])
    model = linear.moments(df, names)[None].fit()
    np.testing.assert_allclose(model.weights, np.arange(60.0), atol=1e-9)
    assert "Generate" not in df._jdf.queryExecution().toString() and model.intercept == pytest.approx(3)


def test_correlations_over_common_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(50, 1, (500, 4))
    x[:, 1] += x[:, 0]
    x[:, 3] = 4.2
    holes = rng.random((500, 4)) < 0.3
    rows = [[None if h else v for v, h in zip(r, hs)] for r, hs in zip(x, holes)]
    names = ["a", "b", "c", "d"]
    df = frame(spark, rows, names).withColumn("g", F.col("a") > 50).withColumn("e", F.lit(None).cast("double"))
    got = {(r.x, r.y): r.correlation for r in profiles.correlation_matrix(df, [*names, "e"]).collect()}
    for i, a in enumerate(names[:3]):
        for j, b in enumerate(names[:3]):
            both = ~holes[:, i] & ~holes[:, j]
            assert got[a, b] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-12)
    assert np.isnan(got["a", "d"]) and got["a", "e"] is None and len(got) == 25
    by = profiles.correlation_matrix(df, ["b", "c"], ["g"])
    want = df.groupBy("g").agg(F.corr("b", "c").alias("want"))
    joined = by.where("x = 'b' AND y = 'c'").join(want, F.equal_null(by.g, want.g)).collect()
    assert len(joined) == 3 and all(r.correlation == pytest.approx(r.want, abs=1e-12) for r in joined)
    odd = profiles.correlation_matrix(frame(spark, [[1, 2], [float("nan"), 3], [2, 5]], ["p", "q"]), ["p", "q"])
    values = {(r.x, r.y): r.correlation for r in odd.collect()}
    assert np.isnan(values["p", "q"]) and values["q", "q"] == pytest.approx(1)


def test_many_groups_are_held_in_parts(spark):
    df = spark.range(6000).select((F.col("id") % 700).alias("g"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    got = profiles.correlation_matrix(df, ["a", "b"], ["g"]).where("x = 'a' AND y = 'b'")
    want = df.groupBy("g").agg(F.corr("a", "b").alias("want"))
    assert got.join(want, "g").where("abs(correlation - want) < 1e-9").count() == 700


def test_least_squares_does_not_square_the_condition(spark):
    rng = np.random.default_rng(4)
    n = 3000
    a, b, e = rng.normal(size=(3, n))
    x = np.column_stack([a, a + 1e-9 * b, e * 1e6])
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1e-6 * x[:, 2] + 5
    df = frame(spark, np.column_stack([x, y]), ["a", "b", "c", "value"], 7)
    fit = linear.fit_least_squares(df, ["a", "b", "c"])
    z = np.column_stack([np.ones(n), x])
    want = np.linalg.lstsq(z / np.linalg.norm(z, axis=0), y, rcond=None)[0] / np.linalg.norm(z, axis=0)
    assert np.linalg.cond(x / np.linalg.norm(x, axis=0)) > 1e9
    w = np.array(fit.model.weights)
    np.testing.assert_allclose(x @ w + fit.model.intercept, z @ want, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(w, [3, -2, 1e-6], rtol=1e-5)
    gram_weights = np.array(linear.moments(df, ["a", "b", "c"])[None].fit().weights)
    assert abs(gram_weights[0] - 3) > 0.1
    assert fit.n == n and fit.dependent == () and fit.residual < 1e-9


def test_dependent_features_are_named(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3))
    data = np.column_stack([x, x[:, 0] + 2 * x[:, 1], np.full(300, 7.0), x @ [1.0, 2.0, 3.0] + 1 + 0.1 * rng.normal(size=300)])
    names = ["a", "b", "c", "sum", "flat"]
    fit = linear.fit_least_squares(frame(spark, data, [*names, "value"]), names)
    assert len(fit.dependent) == 2 and "flat" in fit.dependent and "c" not in fit.dependent
    centred = data - data.mean(0)
    want = np.linalg.lstsq(centred[:, :5], centred[:, 5], rcond=1e-11)[0]
    np.testing.assert_allclose(fit.model.weights, want, atol=1e-9)
    assert fit.residual == pytest.approx(((centred[:, 5] - centred[:, :5] @ want) ** 2).sum(), rel=1e-9)
    with pytest.raises(ValueError):
        linear.fit_least_squares(frame(spark, [[1, None]], ["a", "value"]), ["a"])
    assert linear.fit_least_squares(frame(spark, [[4.0]], ["value"]), []).model.intercept == 4
