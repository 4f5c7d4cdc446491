import math

import numpy as np
import pytest

from wattlane.llm.vecdup import balls_of, near_vectors, unit_rows


def by_brute_force(rows, least=0.9):
    fit = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for size in {len(rows[i][1]) for i in fit}:
        at = [i for i in fit if len(rows[i][1]) == size]
        u = unit_rows(np.array([rows[i][1] for i in at], float))
        for a, b in zip(*np.nonzero(u @ u.T >= least)):
            if a != b:
                links[at[a]].add(at[b])
    out, seen = [], set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        seen |= group
        name = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        out += [(rows[j][0], len(links[j]), name, rows[j][0] == name) for j in group]
    return sorted(out, key=repr)


def result(frame, **settings):
    return sorted((tuple(r) for r in near_vectors(frame, **settings).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def crowds(rng, dim, tight=(0.02, 0.05, 0.12, 0.2), members=60, noise=150):
    rows = [rng.normal(size=(noise, dim))]
    for width in tight:
        middle = rng.normal(size=dim)
        middle /= np.linalg.norm(middle)
        rows.append((middle + width * rng.normal(size=(members, dim)) / math.sqrt(dim / 8)) * rng.uniform(0.1, 9, (members, 1)))
    x = np.vstack(rows)
    return x[rng.permutation(len(x))].tolist()


SMALL = {"cell_rows": 40, "block": 24, "smallest": 4}


@pytest.mark.parametrize("dim", [8, 2, 48])
def test_groups_and_links_equal_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    vectors = crowds(rng, dim)
    rows = [(3 * i, v) for i, v in enumerate(vectors)] + [(5000 + i, vectors[7]) for i in range(70)]
    rows += [(3, vectors[1]), (None, vectors[2]), (None, [0.0] * dim), (-4, [1.0] * (dim + 3)), (-5, [2.0] * (dim + 3)), (-6, [1.0])]
    rows += [(-10, None), (-11, []), (-12, [0.0] * dim), (-13, [float("nan")] * dim), (-14, [None] * dim), (-15, [float("inf")] * dim)]
    rows += [(-20, [1e200] * dim), (-21, [1e-200] * dim), (-22, [5e-324] * dim), (-23, [-1.0] * dim)]
    frame = spark.createDataFrame([(v, i, "x", 1, 2) for i, v in rows], "embedding array<double>, vec_id long, kind string, row int, n int")
    want = by_brute_force(rows)
    assert sum(n for _, n, _, _ in want) > 10_000 and len({g for *_, g, _ in want}) > 8
    assert result(frame, spread=None, **SMALL) == want
    assert result(frame, spread=None) == want


def test_links_are_found_beside_the_borders_of_cells(spark):
    rng = np.random.default_rng(2)
    base = unit_rows(rng.normal(size=(1500, 64)))
    turn = rng.normal(size=base.shape)
    turn = unit_rows(turn - (turn * base).sum(1, keepdims=True) * base)
    angle = np.arccos(rng.uniform(0.9, 0.93, (1500, 1)))
    rows = list(enumerate(np.vstack([base, np.cos(angle) * base + np.sin(angle) * turn]).tolist()))
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cell_rows=60).collect()
    assert sum(r.n_links for r in got) >= 0.999 * sum(n for _, n, _, _ in by_brute_force(rows))


def test_empty_and_equal_tables(spark):
    frame = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100, 300)], "vec_id long, embedding array<float>")
    assert result(frame.where("false")) == []
    assert result(frame, **SMALL) == sorted(((i, 199, 100, i == 100) for i in range(100, 300)), key=repr)
    odd = spark.createDataFrame([(1, None), (None, None)], "vec_id long, embedding array<float>")
    assert result(odd) == sorted([(1, 0, 1, True), (None, 0, None, True)], key=repr)


def test_balls_hold_links_only():
    rng = np.random.default_rng(6)
    x = unit_rows(np.array(crowds(rng, 6)))
    balls = balls_of(x, 0.9, 4)
    assert len(balls) > 3 and sum(len(rows) for rows, _, _ in balls) == len(np.unique(np.concatenate([rows for rows, _, _ in balls])))
    for rows, middle, radius in balls:
        assert (x[rows] @ x[rows].T).min() >= 0.9 and radius <= math.acos(0.9) / 2
        assert (np.arccos(np.clip(x[rows] @ middle, -1, 1)) <= radius + 1e-7).all()
