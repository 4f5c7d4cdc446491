import hashlib
import math

import numpy as np
import pytest
from fractions import Fraction

from wattlane.llm.shallot import Centroids, Search, cluster_digests, cluster_vectors, plain_nearest


def by_brute_force(rows, k, rounds, size):
    kept = [(i, [math.floor(Fraction(x) * 256) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in first[:k]] + sorted(v for i, v in kept if i is None)[: max(0, k - len(first))]

    def assign():
        return [plain_nearest(v, centres)[::2] for _, v in kept]

    for _ in range(rounds):
        of = [c for c, _ in assign()]
        for j in range(len(centres)):
            own = [v for (_, v), c in zip(kept, of) if c == j]
            if own:
                centres[j] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    return sorted((i is None, i or 0, c, d) for (i, _), (c, d) in zip(kept, found)), centres


def blobs(rng, n, size, spread=0.3):
    middle = rng.normal(size=(12, size))
    return (middle[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, size))).tolist()


@pytest.mark.parametrize("k, spread, step", [(9, 0.3, 0), (40, 1.0, 0), (7, 0.5, 0.25), (1, 0.3, 0)])
def test_clusters_equal_brute_force(spark, k, spread, step):
    rng = np.random.default_rng(k)
    vectors = blobs(rng, 500, 6, spread)
    if step:  # many equal distances
        vectors = [[round(x / step) * step for x in v] for v in vectors]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(7, vectors[3]), (None, vectors[4]), (None, vectors[9])]
    odd = [(900, None), (901, [1.0] * 5), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [])]
    frame = spark.createDataFrame([(v, i, "x", 1.5, 3) for i, v in rows + odd], "embedding array<double>, vec_id long, wide string, upper double, cluster int")
    assigned, centres = cluster_vectors(frame, k=k, size=6)
    got = cluster_digests(assigned, centres).collect()
    want, want_centres = by_brute_force(rows, k, 5, 6)
    assert centres == want_centres
    assert sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in got) == want
    total = {j: sum(d for *_, c, d in want if c == j) for j in range(k)}
    for r in got:
        assert (r.cluster_inertia, r.inertia) == (total[r.cluster], sum(total.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, want_centres[r.cluster])).encode()).hexdigest()


def test_few_no_and_equal_vectors(spark):
    frame = spark.createDataFrame([(i, [0.5, -0.001]) for i in range(30)], "vec_id long, embedding array<float>")
    got = cluster_digests(*cluster_vectors(frame, k=4, size=2)).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)} and len(got) == 30
    assert len(cluster_digests(*cluster_vectors(frame.limit(2), k=4, size=2)).collect()) == 2
    assert cluster_digests(*cluster_vectors(frame.where("false"), k=4, size=2)).collect() == []


def test_components_of_any_size_are_exact(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(x) for x in v] for v in blobs(rng, 120, 3)]
    vectors += [[1e6, 2.0, 3.0], [1e30, -1e30, 1.0], [1e30, -1e30, 5.0], [1.7e308, 1.0, 1.0], [262143.0, 0.0, 0.0], [300000.5, 1.0, 0.0], [-1e7, 3.0, 1.0]]
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assigned, centres = cluster_vectors(frame, k=12, size=3)
    want, want_centres = by_brute_force(rows, 12, 5, 3)
    assert centres == want_centres
    got = sorted((False, r.vec_id, r.cluster, r.distance) for r in assigned.collect())
    assert got == [(*w[:3], w[3] if w[3] < 1 << 63 else None) for w in want]
    told = cluster_digests(spark.createDataFrame([(1, 0, 5), (2, 0, None), (3, 1, 4)], "vec_id long, cluster int, distance long"), [[1], [2]])
    assert {(r.cluster, r.cluster_inertia, r.inertia) for r in told.collect()} == {(0, None, None), (1, 4, None)}


def test_the_search_compares_a_part_of_the_centroids():
    rng = np.random.default_rng(1)
    x = (np.array(blobs(rng, 4000, 8, 0.2)) * 256).astype(np.int64)
    k, n = 40, len(x)
    c = Centroids(x[:k].tolist())
    state = np.zeros(n, np.int32), np.ones(n, np.int32), np.full(n, np.inf), np.zeros(n)
    for _ in range(6):
        search = Search(c)
        assert not search.update(x, *state).any()
        squares = ((x[:, None] - np.array(c.whole)[None]) ** 2).sum(2)
        assert (state[0] == squares.argmin(1)).all()
        assert (state[2] ** 2 >= squares.min(1) * (1 - 1e-9)).all() and (state[3] ** 2 <= np.sort(squares, 1)[:, 1] * (1 + 1e-9)).all()
        c = Centroids([(x[state[0] == j].sum(0) // max(1, (state[0] == j).sum())).tolist() for j in range(k)], c)
    assert search.compared < 0.25 * n * k
