"""Centroid clustering of whole vectors with the bounds and search of the Shallot algorithm.

Components become integers, floor(scale * x), and centroids stay integers, so that every comparison that
decides is one of exact squared distances; ties go to the smaller number. Each vector keeps the number of its
nearest and of its second-nearest centroid, an upper bound of the distance to the first and a lower bound
of that to all others. After the centroids have moved the bounds move along, and a vector is left
alone while the upper bound is below the lower one or below half the way from its centroid to
the next. Otherwise its old two centroids are compared and the search starts at the closer: its neighbours, sorted by
their distance to it, are looked at while they lie in a ball whose radius is the sum of the
vector's two least distances so far, so every find shrinks the ball for what follows.

Vectors with their state are written once for each round and read by the next; the table before is deleted then, so
that disk holds two at most. Sums of a round are partial sums of each task, added up by centroid and
component; k times the components reach the driver, whatever the table holds.

Vectors that are null, of another length, or that hold null or non-finite components are left out. Null vec_id:
clustered as any other row, a starting centroid only if there are too few others. Repeated vec_ids: each row by
itself, in the order of their components as starting centroids. Fewer vectors than centroids: as many
centroids. Components of any finite size are exact; a distance or sum beyond a long is null.
Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of
from wattlane.session import discard, materialize

NARROW = 1 << 26  # squared distances of components below it fit 64-bit integers
BATCH = 8192
_SLACK = 1e-12
_LIMB = 40
_LONG = 1 << 63
STATE = "vec_id long, whole array<long>, wide array<string>, first int, second int, upper double, lower double"
ASSIGNED = "vec_id long, cluster int, distance long"


def whole_components(x: list[float], scale: int) -> list[int]:
    """floor(scale * x) without overflow or rounding."""
    return [math.floor(Fraction(v) * scale) for v in x]


def _real(total: int) -> float:
    """Square root of an exact square sum as a double; very large ones are held at 1e300."""
    return math.sqrt(total) if total < 10**300 else min(float(math.isqrt(total)) if total < 10**600 else 1e300, 1e300)


def exact_squares(rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Squared distances of narrow integer rows to one narrow integer centre (or one for each row)."""
    gap = rows - centre
    return np.einsum("ij,ij->i", gap, gap)


class Centroids:
    """Integer centroids with their distances to each other, neighbour lists and moves since the last round."""

    def __init__(self, whole: list[list[int]], before: Centroids | None = None) -> None:
        self.whole = whole
        self.k = len(whole)
        self.wide = np.array([any(abs(v) >= NARROW for v in c) for c in whole], dtype=bool)
        self.narrow = np.array([[0] * len(c) if w else c for c, w in zip(whole, self.wide)], dtype=np.int64)
        gaps = np.zeros((self.k, self.k))
        for i in range(self.k):
            for j in range(i):
                gaps[i, j] = gaps[j, i] = _real(sum((a - b) ** 2 for a, b in zip(whole[i], whole[j])))
        self.neighbours = np.argsort(gaps, axis=1, kind="stable")
        self.neighbours = np.array([[j for j in row if j != i] for i, row in enumerate(self.neighbours)], dtype=np.int64).reshape(self.k, self.k - 1)
        self.gaps = gaps
        self.half = np.array([gaps[i][self.neighbours[i, 0]] / 2 if self.k > 1 else np.inf for i in range(self.k)])
        self.move = np.zeros(self.k)
        if before is not None:
            self.move = np.array([_real(sum((a - b) ** 2 for a, b in zip(c, d))) for c, d in zip(whole, before.whole)])
        order = np.argsort(-self.move, kind="stable")
        self.move_of_others = np.full(self.k, self.move[order[0]])
        self.move_of_others[order[0]] = self.move[order[1]] if self.k > 1 else 0.0


class Search:
    """Nearest and second-nearest centroids of blocks of narrow vectors; ``compared`` counts exact distances."""

    def __init__(self, centroids: Centroids) -> None:
        self.c = centroids
        self.compared = 0

    def _squares(self, rows: np.ndarray, number: np.ndarray | int) -> np.ndarray:
        self.compared += len(rows)
        return exact_squares(rows, self.c.narrow[number])

    def _start(self, rows: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        """The closer of two remembered centroids first, with both squared distances."""
        one, two = self._squares(rows, first), self._squares(rows, second)
        swap = (two < one) | ((two == one) & (second < first))
        return np.where(swap, second, first), np.where(swap, first, second), np.where(swap, two, one), np.where(swap, one, two)

    def _scan(self, rows: np.ndarray, middle: int, second: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, ...]:
        """Neighbours of ``middle`` in order of distance to it, for the rows whose ball still reaches them.

        The last result marks rows whose ball reached a centroid too wide for 64-bit integers.
        """
        first = np.full(len(rows), middle)
        to_middle = np.sqrt(one.astype(np.float64))
        beyond = np.zeros(len(rows), dtype=bool)
        remembered = second.copy()
        active = np.arange(len(rows))
        for j in self.c.neighbours[middle].tolist():
            reach = (to_middle[active] + np.sqrt(two[active].astype(np.float64))) * (1 + _SLACK)
            active = active[self.c.gaps[middle, j] <= reach]
            if not len(active):
                break
            if self.c.wide[j]:
                beyond[active] = True
                continue
            rest = active[remembered[active] != j]
            got = self._squares(rows[rest], j)
            nearer = (got < one[rest]) | ((got == one[rest]) & (j < first[rest]))
            at = rest[nearer]
            second[at], two[at] = first[at], one[at]
            first[at], one[at] = j, got[nearer]
            at, got = rest[~nearer], got[~nearer]
            closer = (got < two[at]) | ((got == two[at]) & (j < second[at]))
            second[at[closer]], two[at[closer]] = j, got[closer]
        return first, second, one, two, beyond

    def update(self, rows: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Bring the state of a block up to date, in place; the result marks rows that need plain comparison."""
        c = self.c
        plain = c.wide[first] | c.wide[second] if c.k > 1 else c.wide[first]
        if c.k == 1:
            return plain
        upper[:] = (upper + c.move[first]) * (1 + _SLACK)
        lower[:] = np.maximum((lower - c.move_of_others[first]) * (1 - _SLACK) - 1e-9, 0.0)
        guard = np.maximum(lower, c.half[first] * (1 - _SLACK))
        open_rows = np.flatnonzero((upper >= guard) & ~plain)
        if len(open_rows):
            tight = np.sqrt(self._squares(rows[open_rows], first[open_rows]).astype(np.float64)) * (1 + _SLACK)
            upper[open_rows] = tight
            open_rows = open_rows[tight >= guard[open_rows]]
        if not len(open_rows):
            return plain
        a, b, one, two = self._start(rows[open_rows], first[open_rows], second[open_rows])
        for middle in np.unique(a).tolist():
            at = np.flatnonzero(a == middle)
            here = open_rows[at]
            f, s, d1, d2, beyond = self._scan(rows[here], middle, b[at], one[at], two[at])
            first[here], second[here] = f, s
            upper[here], lower[here] = np.sqrt(d1.astype(np.float64)) * (1 + _SLACK), np.sqrt(d2.astype(np.float64)) * (1 - _SLACK)
            plain[here[beyond]] = True
        return plain


def plain_nearest(row: list[int], whole: list[list[int]]) -> tuple[int, int, int]:
    """(first, second, squared distance to the first) by comparison with all centroids in whole numbers."""
    totals = sorted((sum((a - b) ** 2 for a, b in zip(row, c)), j) for j, c in enumerate(whole))
    return totals[0][1], totals[1 if len(totals) > 1 else 0][1], totals[0][0]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to blocks that are worth a search."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BATCH:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


class _Block:
    """Rows of the state table as arrays; rows with wide components are lists of whole numbers beside them."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table
        n = table.num_rows
        self.first, self.second, self.upper, self.lower = (table.column(c).to_numpy().copy() for c in ("first", "second", "upper", "lower"))
        whole = table.column("whole").combine_chunks()
        self.is_wide = whole.is_null().to_numpy(zero_copy_only=False)
        size = next((len(x) for x in whole if x.is_valid), 0)
        self.narrow = np.zeros((n, size), dtype=np.int64)
        if not self.is_wide.all():
            self.narrow[~self.is_wide] = whole.drop_null().flatten().to_numpy().reshape(-1, size)
        texts = table.column("wide").combine_chunks()
        self.wide = {int(i): [int(v) for v in texts[i].as_py()] for i in np.flatnonzero(self.is_wide)}

    def row(self, i: int) -> list[int]:
        return self.wide[i] if i in self.wide else self.narrow[i].tolist()

    def assign(self, search: Search) -> None:
        c = search.c
        at = np.flatnonzero(~self.is_wide)
        plain = list(self.wide)
        if len(at):
            state = [x[at] for x in (self.first, self.second, self.upper, self.lower)]
            plain += at[search.update(self.narrow[at], *state)].tolist()
            self.first[at], self.second[at], self.upper[at], self.lower[at] = state
        for i in plain:
            self.first[i], self.second[i], _ = plain_nearest(self.row(i), c.whole)
            self.upper[i], self.lower[i] = np.inf, 0.0

    def distances(self, c: Centroids) -> list[int | None]:
        """Exact squared distance of each row to its centroid, None beyond a long."""
        out: list[int | None] = exact_squares(self.narrow, c.narrow[self.first]).tolist() if self.narrow.shape[1] else [0] * len(self.first)
        for i in np.flatnonzero(self.is_wide | c.wide[self.first]).tolist():
            total = sum((a - b) ** 2 for a, b in zip(self.row(i), c.whole[self.first[i]]))
            out[i] = total if total < _LONG else None
        return out


def _whole_rows(vectors: DataFrame, key: str, vector: str, size: int, scale: int) -> DataFrame:
    """The kept vectors as whole numbers with a state that any centroids can start from."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).where(F.size("x") == size)
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    narrow = F.forall("x", lambda v: F.abs(v) < (NARROW - 1) / scale)
    return rows.select(
        "vec_id",
        F.when(narrow, F.transform("x", lambda v: F.floor(v * scale))).cast("array<long>").alias("whole"),
        F.when(~narrow, F.col("x")).alias("x"),
    )


def _with_state(rows: DataFrame, scale: int) -> DataFrame:
    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            wide = [None if x is None else [str(v) for v in whole_components(x, scale)] for x in column_of(batch, "x").to_pylist()]
            second = np.ones(n, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "vec_id"),
                    column_of(batch, "whole"),
                    pa.array(wide, pa.list_(pa.string())),
                    pa.array(np.zeros(n, dtype=np.int32)),
                    pa.array(second),
                    pa.array(np.full(n, np.inf)),
                    pa.array(np.zeros(n)),
                ],
                ["vec_id", "whole", "wide", "first", "second", "upper", "lower"],
            )

    return rows.mapInArrow(widen, STATE)


def starting_centroids(state: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors of least sha256 of ``seed:vec_id``, in that order."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = state.select(told.alias("draw"), "whole", "wide").orderBy(F.asc_nulls_last("draw"), "whole", "wide").limit(k)
    return [r["whole"] if r["whole"] is not None else [int(v) for v in r["wide"]] for r in first.collect()]


def _step(state: DataFrame, centroids: Centroids) -> DataFrame:
    """The state after one assignment."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for table in _blocks(batches):
            block = _Block(table)
            block.assign(search)
            kept = [table.column(c).combine_chunks() for c in ("vec_id", "whole", "wide")]
            state = [pa.array(block.first), pa.array(block.second), pa.array(block.upper), pa.array(block.lower)]
            yield pa.RecordBatch.from_arrays([*kept, *state], table.schema.names)

    return state.select(*state.columns).mapInArrow(assign, STATE)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    """A whole number in parts of 40 bits, the last with the sign."""
    k = 0
    while not -_LONG // 2 <= total < _LONG // 2:
        yield k, total & ((1 << _LIMB) - 1)
        total >>= _LIMB
        k += 1
    yield k, total


def updated_centroids(state: DataFrame, centroids: Centroids) -> Centroids:
    """floor(sum / count) of each centroid's vectors; an empty one stays."""
    k, size = centroids.k, len(centroids.whole[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size), dtype=object)
        count = np.zeros(k, dtype=np.int64)
        for table in _blocks(batches):
            block = _Block(table)
            count += np.bincount(block.first, minlength=k)
            for j in np.unique(block.first):
                total[j] += block.narrow[block.first == j].sum(axis=0).astype(object)
            for i, row in block.wide.items():
                total[block.first[i]] += np.array(row, dtype=object)
        rows = [(j, -1, 0, int(count[j])) for j in range(k) if count[j]]
        rows += [(j, i, limb, v) for j in range(k) if count[j] for i in range(size) for limb, v in _limbs(int(total[j, i]))]
        if rows:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "component", "limb", "part"])

    found = state.mapInArrow(sums, "cluster int, component int, limb int, part long")
    found = found.groupBy("cluster", "component", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    total, count = [[0] * size for _ in range(k)], [0] * k
    for r in found.collect():
        part = int(r["part"]) << (_LIMB * r["limb"])
        if r["component"] < 0:
            count[r["cluster"]] += part
        else:
            total[r["cluster"]][r["component"]] += part
    whole = [[t // n for t in row] if n else old for row, n, old in zip(total, count, centroids.whole)]
    return Centroids(whole, centroids)


def centroid_digest(whole: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, whole)).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    seed: int = 2,
    key: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each kept vector after ``rounds`` rounds and one more assignment, and the centroids."""
    spark = vectors.sparkSession
    state = materialize(_with_state(_whole_rows(vectors, key, vector, size, scale), scale), "shallot")
    start = starting_centroids(state, k, seed)
    if not start:
        return spark.createDataFrame([], ASSIGNED), []
    centroids = Centroids(start)
    if centroids.k == 1:
        state = state.withColumn("second", F.lit(0))
    for _ in range(rounds):
        before, state = state, materialize(_step(state, centroids), "shallot")
        discard(before)
        centroids = updated_centroids(state, centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for table in _blocks(batches):
            block = _Block(table)
            block.assign(search)
            columns = [table.column("vec_id").combine_chunks(), pa.array(block.first), pa.array(block.distances(centroids), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return state.mapInArrow(last, ASSIGNED), centroids.whole


def cluster_digests(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with the sum of distances of its cluster and of all, and a digest of the cluster's centroid."""
    spark = assigned.sparkSession
    assigned = materialize(assigned, "clusters")
    sums = assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), (F.count("*") > F.count("distance")).alias("open")
    )
    of = {r["cluster"]: None if r["open"] else int(r["total"]) for r in sums.collect()}
    whole = None if None in of.values() else sum(of.values())

    def fit(total: int | None) -> int | None:
        return total if total is not None and total < _LONG else None

    rows = [(j, fit(of[j]), fit(whole), centroid_digest(c)) for j, c in enumerate(centroids) if j in of]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each centroid.
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 40, rounds: int = 5) -> str:
    """The same clusters by comparison of all vectors with all centroids, round by round, in DuckDB."""
    squares = "list_sum(list_transform(list_zip(r.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint"
    parts = [
        """rows AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id,
        list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v
      FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS j, v FROM rows
      ORDER BY sha256('2:' || vec_id) LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
      SELECT r.r, any_value(r.vec_id) AS vec_id, any_value(r.v) AS v, min({squares} * 64 + c.j) AS near
      FROM rows r CROSS JOIN c{i} c GROUP BY r.r)""")
        if i < rounds:
            parts.append(f"""s{i} AS MATERIALIZED (
      SELECT near % 64 AS j, i, sum(v[i])::bigint AS s, count(*)::bigint AS n
      FROM a{i}, range(1, 65) AS t(i) GROUP BY ALL),
    c{i + 1} AS MATERIALIZED (
      SELECT c.j, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
        SELECT j, list((s - ((s % n + n) % n)) // n ORDER BY i) AS v FROM s{i} GROUP BY j) m ON m.j = c.j)""")
    return "WITH " + ",\n    ".join(parts) + f"""
    SELECT a.vec_id, (a.near % 64)::int AS cluster, (a.near // 64)::bigint AS distance,
      (sum(a.near // 64) OVER (PARTITION BY a.near % 64))::bigint AS cluster_inertia,
      (sum(a.near // 64) OVER ())::bigint AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN c{rounds} c ON c.j = a.near % 64
    """
