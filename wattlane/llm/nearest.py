"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample of the vectors and assigns every vector to a leaf. A query
walks it with a priority queue of subtrees, nearest centroid first, and visits leaves in that order.
How many leaves it visits is calibrated: the exact neighbours of a bounded number of calibration
queries, found by brute force over all rows, tell how many visits give the wanted recall.

Equal vectors are searched once. Of each distinct vector the k + 1 rows of least id are candidates,
which is all that any result can hold; so a vector that a third of all rows share costs as much as any
other. Leaves are split into blocks of bounded size, on the side of the candidates and of the queries.

Vectors that are null, zero, of another length than most, or that hold null or non-finite components take no
part. Null ids: neither queries nor candidates. Repeated ids: each row is a candidate, but none of its own
id. Ties go to the smaller id. Fewer than k candidates: all of them. Extra columns: ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import column_of
from wattlane.session import materialize

BRANCHES = 8


@dataclass
class Tree:
    """Nodes in order of creation; ``children`` holds (first, last) child numbers, (0, 0) for a leaf."""

    centre: np.ndarray
    children: np.ndarray
    leaf: np.ndarray  # number of the leaf, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector."""
        node = np.zeros(len(unit), dtype=np.int64)
        moving = np.arange(len(unit))
        while len(moving := moving[self.leaf[node[moving]] < 0]):
            for at in np.unique(node[moving]):
                rows = moving[node[moving] == at]
                first, last = self.children[at]
                node[rows] = first + (unit[rows] @ self.centre[first:last].T).argmax(axis=1)
        return self.leaf[node]

    def order(self, unit: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first: always on from the subtree whose centre is nearest."""
        queue = [(0.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            while self.leaf[at] < 0:
                first, last = self.children[at]
                near = self.centre[first:last] @ unit
                best = int(near.argmax())
                for k in range(last - first):
                    if k != best:
                        heapq.heappush(queue, (-float(near[k]), int(first + k)))
                at = int(first + best)
            yield int(self.leaf[at])


def fit_tree(sample: np.ndarray, leaf_rows: int, seed: int = 3, rounds: int = 12) -> Tree:
    """Spherical k-means, split again until a leaf holds at most ``leaf_rows`` of the sample."""
    rng = np.random.default_rng(seed)
    unit = _unit(sample)
    centres, children, leaf = [unit.mean(axis=0)], [(0, 0)], [-1]
    todo, n_leaves = [(0, np.arange(len(unit)))], 0
    while todo:
        at, rows = todo.pop(0)
        part = unit[rows]
        group = np.zeros(len(rows), dtype=np.int64)
        if len(rows) > leaf_rows:
            centre = part[rng.choice(len(rows), min(BRANCHES, len(rows)), replace=False)]
            for _ in range(rounds):
                group = (part @ centre.T).argmax(axis=1)
                total = np.zeros_like(centre)
                np.add.at(total, group, part)
                size = np.linalg.norm(total, axis=1, keepdims=True)
                centre = np.where(size > 0, total / np.maximum(size, 1e-30), centre)
            group = (part @ centre.T).argmax(axis=1)
        kinds = np.unique(group)
        if len(kinds) < 2:
            leaf[at], n_leaves = n_leaves, n_leaves + 1
            continue
        children[at] = (len(centres), len(centres) + len(kinds))
        for k in kinds:
            todo.append((len(centres), rows[group == k]))
            centres.append(centre[k])
            children.append((0, 0))
            leaf.append(-1)
    return Tree(np.array(centres), np.array(children), np.array(leaf))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that no square overflows or vanishes; cosines stay the same to the bit."""
    power = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    # Two steps, as the power itself may be beyond a double.
    return np.ldexp(np.ldexp(x, -(power // 2)), -(power - power // 2))


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of row i of a and row i of b, the same for equal rows wherever they stand."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def best_of(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, cosine) of the k nearest rows of each query, ties to smaller ids."""
    near = _unit(queries) @ _unit(rows).T
    k = min(k, len(ids))
    limit = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k]
    q, r = np.nonzero(near >= limit[:, None] - 1e-9)
    exact = cosines(_scaled(queries)[q], _scaled(rows)[r])
    order = np.lexsort((ids[r], -exact, q))
    q, r, exact = q[order], r[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], ids[r[keep]], exact[keep]


def usable_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("embedding") == (sizes["d"] if sizes else 0))


def _nearest(found: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _calibrate(tree: Tree, candidates: DataFrame, queries: DataFrame, k: int, recall: float, most: int) -> int:
    """Leaf visits that find the share ``recall`` of the exact neighbours of up to ``most`` queries."""
    trial = queries.orderBy(F.xxhash64("class_id")).limit(most).toPandas()
    if trial.empty:
        return 1
    vectors = np.array(trial["embedding"].tolist(), dtype=np.float64)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, ids = _matrix(column_of(batch, "embedding")), column_of(batch, "vec_id").to_numpy()
            leaf = column_of(batch, "leaf").to_numpy()
            q, found, score = best_of(vectors, rows, ids, k)
            place = {int(i): int(x) for i, x in zip(ids, leaf)}
            columns = [pa.array(q, pa.int32()), pa.array(found, pa.int64()), pa.array(score), pa.array([place[int(i)] for i in found], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["q", "vec_id", "score", "leaf"])

    truth = _nearest(candidates.mapInArrow(exact, "q int, vec_id long, score double, leaf int"), "q", k).toPandas()
    units = _unit(vectors)
    visits = []
    for q, part in truth.groupby("q"):
        place = {leaf: n for n, leaf in enumerate(tree.order(units[q]), start=1)}
        visits += [place[leaf] for leaf in part["leaf"]]
    return int(np.quantile(visits, recall, method="higher"))


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    recall: float = 0.97,
    sample_rows: int = 20_000,
    leaf_rows: int = 60,
    calibration: int = 200,
    block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of every row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = materialize(usable_vectors(vectors), "vectors")
    total = rows.count()
    least_first = Window.partitionBy("embedding").orderBy("vec_id")
    firsts = rows.withColumn("place", F.row_number().over(least_first)).where(F.col("place") <= k + 1)
    distinct = rows.groupBy("embedding").agg(F.min("vec_id").alias("class_id"))
    asked = materialize(rows.where(is_query).join(distinct, "embedding").select("vec_id", "class_id", "embedding"), "queries")
    queries = asked.dropDuplicates(["class_id"]).select("class_id", "embedding")

    span = float(1 << 53)
    draw = F.shiftrightunsigned(F.xxhash64("class_id", F.lit(5)), 11)
    sample = distinct.where(draw < F.lit(span * min(1.0, sample_rows / max(total, 1)))).orderBy("class_id").toPandas()
    if sample.empty:
        sample = distinct.orderBy("class_id").limit(1).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(np.array(sample["embedding"].tolist(), dtype=np.float64), leaf_rows)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(_unit(_matrix(column_of(batch, "embedding")))) if batch.num_rows else np.zeros(0)
            columns = [column_of(batch, "vec_id"), column_of(batch, "embedding"), pa.array(leaf, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "leaf"])

    kind = "vec_id long, embedding array<double>, leaf int"
    candidates = materialize(firsts.select("vec_id", "embedding").mapInArrow(place, kind), "candidates")
    visits = _calibrate(tree, candidates, queries, k, recall, calibration)
    held = np.zeros(tree.leaves, dtype=np.int64)
    for r in candidates.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        held[r["leaf"]] = r["n"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = []
            for unit in _unit(_matrix(column_of(batch, "embedding"))):
                seen, size = [], 0
                for leaf in tree.order(unit):
                    seen.append(leaf)
                    size += int(held[leaf])
                    if len(seen) >= visits and size > k:
                        break
                leaves.append(seen)
            columns = [column_of(batch, "class_id"), column_of(batch, "embedding"), pa.array(leaves, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["class_id", "embedding", "leaves"])

    walks = materialize(queries.mapInArrow(visit, "class_id long, embedding array<double>, leaves array<int>"), "walks")
    visited = walks.select("class_id", "embedding", F.explode("leaves").alias("leaf"))
    asked_in = np.zeros(tree.leaves, dtype=np.int64)
    for r in visited.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        asked_in[r["leaf"]] = r["n"]
    cuts = spark.createDataFrame(
        [(i, int(-(-held[i] // block)), int(-(-asked_in[i] // block))) for i in range(tree.leaves) if held[i] and asked_in[i]],
        "leaf int, candidate_parts int, query_parts int",
    )

    def parts(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Each row in one part of its own side and in all parts of the other."""
        cut = df.join(F.broadcast(cuts), "leaf")
        mine = F.pmod(F.xxhash64(key), F.col(f"{own}_parts")).cast("int")
        return cut.select(
            "leaf", key, "embedding", mine.alias(f"{own}_part"), F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"{other}_part")
        )

    keys = ["leaf", "candidate_part", "query_part"]

    def search(asking, answering):
        q, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if asking.num_rows and answering.num_rows:
            a, b = asking.combine_chunks(), answering.combine_chunks()
            ids = b.column("vec_id").to_numpy()
            vec_a, vec_b = (_matrix(t.column("embedding").combine_chunks()) for t in (a, b))
            at, found, score = best_of(vec_a, vec_b, ids, k + 1)
            q = a.column("class_id").to_numpy()[at]
        return pa.table({"class_id": pa.array(q, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.float64())})

    asking = parts(visited, "class_id", "query", "candidate").groupBy(*keys)
    answering = parts(candidates, "vec_id", "candidate", "query").groupBy(*keys)
    met = asking.cogroup(answering).applyInArrow(search, "class_id long, vec_id long, score double")
    best = _nearest(met, "class_id", 2 * k + 2).drop("rank")
    own = asked.select(F.col("vec_id").alias("query_id"), "class_id").join(best, "class_id").where("query_id != vec_id")
    ranked = _nearest(own, "query_id", k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
