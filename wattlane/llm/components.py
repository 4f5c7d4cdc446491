"""Connected components by alternating large-star and small-star steps.

Each step is two shuffles of the edges and is written to the shared folder; the number of rounds
grows with the logarithm of the longest path. Up to ``SMALL`` edges, by a count of them, one task joins
them with a union-find instead, to the same result. No vertex or edge list reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.session import materialize


SMALL = 200_000


def _union_find(edges: DataFrame) -> DataFrame:
    """(node, component) of a bounded number of edges, in one task."""
    kind = edges.schema["a"].dataType.simpleString()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        types = None
        for batch in batches:
            types = batch.schema.field("a").type
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                parent.setdefault(a, a)
                parent.setdefault(b, b)
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if parent:
            nodes = list(parent)
            columns = [pa.array(nodes, types), pa.array([find(x) for x in nodes], types)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "component"])

    return edges.select("a", "b").coalesce(1).mapInArrow(join, f"node {kind}, component {kind}")


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, label: str = "components", small: int = SMALL) -> DataFrame:
    """(node, component) of every node with an edge (a, b); a component is named by its least node."""
    now = materialize(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    before = _fingerprint(now)
    if before[0] <= small:
        return materialize(_union_find(now), label)
    while before[0]:
        # Large star: every larger neighbour of u gets the least vertex around u.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        # Small star: u and its smaller neighbours get the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
        now = materialize(small.where("a != b").distinct(), label)
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
