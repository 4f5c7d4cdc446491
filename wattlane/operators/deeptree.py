"""A single tree without a bound on its depth, as a table of nodes that no task and not the driver holds whole.

Rows with equal features cannot be told apart, so they are summed first. Nodes of more than ``LIMIT`` different
rows are split on histograms, as in ``boosting``; the tree of these is small. Below each of its leaves one task grows the
rest on exact values, until all rows of a node have one mean. Rows to score go to the nodes of their leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.functions.gram import Summary, collected, summarize
from wattlane.operators import boosting
from wattlane.operators.sampling import sample_n
from wattlane.schema import VALUE, require_columns
from wattlane.session import materialize, package_for_workers

LIMIT = 200_000  # different rows below a leaf of the top
TOGETHER = 64  # nodes whose histograms are counted in a pass
SCORED = 500_000  # rows that are scored together
NODES = "leaf int, node int, feature int, threshold double, left int, right int, value double"


@dataclass(frozen=True)
class DeepTree:
    """``top`` gives the number of the leaf that a row's nodes are kept under."""

    features: tuple[str, ...]
    top: boosting.TreeModel
    nodes: DataFrame

    def score(self, df: DataFrame) -> DataFrame:
        """Rows with all features and their ``prediction``; a leaf that many rows reach is scored in several tasks."""
        leaf = self.top.prediction().cast("int")
        rows = df.na.drop(subset=list(self.features)).withColumn("_leaf", leaf)
        rows = materialize(rows, "leaves")
        sizes = rows.groupBy("_leaf").agg(F.ceil(F.count("*") / SCORED).alias("_parts"))
        numbers = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(self.features)]
        rows = rows.join(F.broadcast(sizes), "_leaf")
        rows = rows.select("_leaf", F.floor(F.rand(0) * F.col("_parts")).alias("_part"), *numbers, *df.columns)
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("part")
        nodes = self.nodes.join(F.broadcast(sizes.withColumnRenamed("_leaf", "leaf")), "leaf").select("leaf", copies, *self.nodes.columns[1:])
        p, width = len(self.features), len(df.columns)
        schema = df.withColumn("prediction", F.lit(0.0)).schema

        def walked(key, table, tree):
            if not table.num_rows:
                return table.select(range(2 + p, 2 + p + width)).append_column("prediction", pa.array([], pa.float64()))
            x = np.column_stack([table.column(2 + i).to_numpy() for i in range(p)])
            place = np.argsort(tree.column("node").to_numpy())
            feature, threshold, left, right, value = (tree.column(c).to_numpy()[place] for c in ("feature", "threshold", "left", "right", "value"))
            node = np.zeros(len(x), dtype=np.int64)
            while len(at := np.flatnonzero(feature[node] >= 0)):
                n = node[at]
                node[at] = np.where(x[at, feature[n]] <= threshold[n], left[n], right[n])
            return table.select(range(2 + p, 2 + p + width)).append_column("prediction", pa.array(value[node]))

        package_for_workers(df.sparkSession)
        return rows.groupBy("_leaf", "_part").cogroup(nodes.groupBy("leaf", "part")).applyInArrow(walked, schema)


def grow(x: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
    """Feature (-1 for leaves), threshold, left, right and value of the nodes of different rows ``x`` with counts and sums.

    All nodes of a level are split together: rows stay sorted by (node, value) for each feature.
    """
    m, p = x.shape
    mean = total.sum() / n.sum()
    off, each = total - mean * n, total / n
    node = np.zeros(m, dtype=np.int64)
    order = [np.argsort(x[:, f], kind="stable") for f in range(p)]
    feature, threshold, left, right = [np.array([-1])], [np.zeros(1)], [np.zeros(1, dtype=np.int64)], [np.zeros(1, dtype=np.int64)]
    value, first, count = [np.array([mean])], 0, 1
    while True:
        # The rows of the nodes from ``first`` on, the newest level, in ``count`` nodes.
        here = node - first
        rows = np.flatnonzero(here >= 0)
        if not len(rows):
            break
        low, high = np.full(count, np.inf), np.full(count, -np.inf)
        np.minimum.at(low, here[rows], each[rows])
        np.maximum.at(high, here[rows], each[rows])
        mixed = high > low
        all_n, all_s = np.bincount(here[rows], n[rows], minlength=count), np.bincount(here[rows], off[rows], minlength=count)
        best, at_feature, at_cut = np.full(count, -np.inf), np.full(count, -1), np.zeros(count)
        for f in range(p):
            o = order[f]
            o = o[here[o] >= 0]
            o = o[mixed[here[o]]]
            o = order[f] = o[np.argsort(here[o], kind="stable")]
            if len(o) < 2:
                continue
            of, v = here[o], x[o, f]
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            sizes = np.diff(np.append(starts, len(o)))
            nl, sl = np.cumsum(n[o]), np.cumsum(off[o])
            nl, sl = nl - np.repeat(nl[starts] - n[o[starts]], sizes), sl - np.repeat(sl[starts] - off[o[starts]], sizes)
            nr, sr = all_n[of] - nl, all_s[of] - sl
            cut = np.append((of[1:] == of[:-1]) & (v[1:] > v[:-1]), False)
            gain = np.full(len(o), -np.inf)
            gain[cut] = sl[cut] ** 2 / nl[cut] + sr[cut] ** 2 / nr[cut]
            most = np.maximum.reduceat(gain, starts)
            hits = np.flatnonzero(cut & (gain == np.repeat(most, sizes)))
            of_hit, one = np.unique(of[hits], return_index=True)
            hits = hits[one]
            better = gain[hits] > best[of_hit]
            of_hit, hits = of_hit[better], hits[better]
            middle = v[hits] + (v[hits + 1] - v[hits]) / 2
            best[of_hit], at_feature[of_hit] = gain[hits], f
            at_cut[of_hit] = np.where(middle < v[hits + 1], middle, v[hits])
        split = np.flatnonzero(at_feature >= 0)
        if not len(split):
            break
        start = first + count
        level = slice(first, first + count)
        flat = [np.concatenate(a) for a in (feature, threshold, left, right)]
        flat[0][level], flat[1][level] = at_feature, at_cut
        flat[2][first + split], flat[3][first + split] = start + 2 * np.arange(len(split)), start + 1 + 2 * np.arange(len(split))
        rows = rows[at_feature[here[rows]] >= 0]
        k = node[rows]
        node[rows] = np.where(x[rows, flat[0][k]] <= flat[1][k], flat[2][k], flat[3][k])
        first, count = start, 2 * len(split)
        new = node[rows] - first
        value.append(np.bincount(new, total[rows], minlength=count) / np.bincount(new, n[rows], minlength=count))
        feature, threshold, left, right = ([a, b] for a, b in zip(flat, (np.full(count, -1), np.zeros(count), np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64))))
    return (*(np.concatenate(a) for a in (feature, threshold, left, right)), np.concatenate(value))


def _top(vectors: DataFrame, features: list[str], limit: int) -> boosting.TreeModel:
    """The tree whose leaves have at most ``limit`` different rows; their values are their numbers."""
    p = len(features)
    names = [f"x{i}" for i in range(p)]
    drawn = sample_n(vectors, boosting.EDGE_SAMPLE, keys=names).select(*names).toPandas().to_numpy(dtype=np.float64)
    edges = [boosting.bin_edges(drawn[:, i]) for i in range(p)]
    nodes = [[-1, 0.0, 0, 0]]
    queue = [0]
    while queue:
        wanted, queue = queue[:TOGETHER], queue[TOGETHER:]
        feature, cut, left, right = (np.array(c) for c in zip(*nodes))
        place = np.full(len(nodes), -1)
        place[wanted] = np.arange(len(wanted))
        size = (len(wanted), p, boosting.BINS, 3)

        def local(x: np.ndarray) -> np.ndarray:
            node = np.zeros(len(x), dtype=np.int64)
            while len(at := np.flatnonzero(feature[node] >= 0)):
                k = node[at]
                node[at] = np.where(x[at, feature[k]] <= cut[k], left[k], right[k])
            to = place[node]
            x, to = x[to >= 0], to[to >= 0]
            out = np.zeros(size)
            for i in range(p):
                code = to * boosting.BINS + np.searchsorted(edges[i], x[:, i])
                for j, weight in enumerate((x[:, p], x[:, p + 1], None)):
                    out[:, i, :, j] = np.bincount(code, weight, minlength=size[0] * boosting.BINS).reshape(-1, boosting.BINS)
            return out.ravel()

        summary = Summary(local, np.add)
        hists = collected(summarize(vectors, [*names, "n", "total"], summary), [], summary)
        for k, hist in zip(wanted, hists[()].reshape(size) if hists else []):
            found = boosting.best_split(hist[..., :2], 1) if hist[0, :, 2].sum() > limit else None
            if found:
                _, f, b = found
                nodes[k] = [f, float(edges[f][b]), len(nodes), len(nodes) + 1]
                queue += [len(nodes), len(nodes) + 1]
                nodes += [[-1, 0.0, 0, 0], [-1, 0.0, 0, 0]]
    tree = [(f, c, a, b, float(k)) for k, (f, c, a, b) in enumerate(nodes)]
    return boosting._assembled(features, 0.0, [tree])


def fit_deep_tree(df: DataFrame, features: list[str], target: str = VALUE, limit: int = LIMIT) -> DeepTree:
    """The tree of the complete rows, grown until no split tells means apart; values in it are means of its rows."""
    require_columns(df, [*features, target])
    p = len(features)
    names = [f"x{i}" for i in range(p)]
    rows = df.na.drop(subset=[*features, target]).select(
        *(F.col(c).cast("double").alias(x) for c, x in zip(features, names)), F.col(target).cast("double").alias("y")
    )
    vectors = materialize(rows.groupBy(*names).agg(F.count("*").cast("double").alias("n"), F.sum("y").alias("total")), "vectors")
    if vectors.isEmpty():
        raise ValueError("no complete rows to fit on")
    top = _top(vectors, features, limit)
    package_for_workers(df.sparkSession)

    def rest(key, table):
        x = np.column_stack([table.column(f"x{i}").to_numpy() for i in range(p)])
        columns = grow(x, table.column("n").to_numpy(), table.column("total").to_numpy())
        size = len(columns[0])
        leaf = pa.array(np.full(size, key[0].as_py()), pa.int32())
        kinds = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64())
        arrays = [leaf, pa.array(np.arange(size), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds))]
        return pa.table(arrays, ["leaf", "node", "feature", "threshold", "left", "right", "value"])

    named = boosting.TreeModel(tuple(names), *(getattr(top, a) for a in ("base", "roots", "feature", "threshold", "left", "right", "value")))
    placed = vectors.withColumn("leaf", named.prediction().cast("int"))
    width = max(len(top.feature), df.sparkSession.sparkContext.defaultParallelism)
    nodes = placed.repartition(width, "leaf").groupBy("leaf").applyInArrow(rest, NODES)
    return DeepTree(tuple(features), top, materialize(nodes, "nodes"))
