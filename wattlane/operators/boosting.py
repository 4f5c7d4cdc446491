"""Leaf-wise boosted trees on histograms, and tree models as tables that the JVM scores.

Features are binned once, on edges from a bounded sample. A pass over the binned rows gives, for
several nodes at once, the sums and counts of residuals per feature and bin; tasks add them up
before anything travels, so what reaches the driver depends on the nodes, features and bins only. A tree grows
best first: the leaf of the largest gain is split next, until ``max_leaves``. One pass covers the smaller
children of all leaves that may still be split; the larger child is the rest of its parent.

A tree model is a table with a row for each node. ``TreeModel`` holds it as arrays and predicts by an
expression that walks all trees level by level.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.columns import row_hash
from wattlane.functions.gram import SLOTS, Summary, collected, summarize
from wattlane.operators.sampling import sample_n
from wattlane.schema import KEYS, VALUE, require_columns
from wattlane.session import discard, materialize, package_for_workers

NODE_FIELDS = "tree int, node int, feature string, threshold double, left int, right int, value double"
BINS = 256
EDGE_SAMPLE = 100_000  # rows that the edges of bins come from
WRITE_EVERY = 10  # trees after which scores so far are written


@dataclass(frozen=True)
class TreeModel:
    """Nodes of all trees in arrays; children are positions, a leaf's feature is -1. Predictions add up from ``base``."""

    features: tuple[str, ...]
    base: float
    roots: tuple[int, ...]
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]

    @property
    def depth(self) -> int:
        deepest, level = 0, [r for r in self.roots if self.feature[r] >= 0]
        while level:
            deepest += 1
            level = [c for n in level for c in (self.left[n], self.right[n]) if self.feature[c] >= 0]
        return deepest

    def prediction(self) -> Column:
        """Null where a feature is missing. Batches of rows are walked in NumPy, a step for each node."""
        package_for_workers(SparkSession.active())
        model = self

        @F.pandas_udf("double")
        def walk(*x: pd.Series) -> pd.Series:
            return pd.Series(model.predict(np.column_stack(x)))

        known = F.lit(True)
        for name in self.features:
            known = known & F.col(name).isNotNull()
        if not self.features:
            return F.lit(float(self.base + sum(self.value[r] for r in self.roots)))
        return F.when(known, walk(*[F.col(name).cast("double") for name in self.features]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The same for a matrix of complete rows."""
        columns = np.asfortranarray(x)
        shape = (self.feature, self.threshold, self.left, self.right)
        value, out = np.array(self.value), np.full(len(x), self.base)
        for root in self.roots:
            out += value[_walk(columns, *shape, root)]
        return out

    def rows(self) -> list[tuple]:
        """Rows of ``NODE_FIELDS``; tree -1 is the base, the first node of a tree its root."""
        out = [(-1, 0, None, None, None, None, self.base)]
        ends = [*self.roots[1:], len(self.feature)]
        for tree, (start, end) in enumerate(zip(self.roots, ends)):
            for n in range(start, end):
                inner = self.feature[n] >= 0
                name = self.features[self.feature[n]] if inner else None
                children = (self.left[n] - start, self.right[n] - start) if inner else (None, None)
                out.append((tree, n - start, name, self.threshold[n] if inner else None, *children, None if inner else self.value[n]))
        return out


def _assembled(features: list[str], base: float, trees: list[list[tuple]]) -> TreeModel:
    """Trees as lists of (feature, threshold, left, right, value), children counted within the tree."""
    columns: list[list] = [[], [], [], [], []]
    roots = []
    for nodes in trees:
        start = len(columns[0])
        roots.append(start)
        for feature, threshold, left, right, value in nodes:
            for column, v in zip(columns, (feature, threshold, left + start if feature >= 0 else 0, right + start if feature >= 0 else 0, value)):
                column.append(v)
    return TreeModel(tuple(features), base, tuple(roots), *map(tuple, columns))


def tree_table(spark: SparkSession, models: dict[str, TreeModel]) -> DataFrame:
    """Rows of (model_id, tree, node, feature, threshold, left, right, value)."""
    rows = [(name, *row) for name, model in models.items() for row in model.rows()]
    return spark.createDataFrame(rows, f"model_id string, {NODE_FIELDS}")


def tree_model_from_table(table: DataFrame, model_id: str) -> TreeModel:
    """The model as stored; the table may hold many and has no order."""
    rows = sorted(table.where(F.col("model_id") == model_id).collect(), key=lambda r: (r["tree"], r["node"]))
    if not rows:
        raise KeyError(f"no trees of {model_id!r}")
    names = sorted({r["feature"] for r in rows if r["feature"] is not None})
    base, trees = 0.0, {}
    for r in rows:
        if r["tree"] < 0:
            base = r["value"]
        elif r["feature"] is None:
            trees.setdefault(r["tree"], []).append((-1, 0.0, 0, 0, r["value"]))
        else:
            trees.setdefault(r["tree"], []).append((names.index(r["feature"]), r["threshold"], r["left"], r["right"], 0.0))
    return _assembled(names, base, list(trees.values()))


_SPLIT = re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def from_spark(model, features: list[str]) -> TreeModel:
    """The trees of a fitted tree, forest or boosting pipeline of Spark (continuous features)."""
    last = model.stages[-1]
    members = getattr(last, "trees", None) or [last]
    weights = list(last.treeWeights) if hasattr(last, "treeWeights") else [1.0]
    # A forest averages its trees, boosting adds them up.
    share = sum(weights) if type(last).__name__.startswith("RandomForest") else 1.0
    trees = []
    for member, weight in zip(members, weights):
        nodes: list[list] = []
        open_nodes: list[int] = []
        for line in member.toDebugString.splitlines():
            line = line.strip()
            if found := _SPLIT.match(line):
                kind, feature, _, threshold = found.groups()
                if kind == "If":
                    _attach(nodes, open_nodes)
                    nodes.append([int(feature), float(threshold), -1, -1, 0.0])
                    open_nodes.append(len(nodes) - 1)
            elif line.startswith("Predict:"):
                _attach(nodes, open_nodes)
                nodes.append([-1, 0.0, 0, 0, float(line.split(":")[1]) * weight / share])
                while open_nodes and nodes[open_nodes[-1]][3] >= 0:
                    open_nodes.pop()
        trees.append([tuple(n) for n in nodes])
    return _assembled(features, 0.0, trees)


def _attach(nodes: list[list], open_nodes: list[int]) -> None:
    """The next node is a child of the innermost open one, the left first."""
    while open_nodes and nodes[open_nodes[-1]][3] >= 0:
        open_nodes.pop()
    if open_nodes:
        parent = nodes[open_nodes[-1]]
        parent[2 if parent[2] < 0 else 3] = len(nodes)


# ---- growing


def bin_edges(values: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Upper edges: halfway between distinct values, or between percentiles where there are too many."""
    distinct = np.unique(values)
    if len(distinct) > bins:
        distinct = np.unique(np.percentile(values, np.linspace(0, 100, bins + 1)[1:-1], method="midpoint"))
        return distinct
    return distinct[:-1] + np.diff(distinct) / 2


def _few_values(column: DataFrame, drawn: np.ndarray) -> np.ndarray:
    """All distinct values of a column where there are few, else the drawn ones."""
    if len(np.unique(drawn)) <= BINS:
        every = column.distinct().limit(BINS + 1).toPandas().to_numpy(dtype=np.float64).ravel()
        if len(every) <= BINS:
            return every
    return drawn


@dataclass
class _Node:
    rows: float
    total: float
    hist: np.ndarray | None = None  # (features, bins, (count, sum))
    split: tuple[float, int, int] | None = None  # gain, feature, bin
    left: int = -1
    right: int = -1


def best_split(hist: np.ndarray, min_leaf: int) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best cut, rows up to the bin to the left; the first of equals."""
    upto = np.cumsum(hist, axis=1)[:, :-1]
    count, total = hist[0, :, 0].sum(), hist[0, :, 1].sum()
    n, s = upto[..., 0], upto[..., 1]
    fit = (n >= min_leaf) & (count - n >= min_leaf)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fit, s * s / n + (total - s) ** 2 / (count - n) - total * total / count, -np.inf)
    at = int(gain.argmax())
    feature, cut = divmod(at, gain.shape[1])
    return (float(gain[feature, cut]), feature, cut) if gain[feature, cut] > 1e-12 * max(1.0, abs(total)) else None


def _walk(x: np.ndarray, feature, cut, left, right, root: int = 0) -> np.ndarray:
    """Node of each row in a tree of arrays; ``feature`` -1 marks leaves. Each node divides the numbers of its rows."""
    node = np.full(len(x), root, dtype=np.int64)
    waiting = [(root, np.arange(len(x)))]
    while waiting:
        k, at = waiting.pop()
        if feature[k] < 0:
            node[at] = k
        elif len(at):
            low = x[at, feature[k]] <= cut[k]
            waiting += [(left[k], at[low]), (right[k], at[~low])]
    return node


def _arrays(nodes: list[_Node], inner: Iterable[int]) -> tuple[np.ndarray, ...]:
    """Feature (-1 for leaves), bin, left and right of all nodes, of which ``inner`` may have children."""
    feature, cut, left, right = (np.zeros(len(nodes), dtype=np.int64) for _ in range(4))
    feature[:] = -1
    for k in inner:
        if nodes[k].left >= 0:
            (_, feature[k], cut[k]), left[k], right[k] = nodes[k].split, nodes[k].left, nodes[k].right
    return feature, cut, left, right


class _Grower:
    """Trees over a binned table with columns ``x0``.., ``y`` and ``f`` (score so far)."""

    def __init__(self, binned: DataFrame, n_features: int, rate: float, max_leaves: int, min_leaf: int) -> None:
        self._use(binned)
        self.p = n_features
        self.rate, self.max_leaves, self.min_leaf = rate, max_leaves, min_leaf
        self.columns = [f"x{i}" for i in range(n_features)] + ["y", "f"]
        self.pending: list[tuple[np.ndarray, ...]] = []  # trees not yet in ``f``

    def _use(self, table: DataFrame) -> None:
        """States of few tasks go to the driver as they are, which saves a shuffle for every pass."""
        self.table = table
        self.spread = table.rdd.getNumPartitions() > SLOTS

    def _pass(self, shape: tuple[np.ndarray, ...], wanted: list[int]) -> np.ndarray:
        """(wanted nodes, features, bins, (count, sum)) of the residuals."""
        p, pending = self.p, list(self.pending)
        place = np.full(len(shape[0]), -1)
        place[wanted] = np.arange(len(wanted))
        size = (len(wanted), p, BINS, 2)

        def local(x: np.ndarray) -> np.ndarray:
            bins = x[:, :p].astype(np.int16, order="F")
            rest = x[:, p] - x[:, p + 1]
            for *tree, value in pending:
                rest = rest - value[_walk(bins, *tree)]
            to = place[_walk(bins, *shape)]
            at = to >= 0
            to, bins, rest = to[at], bins[at], rest[at]
            out = np.zeros(size)
            for i in range(p):
                code = to * BINS + bins[:, i]
                out[:, i, :, 0] = np.bincount(code, minlength=size[0] * BINS).reshape(-1, BINS)
                out[:, i, :, 1] = np.bincount(code, weights=rest, minlength=size[0] * BINS).reshape(-1, BINS)
            return out.ravel()

        summary = Summary(local, np.add)
        found = collected(summarize(self.table, self.columns, summary, spread=self.spread), [], summary)
        return found[()].reshape(size)

    def tree(self) -> list[tuple[int, int, int, int, float]]:
        """Nodes (feature, bin, left, right, value) of the next tree; its scores count from now on.

        Nodes are looked at before it is known whether the tree takes their split: a pass opens the leaves of
        most gain, also below splits not taken yet, so a tree needs about as many passes as levels.
        """
        nodes = [_Node(0, 0)]
        self._told(nodes, [0], self._pass(_arrays(nodes, range(0)), [0]))
        while True:
            taken, missing = self._best_first(nodes)
            if missing is None:
                break
            leaves = sorted((k for k, n in enumerate(nodes) if n.split and n.left < 0), key=lambda k: -nodes[k].split[0])
            self._open(nodes, list(dict.fromkeys([missing, *leaves[: self.max_leaves]])))
        # The nodes of the tree, the root first, then both children of each split in the order they were taken.
        order = [0, *(c for k in taken for c in (nodes[k].left, nodes[k].right))]
        place = {k: i for i, k in enumerate(order)}
        inner = set(taken)
        kept = []
        for k in order:
            n = nodes[k]
            left, right = (place[n.left], place[n.right]) if k in inner else (-1, -1)
            kept.append(_Node(n.rows, n.total, split=n.split, left=left, right=right))
        shape = _arrays(kept, range(len(kept)))
        value = np.array([self.rate * n.total / n.rows if n.rows and n.left < 0 else 0.0 for n in kept])
        self.pending.append((*shape, value))
        if len(self.pending) >= WRITE_EVERY:
            self._write()
        return list(zip(*(a.tolist() for a in shape), value.tolist()))

    def _told(self, nodes: list[_Node], at: list[int], hists: Iterable[np.ndarray]) -> None:
        for k, hist in zip(at, hists):
            nodes[k].hist, (nodes[k].rows, nodes[k].total) = hist, hist[0].sum(axis=0)
            nodes[k].split = best_split(hist, self.min_leaf)

    def _best_first(self, nodes: list[_Node]) -> tuple[list[int], int | None]:
        """The splits of most gain in the order they are taken, and the first node that has to be opened for more."""
        queue = [(-nodes[0].split[0], 0)] if nodes[0].split else []
        taken: list[int] = []
        while queue and len(taken) + 1 < self.max_leaves:
            _, k = heapq.heappop(queue)
            if nodes[k].left < 0:
                return taken, k
            taken.append(k)
            for c in (nodes[k].left, nodes[k].right):
                if nodes[c].split:
                    heapq.heappush(queue, (-nodes[c].split[0], c))
        return taken, None

    def _open(self, nodes: list[_Node], leaves: list[int]) -> None:
        """Histograms of the children of ``leaves``: a pass for the smaller ones, the rest by subtraction."""
        wanted = []
        for k in leaves:
            _, feature, cut = nodes[k].split
            nodes[k].left, nodes[k].right = len(nodes), len(nodes) + 1
            count = nodes[k].hist[feature, : cut + 1, 0].sum()
            wanted.append(nodes[k].left if count <= nodes[k].rows - count else nodes[k].right)
            nodes += [_Node(0, 0), _Node(0, 0)]
        for k, small, hist in zip(leaves, wanted, self._pass(_arrays(nodes, range(len(nodes))), wanted)):
            large = nodes[k].left + nodes[k].right - small
            self._told(nodes, [small, large], [hist, nodes[k].hist - hist])
            nodes[k].hist = None

    def _write(self) -> None:
        pending, p = self.pending, self.p

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = np.column_stack([batch.column(i).to_numpy() for i in range(p)]).astype(np.int64).reshape(-1, p)
                score = batch.column(p + 1).to_numpy().copy()
                for *tree, value in pending:
                    score += value[_walk(bins, *tree)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: p + 1], pa.array(score)], batch.schema.names)

        before = self.table
        self._use(materialize(before.select(*self.columns).mapInArrow(add, before.select(*self.columns).schema), "boosted"))
        discard(before)
        self.pending = []


def _drawn(rows: DataFrame, numbers: list[Column], keys: list[str], total: int) -> np.ndarray:
    """The ``EDGE_SAMPLE`` rows of least hash. Those above a bar that leaves a fifth more never reach a heap."""
    bar = int(2**32 * 1.2 * EDGE_SAMPLE / total)
    low = rows.where(row_hash(42, keys) < f"{bar:08x}") if bar < 2**32 else rows
    drawn = sample_n(low, EDGE_SAMPLE, seed=42, keys=keys).select(*numbers).toPandas().to_numpy(dtype=np.float64)
    if len(drawn) < min(EDGE_SAMPLE, total):
        drawn = sample_n(rows, EDGE_SAMPLE, seed=42, keys=keys).select(*numbers).toPandas().to_numpy(dtype=np.float64)
    return drawn


def fit_leafwise(
    df: DataFrame,
    features: list[str],
    target: str = VALUE,
    learning_rate: float = 0.08,
    rounds: int = 150,
    max_leaves: int = 31,
    min_leaf: int = 20,
    keys: list[str] | None = None,
) -> TreeModel:
    """Squared-error boosting of the complete rows; each tree has at most ``max_leaves`` leaves of ``min_leaf`` rows.

    Edges of bins come from ``EDGE_SAMPLE`` rows (all, if there are fewer), drawn by the hash of ``keys``.
    """
    require_columns(df, [*features, target])
    rows = df.na.drop(subset=[*features, target])
    numbers = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    wanted = [*(c for c in (keys or KEYS) if c in df.columns)] or [*features, target]
    # Pandas turns decimals into objects, so the sample is of doubles.
    size = rows.agg(F.avg(F.col(target).cast("double")).alias("mean"), F.count("*").alias("n")).first()
    base = size["mean"]
    if base is None:
        raise ValueError("no complete rows to fit on")
    drawn = _drawn(rows, numbers, wanted, size["n"])
    p = len(features)
    edges = [bin_edges(_few_values(rows.select(n), drawn[:, i])) for i, n in enumerate(numbers)]

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pa.array(np.searchsorted(e, batch.column(i).to_numpy()).astype(np.int16)) for i, e in enumerate(edges)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(p), pa.array(np.full(batch.num_rows, base))], [*(f"x{i}" for i in range(p)), "y", "f"])

    binned = rows.select(*numbers, F.col(target).cast("double").alias("y"))
    schema = ", ".join([*(f"x{i} short" for i in range(p)), "y double", "f double"])
    grower = _Grower(materialize(binned.mapInArrow(to_bins, schema), "binned"), p, learning_rate, max_leaves, min_leaf)
    trees = []
    for _ in range(rounds):
        nodes = grower.tree()
        trees.append([(f, float(edges[f][cut]) if f >= 0 else 0.0, left, right, v) for f, cut, left, right, v in nodes])
        if len(nodes) == 1:
            break
    discard(grower.table)
    return _assembled(list(features), float(base), trees)
