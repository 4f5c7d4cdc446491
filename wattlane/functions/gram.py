"""Matrix summaries of rows that merge: cross-products, pairwise correlations and triangular factors.

Each task reduces its rows, Arrow batch by Arrow batch, to one small state for every group; states are
merged in two levels, so neither a row nor a wide aggregate travels, and what one task
or the driver gets is a bounded number of states.

A state is a flat array of doubles, which travels as bytes. ``Summary.local`` makes one of the rows of a matrix, ``Summary.merge`` joins two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.session import package_for_workers

SLOTS = 16
HELD_GROUPS = 256
State = np.ndarray


@dataclass(frozen=True)
class Summary:
    local: Callable[[np.ndarray], State]
    merge: Callable[[State, State], State]


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The last ``width`` columns as a matrix of doubles, nulls as masked NaN (see ``MISSING``)."""
    at = batch.num_columns - width
    columns = []
    for i in range(at, batch.num_columns):
        column = batch.column(i)
        values = column.to_numpy(zero_copy_only=False).astype(np.float64, copy=column.null_count > 0)
        if column.null_count:
            values[column.is_null().to_numpy(zero_copy_only=False)] = MISSING
        columns.append(values)
    return np.column_stack(columns) if columns else np.zeros((batch.num_rows, 0))


# A null is told from a NaN of the data by its bits.
MISSING = np.array([0x7FF80000DEADBEEF], dtype=np.uint64).view(np.float64)[0]
_MISSING_BITS = np.uint64(0x7FF80000DEADBEEF)


def is_missing(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64) == _MISSING_BITS


def summarize(df: DataFrame, columns: list[str | Column], summary: Summary, by: dict[str, Column] | None = None, spread: bool = True) -> DataFrame:
    """(the columns of ``by``, ``state``): for each group a bounded number of states that are still to be merged.

    Without ``spread`` there is a state for each task: for inputs that are known to have few.
    """
    package_for_workers(df.sparkSession)
    by = by or {}
    names, width = list(by), len(columns)
    values = [(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"_x{i}") for i, c in enumerate(columns)]
    rows = df.select(*(c.alias(name) for name, c in by.items()), *values)
    kinds = [rows.schema[name] for name in by]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kinds)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slot = TaskContext.get().partitionId() % SLOTS
        held: dict[tuple, State] = {}
        keys_schema = None

        def out() -> pa.RecordBatch:
            keys = list(held)
            arrays = [pa.array([k[i] for k in keys], f.type) for i, f in enumerate(keys_schema)]
            arrays += [pa.array([slot] * len(keys), pa.int32()), pa.array([_packed(s) for s in held.values()], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, [*names, "slot", "state"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys_schema = [batch.schema.field(i) for i in range(len(names))]
            x = _matrix(batch, width)
            for key, at in _groups(batch, len(names)):
                state = summary.local(x if at is None else x[at])
                held[key] = summary.merge(held[key], state) if key in held else state
            if len(held) > HELD_GROUPS:
                yield out()
                held = {}
        if held:
            yield out()

    def merged(table):
        keys = [table.column(i)[:1] for i in range(len(names))]
        total = _merge_all(table.column("state").to_pylist(), summary)
        return pa.table([*keys, pa.array([table.column("slot")[0].as_py()], pa.int32()), pa.array([_packed(total)], pa.binary())], [*names, "slot", "state"])

    found = rows.mapInArrow(partial, f"{schema}slot int, state binary")
    if not spread:
        return found.drop("slot")
    return found.groupBy(*names, "slot").applyInArrow(merged, f"{schema}slot int, state binary").drop("slot")


def _groups(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[tuple, np.ndarray | None]]:
    """(key, row numbers) of the groups of a batch; no row numbers where the batch is one group."""
    if not keys:
        yield (), None
        return
    codes = np.zeros(batch.num_rows, dtype=np.int64)
    values = []
    for i in range(keys):
        coded = batch.column(i).dictionary_encode(null_encoding="encode")
        values.append(coded.dictionary.to_pylist())
        codes = codes * max(1, len(values[-1])) + coded.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    kinds, first = np.unique(codes[order], return_index=True)
    for code, at in zip(kinds.tolist(), np.split(order, first[1:])):
        key = []
        for part in reversed(values):
            code, k = divmod(code, len(part))
            key.append(part[k])
        yield tuple(reversed(key)), None if len(kinds) == 1 else at


def _packed(state: State) -> bytes:
    return np.ascontiguousarray(state, dtype="<f8").tobytes()


def _merge_all(states: list[bytes], summary: Summary) -> State:
    """Pairwise, so that rounding grows with the depth only."""
    level = [np.frombuffer(s, dtype="<f8") for s in states]
    while len(level) > 1:
        pairs = [summary.merge(a, b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def collected(found: DataFrame, keys: list[str], summary: Summary) -> dict[tuple, State]:
    """The merged state of each group; only for a bounded number of groups."""
    states: dict[tuple, list] = {}
    for row in found.collect():
        states.setdefault(tuple(row[k] for k in keys), []).append(row["state"])
    return {key: _merge_all(parts, summary) for key, parts in states.items()}


def tabulated(found: DataFrame, by: list[str], summary: Summary, rows: Callable[[State], dict[str, list]], fields: str) -> DataFrame:
    """The rows that ``rows`` makes of the merged state of each group, as a table with the group's columns before."""
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in found.schema.fields if f.name in by)

    def finish(table):
        made = rows(_merge_all(table.column("state").to_pylist(), summary))
        n = len(next(iter(made.values())))
        keys = {k: pa.chunked_array([table.column(k)[:1].combine_chunks().take(pa.array([0] * n, pa.int32()))]) for k in by}
        return pa.table({**keys, **made})

    return found.groupBy(*by).applyInArrow(finish, schema + fields)


# ---- cross-products of complete rows: n, means, centred products


def _split(state: State) -> tuple[float, np.ndarray, np.ndarray]:
    p = int((np.sqrt(4 * len(state) - 3) - 1) / 2)
    return state[0], state[1 : p + 1], state[p + 1 :].reshape(p, p)


def _cross_local(x: np.ndarray) -> State:
    shifted = x - x[0]  # equal values become exact zeros
    mean = shifted.mean(axis=0)
    centred = shifted - mean
    return np.concatenate([[len(x)], x[0] + mean, (centred.T @ centred).ravel()])


def _cross_merge(a: State, b: State) -> State:
    (n, mean, cross), (m, other, more) = _split(a), _split(b)
    gap = other - mean
    total = n + m
    return np.concatenate([[total], mean + gap * (m / total), (cross + more + np.outer(gap, gap) * (n * m / total)).ravel()])


CROSS = Summary(_cross_local, _cross_merge)


def cross_products(df: DataFrame, columns: list[str], by: Column | None = None) -> dict[object, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, means and centred cross-products, overall (key None) or per value of ``by``, of which there are few."""
    keys = {} if by is None else {"_group": by}
    found = collected(summarize(df, columns, CROSS, keys), list(keys), CROSS)
    return {key[0] if key else None: (int(n), mean, cross) for key, (n, mean, cross) in ((k, _split(s)) for k, s in found.items())}


# ---- pairwise-complete correlations: for each pair its rows, means, squares and products


def _pair_local(x: np.ndarray) -> State:
    gone = is_missing(x)
    there = (~gone).astype(np.float64)
    odd = np.isnan(x) & ~gone
    clean = np.where(np.isfinite(x), x, 0.0)
    first = np.array([clean[at[0], j] if len(at := np.flatnonzero(there[:, j])) else 0.0 for j in range(x.shape[1])])
    z = np.where(np.isfinite(x), clean - first, 0.0)
    z = (z - (z.sum(axis=0) / np.maximum(there.sum(axis=0), 1))) * there if np.any(z) else z
    n = there.T @ there
    sums = z.T @ there
    squares = (z * z).T @ there
    size = np.maximum(n, 1)
    odd = (odd | (np.isinf(x) & ~gone)).astype(np.float64)
    spoiled = odd.T @ there + there.T @ odd
    # Means are those of the values, not of the shifted ones.
    shift = np.where(there.sum(axis=0) > 0, first + _mean_of(clean - first, there), 0.0)
    mean = shift[:, None] + sums / size
    return np.concatenate([v.ravel() for v in (n, mean, squares - sums * sums / size, z.T @ z - sums * sums.T / size, spoiled)])


def _mean_of(z: np.ndarray, there: np.ndarray) -> np.ndarray:
    return (z * there).sum(axis=0) / np.maximum(there.sum(axis=0), 1)


def _pair_merge(a: State, b: State) -> State:
    p = int(np.sqrt(len(a) / 5))
    (n, mean, square, cross, spoiled), (m, other, more, too, bad) = a.reshape(5, p, p), b.reshape(5, p, p)
    total = n + m
    size = np.maximum(total, 1)
    gap = np.where((n > 0) & (m > 0), other - mean, 0.0)
    weight = n * m / size
    return np.concatenate(
        [
            v.ravel()
            for v in (
                total,
                np.where(n > 0, mean + gap * (m / size), other),
                square + more + gap * gap * weight,
                cross + too + gap * gap.T * weight,
                spoiled + bad,
            )
        ]
    )


PAIRS = Summary(_pair_local, _pair_merge)


def pair_correlations(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by, x, y, correlation) of all ordered pairs; null below two common rows, NaN where one side is constant."""

    def rows(state: State) -> dict[str, list]:
        p = len(columns)
        n, _, square, cross, spoiled = state.reshape(5, p, p)
        with np.errstate(divide="ignore", invalid="ignore"):
            value = cross / np.sqrt(square * square.T)
        value = np.where(spoiled > 0, np.nan, value)
        known = n > 1
        return {
            "x": [columns[i] for i in range(p) for _ in range(p)],
            "y": [columns[j] for _ in range(p) for j in range(p)],
            "correlation": [v if k else None for v, k in zip(value.ravel().tolist(), known.ravel().tolist())],
        }

    found = summarize(df, columns, PAIRS, {c: F.col(c) for c in by})
    return tabulated(found, by, PAIRS, rows, "x string, y string, correlation double")


# ---- triangular factors


def _factor(x: np.ndarray) -> State:
    r = np.linalg.qr(x, mode="r")
    p = x.shape[1]
    return np.vstack([r, np.zeros((p - len(r), p))]).ravel() if len(r) < p else r.ravel()


def _factor_merge(a: State, b: State) -> State:
    p = int(np.sqrt(len(a)))
    return _factor(np.vstack([a.reshape(p, p), b.reshape(p, p)]))


FACTOR = Summary(_factor, _factor_merge)


def triangular_factor(df: DataFrame, columns: list[str | Column]) -> np.ndarray | None:
    """R of a QR factorisation of the rows, reduced in a tree; the condition number is not squared."""
    found = collected(summarize(df, columns, FACTOR), [], FACTOR)
    return found[()].reshape(len(columns), -1) if found else None


def independent_columns(r: np.ndarray, whole: np.ndarray, tolerance: float = 1e-11, flat: float = 1e-13) -> list[int]:
    """Columns that no combination of the others replaces, by column-pivoted elimination of unit columns.

    ``whole`` has the lengths of the columns before they were centred; what is left of a constant one is rounding.
    """
    size = np.sqrt((r * r).sum(axis=0))
    rest = r / np.where(size > 0, size, 1.0)
    left = [j for j in range(r.shape[1]) if size[j] > flat * whole[j]]
    kept: list[int] = []
    while left:
        norms = np.sqrt((rest[:, left] ** 2).sum(axis=0))
        best = left[int(norms.argmax())]
        if norms.max() <= tolerance:
            break
        axis = rest[:, best] / norms.max()
        kept.append(best)
        left.remove(best)
        for _ in range(2):  # the second time takes away what rounding left
            rest[:, left] -= np.outer(axis, axis @ rest[:, left])
    return sorted(kept)
