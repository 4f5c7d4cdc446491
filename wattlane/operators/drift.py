"""Distribution drift between two parts of a feature table."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.functions.gram import Summary, _matrix, collected, summarize
from wattlane.functions.quantiles import exact_quantiles
from wattlane.schema import PART
from wattlane.session import materialize

BINS = 1000
COLUMN_THRESHOLD = 0.1
DATASET_THRESHOLD = 0.5
REPORT = "feature string, ks double, wasserstein double, psi double, drifted boolean, drift_share double, dataset_drift boolean"


def _bins(v: np.ndarray, low: float, width: float) -> np.ndarray:
    if not width > 0:
        return np.zeros(len(v), dtype=np.int64)
    return np.minimum(np.floor((v - low) / width), BINS - 1).astype(np.int64)


def _values_in(hits: list[np.ndarray], lows: np.ndarray, highs: np.ndarray) -> Callable:
    """The different values in the bins ``hits`` of each feature, with their rows in both parts, batch by batch."""
    width = (highs - lows) / BINS
    wanted = np.zeros((len(hits), BINS), dtype=bool)
    for k, bins in enumerate(hits):
        wanted[k, bins] = True

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, len(hits) + 1)
            own, out = x[:, 0] == 1, []
            for k in range(len(hits)):
                there = np.flatnonzero(~np.isnan(x[:, k + 1]))
                there = there[wanted[k, _bins(x[there, k + 1], lows[k], width[k])]]
                value, at = np.unique(x[there, k + 1], return_inverse=True)
                ref, both = np.bincount(at[own[there]], minlength=len(value)), np.bincount(at, minlength=len(value))
                out.append((np.full(len(value), k), value, ref, both - ref))
            kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int64())
            columns = [pa.array(np.concatenate(c), kind) for c, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["k", "x", "ref", "cur"])

    return found


def _histograms(lows: np.ndarray, highs: np.ndarray) -> Summary:
    """Counts of both parts and the least value of every bin and feature, from (is reference, features).

    The state has one block of (reference, current, least value) rows of ``BINS`` bins for each feature.
    """
    width = (highs - lows) / BINS

    def local(x: np.ndarray) -> np.ndarray:
        own = x[:, 0] == 1
        out = np.zeros((len(lows), 3, BINS))
        out[:, 2] = np.inf
        for i in range(len(lows)):
            there = ~np.isnan(x[:, i + 1])
            v = x[there, i + 1]
            place = _bins(v, lows[i], width[i])
            out[i, 0] = np.bincount(place[own[there]], minlength=BINS)
            out[i, 1] = np.bincount(place[~own[there]], minlength=BINS)
            np.minimum.at(out[i, 2], place, v)
        return out.ravel()

    def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.reshape(-1, 3, BINS), b.reshape(-1, 3, BINS)
        return np.concatenate([a[:, :2] + b[:, :2], np.minimum(a[:, 2:], b[:, 2:])], axis=1).ravel()

    return Summary(local, merge)


def _decile_bins(ref: np.ndarray) -> np.ndarray:
    """Bins in which a decile of the reference falls, or between which it does."""
    places = np.arange(1, 10) / 10 * (ref.sum() - 1)
    first, last = (np.searchsorted(np.cumsum(ref), side(places), side="right") for side in (np.floor, np.ceil))
    return np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)]))


def drift_report(
    df: DataFrame, features: list[str], reference: str = "train", current: str = "test"
) -> DataFrame:
    """Per feature: KS, Wasserstein distance over the reference deviation, and PSI.

    Both parts are binned over shared edges, so the distance between the two
    distribution functions is taken over at most ``BINS`` rows per feature. PSI uses the
    exact deciles of the reference with half a row added to each count. One pass finds the limits, a
    second one all histograms; only values of the bins in which a decile falls are looked at once more.
    Null and NaN values are left out; a feature without values has no row.
    """
    spark = df.sparkSession
    own = (F.col(PART) == reference).cast("double").alias("_ref")
    numbers = [F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"_f{i}") for i, c in enumerate(features)]
    rows = df.where(F.col(PART).isin(reference, current)).select(own, *numbers)
    names = [f"_f{i}" for i in range(len(features))]
    sides = rows.agg(
        *(f(c).alias(f"{f.__name__}{c}") for c in names for f in (F.min, F.max)),
        *(F.stddev_pop(F.when(F.col("_ref") == 1, F.col(c))).alias(f"s{c}") for c in names),
    ).first()
    kept = [i for i, c in enumerate(names) if sides[f"min{c}"] is not None]
    if not kept:
        return spark.createDataFrame([], REPORT)
    lows, highs = (np.array([sides[f"{f}{names[i]}"] for i in kept]) for f in ("min", "max"))
    summary = _histograms(lows, highs)
    state = collected(summarize(rows, ["_ref", *(names[i] for i in kept)], summary), [], summary)[()]
    tables = state.reshape(len(kept), 3, BINS)

    hits = [_decile_bins(t[0]) if t[0].sum() else np.zeros(0, dtype=np.int64) for t in tables]
    # Summed and written once: the deciles and the counts between them read it.
    close = rows.select("_ref", *(names[i] for i in kept)).mapInArrow(_values_in(hits, lows, highs), "k int, x double, ref long, cur long")
    close = materialize(close.groupBy("k", "x").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")), "close-values")
    # Every other bin stands for all its rows with its least value: no decile lies between two of them.
    far = [
        (k, float(t[2, b]), int(t[0, b]), int(t[1, b]))
        for k, t in enumerate(tables)
        for b in np.flatnonzero(t[0] + t[1])
        if b not in hits[k]
    ]
    counts = close.unionByName(spark.createDataFrame(far, "k int, x double, ref long, cur long"))
    tenths = {f"d{i}": i / 10 for i in range(1, 10)}
    deciles = {r["k"]: [r[d] for d in tenths] for r in exact_quantiles(counts.where(F.col("ref") > 0), "x", tenths, ["k"], weight="ref").collect()}
    edges = spark.createDataFrame(list(deciles.items()), "k int, edges array<double>")
    # One row for each feature.
    placed = counts.join(F.broadcast(edges), "k").withColumn("decile", F.size(F.filter("edges", lambda e: e < F.col("x"))))
    parts = {k: np.zeros((2, 10)) for k in deciles}
    for r in placed.groupBy("k", "decile").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")).collect():
        parts[r["k"]][:, r["decile"]] = r["ref"], r["cur"]

    report = []
    for k, i in enumerate(kept):
        ref, cur, _ = tables[k]
        sigma = sides[f"s{names[i]}"]
        ks = distance = psi = None
        if ref.sum() and cur.sum():
            gap = np.abs(np.cumsum(ref) / ref.sum() - np.cumsum(cur) / cur.sum())
            first = int(np.flatnonzero(ref + cur)[0])
            ks = float(gap.max())
            distance = float(gap[first:].sum() * (highs[k] - lows[k]) / BINS / sigma) if sigma and sigma > 0 else None
        if k in parts:
            a, b = (parts[k] + 0.5) / (parts[k].sum(axis=1, keepdims=True) + 5.0)
            psi = math.fsum((b - a) * np.log(b / a))
        report.append((features[i], ks, distance, psi, distance is not None and distance >= COLUMN_THRESHOLD))
    share = sum(r[-1] for r in report) / len(report)
    return spark.createDataFrame([(*r, share, share >= DATASET_THRESHOLD) for r in report], REPORT)
