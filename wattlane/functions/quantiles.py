"""Exact interpolated quantiles that never hold a group's values in one place.

Spark's own ``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here ranks are located by narrowing: a histogram over monotone value bins tells which bins hold
a wanted rank, each of these is cut into ``SUBDIVISIONS`` parts between its own least and greatest value, and so
on until a bin holds one value, however often, or at most ``limit`` rows. Only the latter are
sorted. A round reads only the rows of bins that are still open, and its histogram is combined
before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import all_of, value_bin
from wattlane.session import discard, materialize

SUBDIVISIONS = 512
SORT_LIMIT = 200_000


@dataclass(frozen=True)
class Narrowed:
    """What is left to sort, and the bins that are a single value.

    ``points`` and each frame of ``to_sort`` have the group columns, ``_parent`` and ``_bin``, the rows
    before the bin and in the group; points also the value ``_low`` and its rows, the others a row ``_v`` with ``_n``.
    """

    points: DataFrame
    to_sort: list[DataFrame]


def _same(left: list[str], right: list[str]) -> Column:
    return all_of([F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _ranks(probabilities: list[float]) -> list[Column]:
    places = [F.lit(float(p)) * (F.col("_total") - 1) for p in probabilities]
    return [side(place) for place in places for side in (F.floor, F.ceil)]


def narrow(rows: DataFrame, group: list[str], probabilities: list[float], limit: int = SORT_LIMIT) -> Narrowed:
    """Locate the wanted ranks of ``rows`` (group columns, ``_v``, ``_n``), a written table."""
    level = rows.withColumns({"_parent": F.lit(0).cast("bigint"), "_bin": value_bin("_v")})
    base: list[Column] = []  # rows before the parent and in the group, known after the first round
    keys = [*group, "_parent", "_bin"]
    points, to_sort = [], []
    while True:
        upto = W.partitionBy(*group, "_parent").orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)
        bins = level.groupBy(*keys).agg(
            F.sum("_n").alias("_weight"), F.count("*").alias("_rows"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), *base
        )
        if not base:
            bins = bins.withColumns({"_start": F.lit(0).cast("bigint"), "_total": F.sum("_weight").over(W.partitionBy(*group))})
        bins = bins.withColumn("_upto", F.sum("_weight").over(upto) + F.col("_start"))
        bins = bins.withColumn("_before", F.col("_upto") - F.col("_weight"))
        hit = F.lit(False)
        for rank in _ranks(probabilities):
            hit = hit | ((rank >= F.col("_before")) & (rank < F.col("_upto")))
        one = F.col("_low") == F.col("_high")
        kind = F.when(one, "point").when(F.col("_rows") <= limit, "sort").otherwise("open")
        number = F.row_number().over(W.partitionBy(*group).orderBy("_parent", "_bin")).cast("bigint")
        found = materialize(bins.where(hit).withColumns({"_kind": kind, "_number": number}), "rank-bins")
        points.append(found.where(F.col("_kind") == "point").select(*keys, "_low", "_weight", "_before", "_total"))
        mirror = [f"_key_{k}" for k in keys]
        targets = found.where(F.col("_kind") != "point").select(
            *(F.col(k).alias(m) for k, m in zip(keys, mirror)), "_kind", "_number", "_low", "_high", "_before", F.col("_total").alias("_all")
        )
        inside = level.drop("_start", "_total").join(targets, _same(keys, mirror))
        to_sort.append(inside.where(F.col("_kind") == "sort").select(*keys, "_v", "_n", "_before", F.col("_all").alias("_total")))
        if found.where(F.col("_kind") == "open").isEmpty():
            break
        # Every step of the formula is monotone in the value, also after rounding.
        share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        part = F.least(F.floor(share * SUBDIVISIONS), F.lit(SUBDIVISIONS - 1)).cast("bigint")
        level = materialize(
            inside.where(F.col("_kind") == "open").select(
                *group, "_v", "_n", F.col("_number").alias("_parent"), part.alias("_bin"),
                F.col("_before").alias("_start"), F.col("_all").alias("_total"),
            ),
            "open-bins",
        )
        base = [F.first("_start").alias("_start"), F.first("_total").alias("_total")]
    union = points[0]
    for more in points[1:]:
        union = union.unionByName(more)
    return Narrowed(union, to_sort)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    group: list[str] | None = None,
    weight: str | None = None,
    limit: int = SORT_LIMIT,
) -> DataFrame:
    """One row per group with a column per entry of ``probabilities`` (linear interpolation).

    With ``weight``, each row stands for that many equal values. Null and NaN values are left out.
    """
    names = group or []
    group = [f"_g{i}" for i in range(len(names))]
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(
        *(F.col(n).alias(g) for n, g in zip(names, group)), F.col(value).cast("double").alias("_v"), times.cast("bigint").alias("_n")
    )
    rows = materialize(rows.where(F.col("_v").isNotNull() & ~F.isnan("_v")), "values")
    found = narrow(rows, group, list(probabilities.values()), limit)
    spans = found.points.select(
        *group, F.col("_low").alias("_v"), "_total", F.col("_before").alias("_first"), (F.col("_before") + F.col("_weight")).alias("_end")
    )
    for part in found.to_sort:
        in_bin = W.partitionBy(*group, "_parent", "_bin").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
        part = part.withColumn("_end", F.sum("_n").over(in_bin) + F.col("_before"))
        spans = spans.unionByName(part.select(*group, "_v", "_total", (F.col("_end") - F.col("_n")).alias("_first"), "_end"))

    picks = []
    for i, rank in enumerate(_ranks(list(probabilities.values()))):
        inside = (F.col("_first") <= rank) & (rank < F.col("_end"))
        picks.append(F.max(F.when(inside, F.col("_v"))).alias(f"_pick{i}"))
    picked = spans.groupBy(*group).agg(*picks, F.max("_total").alias("_total"))
    out = []
    for i, (name, p) in enumerate(probabilities.items()):
        place = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.col(f"_pick{2 * i}"), F.col(f"_pick{2 * i + 1}")
        out.append((low + (high - low) * (place - F.floor(place))).alias(name))
    result = materialize(picked.select(*(F.col(g).alias(n) for g, n in zip(group, names)), *out), "quantiles")
    discard(spans)
    return result
