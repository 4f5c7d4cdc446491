"""Correlations of a series with itself at many lags, from blocks of positions.

A block holds ``BLOCK`` positions (at least the longest lag) and gets those before it that its lags reach, so
a position travels twice at most, whatever the number of lags. Inside a block the sums over pairs of
every lag come from products of Fourier transforms; blocks add up lag by lag.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 16384
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def lag_correlations(series: DataFrame, lags: list[int], pos: str = "pos", value: str = "value") -> DataFrame:
    """(lag, autocorrelation) of each lag that has pairs; positions without a value have none.

    Null below two pairs, NaN where one side is constant.
    """
    x = F.col(value).cast("double")
    points = series.select(F.col(pos).cast("bigint").alias("pos"), x.alias("x")).where(F.col("x").isNotNull())
    # Any shift leaves the correlation as it is; this one keeps the products small, and a constant exactly 0.
    shift = F.when(F.min("x") == F.max("x"), F.min("x")).otherwise(F.avg("x"))
    points = points.withColumn("x", F.col("x") - F.coalesce(points.agg(shift).scalar(), F.lit(0.0)))
    wanted = np.unique(np.asarray(lags, dtype=np.int64))
    longest = int(wanted.max(initial=0))
    size = max(BLOCK, longest)
    width = 1 << int(2 * size + longest).bit_length()

    def products(key, table):
        at = table.column("pos").to_numpy() - (key[0].as_py() * size - longest)
        past, there = np.zeros(size + longest), np.zeros(size + longest)
        past[at], there[at] = table.column("x").to_numpy(), 1.0
        now, here = past.copy(), there.copy()
        now[:longest] = here[:longest] = 0.0
        later = [np.fft.rfft(v, width) for v in (here, now, now * now)]
        before = [np.conj(np.fft.rfft(v, width)) for v in (there, past, past * past)]

        def sums(i: int, j: int) -> np.ndarray:
            return np.fft.irfft(later[i] * before[j], width)[wanted]

        n = np.rint(sums(0, 0))
        some = n > 0
        # Without a pair there is nothing but rounding.
        columns = [n, *(np.where(some, sums(i, j), 0.0) for i, j in ((1, 0), (0, 1), (2, 0), (0, 2), (1, 1)))]
        return pa.table({"lag": pa.array(wanted), **{name: pa.array(c) for name, c in zip(_SUMS, columns)}})

    first, last = F.floor(F.col("pos") / size), F.floor((F.col("pos") + longest) / size)
    blocks = points.withColumn("block", F.explode(F.sequence(first, last)))
    found = blocks.groupBy("block").applyInArrow(products, "lag bigint, " + ", ".join(f"{c} double" for c in _SUMS))
    total = found.groupBy("lag").agg(*(F.sum(c).alias(c) for c in _SUMS)).where(F.col("n") > 0)
    n = F.col("n")
    top = F.col("sxy") - F.col("sx") * F.col("sy") / n
    sides = (F.col("sxx") - F.col("sx") * F.col("sx") / n) * (F.col("syy") - F.col("sy") * F.col("sy") / n)
    return total.select("lag", F.when(n > 1, F.when(sides > 0, top / F.sqrt(sides)).otherwise(float("nan"))).alias("autocorrelation"))
