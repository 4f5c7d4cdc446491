"""Reproducible samples: a row's draw is the md5 of a seed and its key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattlane.functions.columns import hex_number, row_hash
from wattlane.schema import KEYS

HEAP_ROWS = 100_000  # the largest sample that a task holds in memory
_DIGITS = 4  # leading hex digits that name a bucket: 65 536 buckets


def sample_n(
    df: DataFrame, n: int | None, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows if there are no more than ``n``.

    These are the n rows of least hash. Up to ``HEAP_ROWS`` of them come from one pass: every task keeps
    a heap of its n least rows, whose greatest hash is the bar for what follows, and the heaps are
    merged. Larger samples are found without a global sort: counts per hash bucket
    give the bucket in which the n-th row falls, and only rows up to that bucket are
    shuffled, each bucket being sorted on its own.
    """
    if n is None:
        return df
    columns = df.columns
    if n <= HEAP_ROWS:
        order = [row_hash(seed, keys or KEYS), *(F.col(k) for k in keys or KEYS)]
        return df.orderBy(*order).limit(n)
    tagged = df.withColumn("_hash", row_hash(seed, keys or KEYS)).withColumn(
        "_bucket", hex_number(F.col("_hash"), _DIGITS)
    )
    upto = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = (
        tagged.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .where(F.col("_upto") >= n)
        .agg(F.min(F.struct("_bucket", (F.lit(n) - F.col("_upto") + F.col("_n")).alias("room"))))
        .scalar()
    )
    kept = tagged.where(edge.isNull() | (F.col("_bucket") <= edge["_bucket"]))
    place = F.row_number().over(W.partitionBy("_bucket").orderBy("_hash", *(keys or KEYS)))
    return (
        kept.withColumn("_place", place)
        .where(
            edge.isNull() | (F.col("_bucket") < edge["_bucket"]) | (F.col("_place") <= edge["room"])
        )
        .select(*columns)
    )


def in_fraction(fraction: float, seed: int, keys: list[str] | None = None):
    return hex_number(row_hash(seed, keys or KEYS), 8) < int(fraction * 2**32)


def sample_fraction(
    df: DataFrame, fraction: float, seed: int = 0, keys: list[str] | None = None
) -> DataFrame:
    """Each row with the given probability."""
    return df.where(in_fraction(fraction, seed, keys))


def random_split(
    df: DataFrame, test_size: float, seed: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """Add ``part`` = train or test by the row's draw; features and target stay together."""
    return df.withColumn(
        "part", F.when(in_fraction(test_size, seed, keys), "test").otherwise("train")
    )
