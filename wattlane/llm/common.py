"""Helpers shared by the operators: table access, label joins and bounded samples."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def use_package(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where the driver has it.

    On a cluster the package is installed or sent along (``--py-files``); an absent folder does no harm.
    Texts vary in length, so batches sent to Python are kept small unless the session says otherwise.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, 1000)
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, path]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the key and the text (null: empty), whatever other columns there are."""
    return df.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def crc32_text(column):
    """Unsigned crc32 of a key written as text."""
    return F.crc32(column.cast("string").cast("binary"))


def label_table(labels: DataFrame, name: str) -> DataFrame:
    """One row per doc_id with a 0/1 label; rows without key or label are left out.

    Where a document has several labels, the mean decides and a tie counts as 1.
    """
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).cast("double").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull())
        .groupBy("doc_id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, name: str, train_rule, per_class: int) -> DataFrame:
    """(doc_id, text, label) of about ``per_class`` labelled documents of each class at most.

    The rows with the lowest hashes of their key are kept, so the sample does not depend on the
    partitioning. The chosen keys are bounded by the parameter and go to all tasks; no text is shuffled.
    """
    chosen = label_table(labels, name).where(train_rule)
    counts = {int(r["label"]): int(r["n"]) for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    span = float(1 << 53)
    draw = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(17)), 11)
    keep = F.lit(False)
    for label, n in counts.items():
        share = min(1.0, per_class / max(n, 1))
        keep = keep | ((F.col("label") == label) & (draw < F.lit(share * span)))
    return docs.join(F.broadcast(chosen.where(keep)), "doc_id").select("doc_id", "text", "label")


def slices(texts: Sequence[str], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of bounded total length (a longer document is a range of its own)."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def crc_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
