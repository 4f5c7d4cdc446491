"""The corpus pipeline: toxicity and quality filters, near-duplicates, decontamination, packing.

Each stage takes all documents that the one before kept and applies its own decision; all but the
last return the columns of documents. A classifier learns from the labels of the rows it is given.
Near-duplicate removal and decontamination decide by row: a row with a null or repeated doc_id stays or
goes by its own text. Of rows with equal texts removal keeps one; rows without words all stay.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm.common import crc32_text, table, use_package
from wattlane.llm.decontaminate import leaked_rows
from wattlane.llm.neardup import row_classes
from wattlane.llm.packing import pack
from wattlane.llm.quality import fit_quality, score_quality
from wattlane.llm.queries import tokenizer
from wattlane.llm.toxicity import fit_toxicity, score_toxicity
from wattlane.session import discard, materialize, settled


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def _with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a key of its own for each row, and its name.

    Rows of files have one already: the file and the place in it. Others are written with a number.
    """
    name = _unused(docs, "row_key")
    if "_metadata" not in docs.columns:
        key = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
        try:
            return docs.select("*", key.alias(name)), name
        except AnalysisException:
            pass  # not a scan of Parquet files
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "row-keys"), name


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    use_package(spark)
    learn = ~F.coalesce(crc32_text(F.col("doc_id")) % 5 == 0, F.lit(False))
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), learn)
    names = [_unused(docs, "toxicity"), _unused(docs, "offending")]
    scored = score_toxicity(docs, model, docs.columns, names=names)
    return scored.where(F.col(names[0]) < 0.5).select(*docs.columns)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.7 or more."""
    use_package(spark)
    learn = ~F.coalesce(crc32_text(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learn)
    name = _unused(docs, "quality")
    return score_quality(docs, model, docs.columns, name).where(F.col(name) >= 0.7).select(*docs.columns)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one of the least doc_id (nulls last)."""
    use_package(spark)
    keyed, key = _with_rows(docs)
    rows = keyed.select(
        F.col(key).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    stay = settled(lambda: row_classes(rows).where("row = class_row").select(F.col("row").alias(key)), spark, "stay")
    return keyed.join(stay, key, "left_semi").select(*docs.columns)


def not_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that aligns with a benchmark item."""
    use_package(spark)
    keyed, key = _with_rows(docs)
    texts = keyed.select(F.col(key).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    leaked = settled(
        lambda: leaked_rows(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(key)).distinct(), spark, "leaked"
    )
    return keyed.join(leaked, key, "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens (see ``packing.pack``)."""
    use_package(spark)
    return pack(docs, tokenizer("word_bpe_49k.json"), capacity=2048)


STAGES = [
    ("toxicity", not_toxic),
    ("quality classifier", good),
    ("MinHash near-dedup", no_near_duplicates),
    ("benchmark decontamination", not_leaked),
    ("best-fit packing", packed),
]

# Learnt models and token ids are beyond SQL; the tests compare the stages with plain versions of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name.replace(' ', '-')}")
            discard(before)
    return docs
