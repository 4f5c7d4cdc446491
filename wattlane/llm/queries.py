"""The registered queries of these operators: each reads its whole table with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm import chat, decontaminate, extract, infill, lmscore, nearest, neardup, packing, quality, shallot, token_files, toxicity, vecdup
from wattlane.llm.common import table, use_package
from wattlane.session import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048)


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_weighted_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) and whether the document is the one that stays."""
    classes = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", F.equal_null("doc_id", "class_id").alias("stays"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


ORACLES["op1_chat_repair"] = chat.oracle_sql()


@query
def op8_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigrams; one seen only where it is scored backs off. Rounded, since partial sums are added in any order."""
    scores = lmscore.backoff_scores(table(spark, sf_dir, "documents"), least_count=2, order=3)
    return scores.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames are written first, as a store of texts is; the forms are made and read from there."""
    framed = materialize(infill.frame_texts(table(spark, sf_dir, "documents")), "frames")
    return infill.stream_digests(infill.fill_in_middle(framed))


ORACLES["op12_fill_in_middle"] = infill.oracle_sql()


@query
def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.cluster_digests(*shallot.cluster_vectors(table(spark, sf_dir, "embeddings")))


ORACLES["op11_shallot_clusters"] = shallot.oracle_sql()


@query
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


ORACLES["op13_near_vectors"] = vecdup.oracle_sql()
