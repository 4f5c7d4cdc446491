"""The pipeline's stages against plain decisions on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from wattlane.llm.decontaminate import leaked_passages
from wattlane.llm.neardup import near_duplicates
from wattlane.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")
def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        after = stage(spark, docs, SF)
        assert after.columns == columns
        kept = {r.doc_id for r in after.collect()}
        assert kept <= before
        gone = before - kept
        if name == "MinHash near-dedup":
            assert gone == {r.doc_id for r in near_duplicates(docs).where("doc_id != class_id").collect()}
        elif name == "benchmark decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert gone == {r.doc_id for r in leaked_passages(docs, bench).collect()}
        elif name == "quality classifier":
            good = [i for i in before if i in labels and labels[i].quality == 1]
            assert len(kept.intersection(good)) >= 0.9 * len(good)
        docs = spark.createDataFrame(after.collect(), after.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_stages_stand_odd_rows(spark, docs, no_docs):
    for frame in (docs, no_docs):
        now = frame
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
            now.collect()


def test_null_and_repeated_ids_are_decided_by_row(spark, tmp_path):
    def text(k):
        return " ".join(f"t{k}w{j}" for j in range(40))

    spark.createDataFrame([(1, text(0))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    leaked = [(None, text(0)), (7, text(0))]
    clean = [(None, text(1)), (None, text(2)), (7, text(3)), (7, text(4))]
    docs = spark.createDataFrame(leaked + clean, "doc_id long, text string")
    got = corpus_pipeline.not_leaked(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, clean))

    once = [(None, text(1)), (5, text(2)), (5, text(3)), (6, text(4)), (8, text(5)), (9, text(6))]
    again = [(None, text(1)), (9, text(2)), (None, text(3)), (6, text(4)), (9, text(5))]
    docs = spark.createDataFrame(once + again, "doc_id long, text string")
    got = corpus_pipeline.no_near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, once))
    changed = text(3).replace("t3w39", "other")
    docs = spark.createDataFrame([(5, text(2)), (5, text(3)), (6, changed)], "doc_id long, text string")
    classes = near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.class_id) for r in classes) == [(5, 5), (5, 5), (6, 5)]


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
