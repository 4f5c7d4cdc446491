import random

import numpy as np
from pyspark.sql import functions as F

from wattlane.llm.quality import STATISTICS, document_statistics, fit_trees, quality_scores
from wattlane.llm.toxicity import fit_noisy_or, fit_toxicity, occurrences_of, score_toxicity, sentences_of, toxicity_scores


def corpus(spark, n=500):
    rng = random.Random(6)
    words = ["".join(rng.choices("abdeilmnorst", k=rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choices(words, k=9)) for _ in range(rng.randint(1, 6))]
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.6)
        if toxic:
            sentences[rng.randrange(len(sentences))] += " " + rng.choice(["vileness", "grumbleton", "vilest"])
        text = ". ".join(sentences)
        rows.append((i, text if good else text.upper().replace(" ", "!! "), 3.0, "c"))
        labels.append((i, good, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, label string")
    return docs, spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


def accuracy(rows, labels, name):
    truth = {r.doc_id: r[name] for r in labels.collect() if r[name] is not None and r.doc_id is not None}
    held = [r for r in rows if r.held_out]
    assert held and all(0 <= r.score <= 1 for r in rows)
    return np.mean([r.predicted == truth[r.doc_id] for r in held])


def test_toxicity_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    assert accuracy(toxicity_scores(docs, labels).collect(), labels, "toxic") > 0.95


def test_quality_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    assert accuracy(quality_scores(docs, labels).collect(), labels, "quality") > 0.98


def test_offending_sentences_are_located(spark):
    texts = [f"fine words here number{i}. calm talk" + (" vileness again" if i % 2 else "") + "! the end" for i in range(60)]
    model = fit_noisy_or(texts, np.array([i % 2 for i in range(60)]))
    docs = spark.createDataFrame([(1, "Calm.\nSuch VILENESS again. Bye"), (2, "calm"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in score_toxicity(docs, model, ["doc_id"]).collect()}
    assert [(o.sentence, o.text) for o in got[1].offending] == [(2, "Such VILENESS again")]
    assert got[1].score > 0.5 and not got[2].offending and got[3].score == 0


def test_no_text_reaches_the_task_that_fits(spark, monkeypatch):
    docs, labels = corpus(spark, 200)
    gathered = []
    kind = type(docs)
    deal = kind.repartition
    monkeypatch.setattr(kind, "repartition", lambda df, n, *by: gathered.append(df.columns) or deal(df, n, *by))
    model = fit_toxicity(docs, labels, F.lit(True))
    assert gathered and not any("text" in columns for columns in gathered)
    rows = docs.join(labels.where("toxic is not null"), "doc_id").orderBy("doc_id").collect()
    want = fit_noisy_or([r.text for r in rows], np.array([r.toxic for r in rows]))
    assert len(want.at) and np.array_equal(model.at, want.at)
    assert np.allclose(model.value, want.value) and np.isclose(model.bias, want.bias)


def test_occurrences_of_features(texts):
    some = [t or "" for t in texts]
    s = sentences_of(some)
    used = np.unique(s.feature)[::7].astype(np.int64)
    for d, (n, places, at) in enumerate(occurrences_of(some, used)):
        own = sentences_of([some[d]])
        assert n == len(own.doc) == int((s.doc == d).sum())
        ends = np.append(own.first_word, len(own.feature))
        want = [(f, k) for k in range(n) for f in own.feature[ends[k] : ends[k + 1]].ravel().tolist() if f in set(used.tolist())]
        assert list(zip(used[places].tolist(), at.tolist())) == want


def test_noisy_or_is_that_of_the_sentences(texts):
    some = [t or "" for t in texts[:50]]
    model = fit_noisy_or(some, np.arange(50) % 2, least_docs=1, least_z=0.0)
    s = sentences_of(some)
    p = 1 / (1 + np.exp(-model.logits(s)))
    want = [1 - np.prod(1 - p[s.doc == d]) for d in range(50)]
    assert np.allclose(model.score(s), want)


def test_odd_rows_and_missing_labels(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.where("false")
    for scores in (toxicity_scores, quality_scores):
        for known in (labels, none):
            rows = scores(docs, known).collect()
            assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        assert scores(no_docs, none).count() == 0
    assert {r.score for r in toxicity_scores(docs, none).collect()} == {0.0}


def test_statistics_by_hand():
    rows = document_statistics(["Aa bb bb | 12!\nAa bb bb | 12!", "", "é"])
    got = dict(zip(STATISTICS, rows[0]))
    assert np.isclose(got["log_words"], np.log(9)) and np.isclose(got["distinct_words"], 3 / 8)
    assert np.isclose(got["repeated_next"], 2 / 8) and np.isclose(got["top_word"], 4 / 8)
    assert np.isclose(got["distinct_lines"], 1 / 2) and np.isclose(got["digits"], 4 / 29)
    assert rows[1].sum() == 0 and np.isclose(dict(zip(STATISTICS, rows[2]))["not_ascii"], 1)


def test_statistics_do_not_depend_on_the_neighbours():
    clean = "Some Capital words and others, All of Them here."
    odd = ["İstanbul Has a dotted İ", "GROẞ and Small", "İ and ẞ Together", "Kelvin is \u212a, Ünïcödé Too"]
    capitals = STATISTICS.index("capital_words")
    for other in odd:
        alone = np.concatenate([document_statistics([t]) for t in (other, clean)])
        assert np.array_equal(alone, document_statistics([other, clean]))
        assert np.array_equal(alone[::-1], document_statistics([clean, other]))
        assert alone[1, capitals] == 4 / 9
    assert document_statistics(odd)[:, capitals].tolist() == [1 / 5, 2 / 3, 1 / 4, 2 / 5]


def test_tree_walk_equals_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = fit_trees(x, y, trees=30)
    got = model.score(x)
    for row, p in zip(x[:50], got):
        total = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + (row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        assert np.isclose(p, 1 / (1 + np.exp(-total)))
    assert ((got > 0.5) == y).mean() > 0.97


def test_learning_leaves_out_the_held_out_rows(spark):
    docs, labels = corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity_scores(docs, x).collect()) for x in (labels, flipped))
    assert a == b
