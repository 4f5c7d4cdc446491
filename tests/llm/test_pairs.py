import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.llm.components import connected_components
from wattlane.llm.decontaminate import align, leaked_passages
from wattlane.llm.nearest import nearest_neighbours
from wattlane.llm.neardup import SPAN, near_duplicates

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")


def classes_by_brute_force(rows, least=0.8):
    bags = {}
    for i, text in rows:
        w = WORD.findall((text or "").lower())
        bags[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
    n = sum(bool(b) for b in bags.values())
    df = Counter(s for b in bags.values() for s in b)

    def weight(s, times):
        return (1 + np.log(times)) * (1 + min(np.log(n / df[s]), SPAN) / SPAN) / 2

    weights = {i: {s: weight(s, t) for s, t in b.items()} for i, b in bags.items()}
    parent = {i: i for i in bags}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in bags:
        for b in bags:
            if a < b and bags[a] and bags[b]:
                common = sum(min(w, weights[b][s]) for s, w in weights[a].items() if s in weights[b])
                if common / (sum(weights[a].values()) + sum(weights[b].values()) - common) >= least:
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in bags}


def test_near_duplicates_equal_brute_force(docs, texts):
    got = near_duplicates(docs).collect()
    want = classes_by_brute_force(list(enumerate(texts)))
    assert len(got) == docs.count()
    assert {r.doc_id: r.class_id for r in got} == {**want, None: None}
    assert len(set(want.values())) <= len(want) - 10


def test_near_duplicates_of_empty_and_equal_tables(spark, no_docs):
    assert near_duplicates(no_docs).count() == 0
    same = spark.range(40, 90).select(F.col("id").alias("doc_id"), F.lit("the same few words again and again").alias("text"))
    assert {r.class_id for r in near_duplicates(same).collect()} == {40}


def test_a_bucket_of_many_classes_compares_across_them(spark):
    base = [f"w{k}" for k in range(40)]
    rows = []
    for i in range(30):
        words = list(base)
        words[i] = f"x{i}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), least=0.6, bands=60, rows=3).collect()}
    assert got == classes_by_brute_force(rows, 0.6)


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300)]
    for small in (1000, 0):
        found = connected_components(spark.createDataFrame(pairs, "a long, b long"), small=small)
        got = {r.node: r.component for r in found.collect()}
        assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 300: 300, 301: 300}


def local_alignment(item, text):
    score = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            score[i, j] = max(0, score[i - 1, j - 1] + (2 if a == b else -1), score[i - 1, j] - 1, score[i, j - 1] - 1)
    return score.max()


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(3)
    items = [rng.integers(1, 5, rng.integers(1, 12)).astype(np.uint64) for _ in range(200)]
    passages = [rng.integers(1, 6, rng.integers(1, 30)).astype(np.uint64) for _ in range(200)]
    score, first, last = align(items, passages)
    for q, p, s, a, b in zip(items, passages, score, first, last):
        assert s == local_alignment(q, p)
        if s:
            assert 0 <= a < b <= len(p) and local_alignment(q, p[a:b]) == s


def test_leaks_equal_alignment_of_all_pairs(spark, docs, texts):
    pick = [t for t in texts[:40] if len(t.split()) > 15][:6]
    edited = pick[2].split()
    edited[3::7] = ["altered"] * len(edited[3::7])
    items = [(k, t.upper()) for k, t in enumerate(pick)] + [(7, None), (8, "two words"), (9, " ".join(edited)), (9, pick[1]), (None, pick[3])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = {(r.doc_id, r.item_id): r.score for r in leaked_passages(docs, bench).collect()}
    want = {}
    for d, text in [*enumerate(texts), (None, "a row without a key and enough words")]:
        words = WORD.findall((text or "").lower())
        for i, item in items:
            own = WORD.findall((item or "").lower())
            if own and words and len(words) < 1000:
                s = local_alignment(own, words) / (2 * len(own))
                # One of two words is no seed.
                if s >= 0.5 and (len(own) > 2 or s == 1):
                    want[d, i] = max(s, want.get((d, i), 0))
    assert got == want
    assert leaked_passages(docs, bench.where("false")).count() == 0 and leaked_passages(docs.where("false"), bench).count() == 0


def test_edited_copies_are_found_beside_verbatim_ones(spark):
    items = [[f"i{k}w{j}" for j in range(42)] for k in range(3)]

    def edited(words, first, step):
        return ["altered" if j % step == first else w for j, w in enumerate(words)]

    rows = [*items, edited(items[0], 6, 7), edited(items[1], 3, 7), *(edited(items[2], f, 5) for f in (0, 2, 4))]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(rows)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in leaked_passages(docs, bench).collect()}
    want = {(d, k): local_alignment(w, text) / (2 * len(w)) for d, text in enumerate(rows) for k, w in enumerate(items)}
    assert got == {pair: s for pair, s in want.items() if s >= 0.5} and len(got) == len(rows)


def neighbours_by_brute_force(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = (x * x[q]).sum(1) / np.sqrt((x * x).sum(1)) / np.sqrt((x[q] ** 2).sum())
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [int(ids[j]) for j in order]
    return out


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(30, 16))
    x = centre[rng.integers(0, 30, 2000)] + rng.normal(size=(2000, 16)) * 0.5
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest_neighbours(frame, F.col("vec_id") % 50 == 0).collect()
    want = neighbours_by_brute_force(rows, 5)
    found = defaultdict(dict)
    for r in got:
        found[r.query_id][r.rank] = r.vec_id
    assert set(found) == set(want) and all(sorted(f) == [1, 2, 3, 4, 5] for f in found.values())
    assert np.mean([len(set(f.values()) & set(want[q])) / 5 for q, f in found.items()]) >= 0.9


def test_neighbours_of_odd_and_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(0, 120)] + [(200, [0.0, 1.0, 1.0]), (250, [1.0, 1.0, 1.0])]
    odd = [(300, None), (350, [0.0, 0.0, 0.0]), (400, [float("nan"), 1.0, 1.0]), (450, [1.0, None, 1.0]), (500, [1.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "z") for i, v in rows + odd], "vec_id long, embedding array<double>, leaf string")
    got = defaultdict(list)
    for r in sorted(nearest_neighbours(frame, F.col("vec_id") % 50 == 0, leaf_rows=1).collect(), key=lambda r: r.rank):
        got[r.query_id].append(r.vec_id)
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4] and got[100] == [0, 1, 2, 3, 4]
    assert set(got) == {0, 50, 100, 200, 250}
    assert nearest_neighbours(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    few = nearest_neighbours(frame.where("vec_id >= 200"), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(200, 1, 250), (250, 1, 200)]


def test_block_similarities_equal_pairs(texts):
    from wattlane.llm.neardup import Idf, similarities

    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(30)]
    some = [t for t in texts if t] + [" ".join(rng.choice(words[:6], 60)) for _ in range(20)]
    idf = Idf(np.zeros(0, np.uint64), np.zeros(0), 1)

    def bag(t):
        w = WORD.findall(t.lower())
        return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()

    def jaccard(a, b):
        weight = [{s: 1 + np.log(c) for s, c in x.items()} for x in (a, b)]
        common = sum(min(v, weight[1][s]) for s, v in weight[0].items() if s in weight[1])
        joint = sum(weight[0].values()) + sum(weight[1].values()) - common
        return common / joint if joint else 0.0

    bags = [bag(t) for t in some]
    want = np.array([[jaccard(a, b) for b in bags] for a in bags])
    np.testing.assert_allclose(similarities(some, None, idf, 0.8), want, atol=1e-12)
    np.testing.assert_allclose(similarities(some[:9], some[9:], idf, 0.8), want[:9, 9:], atol=1e-12)


def test_chains_of_near_copies_at_the_limit_are_joined(spark, monkeypatch):
    from wattlane.llm import neardup

    # Groups whose similarities lie on both sides of 0.8, in blocks of a few texts.
    rng = np.random.default_rng(7)
    rows = []
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(150)]
        for i in range(25):
            words = list(base)
            for at in rng.choice(150, rng.integers(1, 6), replace=False):
                words[at] = f"x{g}_{i}_{at}"
            rows.append((len(rows), " ".join(words)))
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 7)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = classes_by_brute_force(rows)
    got = {r.doc_id: r.class_id for r in near_duplicates(frame, bands=60, rows=3).collect()}
    assert got == want and 6 < len(set(want.values())) < 150
    default = {r.doc_id: r.class_id for r in near_duplicates(frame).collect()}
    assert sum(default[i] == c for i, c in want.items()) >= 0.98 * len(rows)


def test_neighbours_of_huge_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e200]), (50, [1e-200, 1e-200]), (3, [1.0, 1.0]), (4, [1.0, -1.0]), (5, [5e-324, 0.0]), (6, [1.7e308, 1.7e308])]
    found = defaultdict(list)
    for r in sorted(nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect(), key=lambda r: r.rank):
        found[r.query_id].append((r.vec_id, r.score))
    for q, others in found.items():
        assert sorted(i for i, _ in others[:3]) == [i for i in (0, 3, 6, 50) if i != q] and [i for i, _ in others[3:]] == [5, 4]
        assert [s for _, s in others][:3] == [pytest.approx(1.0, abs=1e-15)] * 3 and others[3][1] == pytest.approx(0.5**0.5) and others[4][1] == 0
    assert set(found) == {0, 50}
