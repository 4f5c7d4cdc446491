"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

1. One pass over the documents finds where n-grams of the benchmark occur. The n-grams are known there by a
   bit table of a fixed size, so the pass costs the same for any benchmark; what the table lets
   through is joined with the n-grams themselves. Hits come out in passages: pieces of at most
   ``PASSAGE`` words around them, which overlap by twice the longest item.
2. Every n-gram of an item is a seed, however frequent its words. So an unchanged run of n words is always
   found, whatever other copies of the item there are.
3. A passage and an item that share a seed are aligned as whole word sequences (match 2, other word -1, gap
   -1). The score is the best local alignment over that of the item with itself.

A pair counts as leaked from a score of ``least`` on. Copies that were edited or reworded keep the
score of what they kept.

Items without words and documents without words (null, empty) match nothing. Items of fewer
than n words are seeds as a whole. Null doc_id: compared, reported as null. Repeated rows or doc_ids: one
result for each (doc_id, item_id), the best. Repeated item_ids: the best of their texts. Empty
tables: no rows. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, documents_of, slices, texts_of
from wattlane.llm.words import Words
from wattlane.session import materialize

TABLE_BITS = 22
PASSAGE = 4096
MATCH, OTHER, GAP = 2, -1, -1
ITEM_SCHEMA = "item_id long, item_key binary, length int, words binary, grams array<long>"


def benchmark_items(benchmark: DataFrame, n: int) -> DataFrame:
    """Items with their word hashes and the hashes of their n-grams (of all words if fewer than n)."""
    import hashlib

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = texts_of(batch), column_of(batch, "item_id")
            for a, b in slices(texts):
                words = Words(texts[a:b])
                grams, doc, _ = words.grams(n, short=True)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                spans = [words.hash[words.first[d] : words.first[d + 1]].tobytes() for d in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array([hashlib.md5(s).digest() for s in spans], pa.binary()),
                        pa.array(np.diff(words.first), pa.int32()),
                        pa.array(spans, pa.binary()),
                        pa.array([grams[x:y].view(np.int64) for x, y in zip(cut[:-1], cut[1:])], pa.list_(pa.int64())),
                    ],
                    ["item_id", "item_key", "length", "words", "grams"],
                )

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return items.mapInArrow(read, ITEM_SCHEMA).where("length > 0")


def _passages(docs: DataFrame, bits: np.ndarray, n: int, short: list[int], reach: int) -> DataFrame:
    """Pieces of documents around possible n-grams of the benchmark, each with its hits."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"passage long, doc_id {kind}, start int, words binary, at array<int>, grams array<long>"
    stride = max(PASSAGE, 4 * reach) - 2 * reach

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            texts, ids = texts_of(batch), column_of(batch, "doc_id").to_pylist()
            for a, b in slices(texts):
                words = Words(texts[a:b])
                rows = []
                found, docs_of, places = [], [], []
                for size in [n, *short]:
                    grams, doc, at = words.grams(size)
                    hit = np.flatnonzero(bits[(grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
                    found.append(grams[hit])
                    docs_of.append(doc[hit])
                    places.append(at[hit])
                grams, doc, at = map(np.concatenate, (found, docs_of, places))
                order = np.lexsort((at, doc))
                grams, doc, at = grams[order], doc[order], at[order]
                at -= words.first[doc]
                piece = at // stride
                edge = np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(piece, prepend=-1))
                for x, y in zip(edge.tolist(), [*edge[1:].tolist(), len(doc)]):
                    first, last = int(words.first[doc[x]]), int(words.first[doc[x] + 1])
                    low = max(0, int(at[x]) - reach)
                    high = min(last - first, int(at[y - 1]) + n + reach)
                    kept = words.hash[first + low : first + high].tobytes()
                    rows.append((number, ids[a + int(doc[x])], low, kept, (at[x:y] - low).tolist(), grams[x:y].view(np.int64).tolist()))
                    number += 1
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.int64(), column_of(batch, "doc_id").type, pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["passage", "doc_id", "start", "words", "at", "grams"]
                    )

    return docs.mapInArrow(find, schema)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each item with its passage: score, first and one past the last passage word.

    All pairs run together, a row of the score table at a time. A cell holds the score in its upper
    half and, below it, how early the alignment starts, so ties go to the earlier start.
    """
    n_pairs, width, height = len(items), max(map(len, passages)), max(map(len, items))
    text = np.zeros((n_pairs, width), dtype=np.uint64)
    real = np.zeros((n_pairs, width), dtype=bool)
    query = np.zeros((n_pairs, height), dtype=np.uint64)
    for i, (p, q) in enumerate(zip(passages, items)):
        text[i, : len(p)], real[i, : len(p)], query[i, : len(q)] = p, True, q
    length = np.array([len(q) for q in items])
    unit = np.int64(1) << 32
    column = np.arange(width, dtype=np.int64)
    fresh = unit - 1 - column
    slope = -GAP * unit * column
    above = np.broadcast_to(unit - 1 - np.arange(width + 1, dtype=np.int64), (n_pairs, width + 1)).copy()
    best = np.zeros(n_pairs, dtype=np.int64)
    end = np.zeros(n_pairs, dtype=np.int64)
    for i in range(height):
        same = (text == query[:, i : i + 1]) & real
        cell = np.maximum(above[:, :-1] + np.where(same, MATCH * unit, OTHER * unit), above[:, 1:] + GAP * unit)
        cell = np.maximum(cell, fresh - 1)
        cell = np.maximum.accumulate(cell + slope, axis=1) - slope
        cell[~real] = 0
        above = np.concatenate([np.full((n_pairs, 1), unit - 1), np.maximum(cell, fresh - 1)], axis=1)
        cell[length <= i] = 0
        top = cell.argmax(axis=1)
        value = cell[np.arange(n_pairs), top]
        better = (value >> np.int64(32)) > (best >> np.int64(32))
        best = np.where(better, value, best)
        end = np.where(better, top + 1, end)
    return best >> np.int64(32), unit - 1 - (best & (unit - 1)), end


def leaked_passages(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, n: int = 4) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of every leaked pair of document and item.

    Words are counted from 0 in the document; ``last_word`` is one past the end.
    """
    return leaked_rows(documents_of(docs), benchmark, least, n)


def leaked_rows(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, n: int = 4) -> DataFrame:
    """``leaked_passages`` of (doc_id, text) where doc_id is a key of any orderable kind and text is not null."""
    items = materialize(benchmark_items(benchmark, n), "items")
    seeds = items.select("item_id", "item_key", F.explode("grams").alias("gram")).distinct()
    table_at = F.shiftrightunsigned("gram", 64 - TABLE_BITS).cast("int")
    buckets = seeds.select(table_at.alias("b")).distinct().toPandas()["b"].to_numpy(np.int64)
    bits = np.zeros(1 << TABLE_BITS, dtype=bool)
    bits[buckets] = True
    reach = int(items.agg(F.max("length")).first()[0] or 0)
    short = sorted(r[0] for r in items.where(F.col("length") < n).select("length").distinct().collect())
    packed = np.packbits(bits)

    passages = materialize(_passages(docs, np.unpackbits(packed).astype(bool), n, short, reach), "passages")
    met = (
        passages.select("passage", F.explode(F.array_distinct("grams")).alias("gram"))
        .join(seeds, "gram")
        .select("passage", "item_id", "item_key")
        .distinct()
    )
    pairs = met.join(passages.select("passage", "doc_id", "start", "words"), "passage").join(
        items.select(F.col("item_id").alias("item"), F.col("item_key").alias("item_text"), F.col("words").alias("item_words")).distinct(),
        F.col("item_id").eqNullSafe(F.col("item")) & (F.col("item_key") == F.col("item_text")),
    )

    kind = docs.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(w, np.uint64) for w in column_of(batch, "item_words").to_pylist()]
            text = [np.frombuffer(w, np.uint64) for w in column_of(batch, "words").to_pylist()]
            score, first, last = (np.zeros(len(own), np.int64) for _ in range(3))
            order = sorted(range(len(own)), key=lambda i: (len(text[i]), len(own[i])))
            at = 0
            while at < len(order):
                stop = at + 1
                while stop < len(order) and (stop + 1 - at) * len(text[order[stop]]) <= 1 << 18:
                    stop += 1
                part = order[at:stop]
                score[part], first[part], last[part] = align([own[i] for i in part], [text[i] for i in part])
                at = stop
            start = column_of(batch, "start").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    column_of(batch, "item_id"),
                    pa.array(score / np.array([MATCH * len(w) for w in own])),
                    pa.array(first + start),
                    pa.array(last + start),
                ],
                ["doc_id", "item_id", "score", "first_word", "last_word"],
            )

    scored = pairs.select("doc_id", "item_id", "start", "words", "item_words").mapInArrow(
        measure, f"doc_id {kind}, item_id long, score double, first_word long, last_word long"
    )
    best = F.max_by(F.struct("score", "first_word", "last_word"), F.struct(F.col("score"), -F.col("first_word"), -F.col("last_word")))
    return (
        scored.where(F.col("score") >= least)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.score", "best.first_word", "best.last_word")
    )
