"""Language-model scores of documents by stupid backoff over the corpus's own n-grams.

The score of a word after the ``order`` - 1 words before it is the count of all of them over that of the words before,
if the n-gram is seen at least ``least_count`` times in all documents, else ``backoff`` times the score
after one word fewer, down to c(w) / N. Words at a document's start are scored after what there is.
Counts are exact and cover all documents.

The count table is partitioned by ranges of the n-grams' hashes; a slice of documents asks it once:

1. A slice counts its distinct n-grams of all orders and sends each partition those of its range, in ascending order:
   the steps between hashes and the counts, as planes of bytes. So an n-gram is sent once by a slice however often it
   occurs, a partition gets a hot one from every slice at most once, and no word, place or document goes along.
   The words of the slice's texts go to one of the partitions, its home.
2. A partition adds up what the slices sent and answers each with the counts of all, in the order asked. The first one
   gets a row from all slices and adds the number of all words.
3. The answers go to the homes. What the homes got in the first step is read there once more, not shuffled again; the list
   of n-grams is made anew from the texts, the answers are put beside it, and every word is scored: each order where it
   is seen often enough, else the one below.

Null or empty text or none but marks: 0 words and null scores. Null doc_id and repeated rows: one row each.
Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, documents_of, texts_of
from wattlane.llm.words import Words, is_word, mix

PART_WORDS = 1_500_000
WORD_CHARS = 6
SLICE = 1 << 23
END = np.uint64(0)
_GRAM = np.uint64(0x9FB21C651E98DF25)


def pair_hash(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    return mix(w1 * _GRAM + w2)


def _grams_of(words: Words, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the words that an n-gram inside their document ends at, and the hashes of these n-grams."""
    place = np.arange(len(words.hash)) - words.first[:-1][words.doc]
    gram = mix(words.hash)
    for k in range(order):
        if k:
            gram = pair_hash(np.concatenate([[END], gram])[: len(gram)], words.hash)
        at = np.flatnonzero(place >= k)
        yield at, gram[at]


def _numbered(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams in ascending order, and the number of each of ``gram`` among them."""
    order = np.argsort(gram, kind="stable")
    ascending = gram[order]
    new = np.diff(ascending, prepend=~ascending[:1]) != 0
    number = np.empty(len(gram), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ascending[new], number


def _packed(x: np.ndarray) -> bytes:
    """Non-negative numbers as planes of their bytes, lowest first and as many as the largest needs, compressed."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(cell: pa.Scalar) -> np.ndarray:
    raw = cell.as_py()
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel()


def _texts_cell(ids: list[int | None], words: Words) -> bytes:
    """The keys and, as one text for each, the words with a space after each."""
    inside = is_word(words.bytes)
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    data = np.where(inside, words.bytes, np.uint8(32))[keep]
    offsets = np.concatenate([[0], np.cumsum(keep)])[words.text_start].astype("<i8")
    texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), texts], ["doc_id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Keys and texts of bounded total length (a longer document is a slice of its own), across batches."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(column_of(batch, "doc_id").to_pylist(), texts_of(batch)):
            if texts and size + len(text) > SLICE:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text) + 8
    if texts:
        yield ids, texts


ASKED = "part int, home int, slice long, words long, grams binary, counts binary, texts binary"
ANSWERED = "home int, slice long, part int, words long, counts binary"
SCORED = {"doc_id": pa.int64(), "n_words": pa.int64(), "log_score": pa.float64(), "mean_log_score": pa.float64()}


def backoff_scores(documents: DataFrame, backoff: float = 0.4, least_count: int = 2, order: int = 2) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logs) and mean_log_score of every document."""
    docs = documents_of(documents)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // (WORD_CHARS * PART_WORDS)))
    bounds = np.array([(k << 64) // parts for k in range(1, parts)], dtype=np.uint64)
    least, log_backoff = max(least_count, 1), np.log(backoff)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        names = ["part", "home", "slice", "words", "grams", "counts", "texts"]
        for i, (ids, texts) in enumerate(_slices(batches)):
            words = Words(texts)
            home, name, n_words = (task + i) % parts, task << 32 | i, len(words.hash)
            ascending = np.sort(np.concatenate([gram for _, gram in _grams_of(words, order)]))
            at = np.flatnonzero(np.diff(ascending, prepend=~ascending[:1]) != 0)
            gram, n = ascending[at], np.diff(np.append(at, len(ascending)))
            del ascending, at
            cut, rows = [0, *np.searchsorted(gram, bounds).tolist(), len(gram)], []
            for part, (x, y) in enumerate(zip(cut, cut[1:])):
                if x < y or part in (0, home):
                    steps = np.diff(gram[x:y], prepend=np.uint64(0))
                    rows.append((part, home, name, n_words, _packed(steps), _packed(n[x:y]), _texts_cell(ids, words) if part == home else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def answer(key, table):
        gram = [np.cumsum(_unpacked(cell), dtype=np.uint64) for cell in table.column("grams")]
        cut = np.cumsum([len(g) for g in gram])[:-1]
        distinct, number = _numbered(np.concatenate(gram))
        del gram
        n = np.concatenate([_unpacked(cell) for cell in table.column("counts")])
        total = np.bincount(number, n, minlength=len(distinct)).astype(np.uint64)
        counts = pa.array([_packed(x) for x in np.split(total[number], cut)], pa.binary())
        n_words = pa.array([sum(table.column("words").to_pylist())] * len(table), pa.int64())
        return table.select(["home", "slice", "part"]).append_column("words", n_words).append_column("counts", counts)

    def scores(given: pa.Table, answers: pa.Table) -> pa.Table:
        log_n = np.log(max(answers.column("words")[0].as_py(), 1))
        total = np.concatenate([_unpacked(cell) for cell in answers.column("counts")]).astype(np.int64)
        words = Words([raw.decode("utf-8", "surrogatepass") for raw in given.column("text").to_pylist()])
        lists = [(at, *_numbered(gram)) for at, gram in _grams_of(words, order)]
        every = np.unique(np.concatenate([distinct for _, distinct, _ in lists]))
        value, before = np.zeros(len(words.hash)), None
        for at, distinct, number in lists:
            n = np.zeros(len(value), dtype=np.int64)
            n[at] = total[np.searchsorted(every, distinct)][number]
            if before is None:
                value = np.log(n) - log_n
            else:
                # The n-gram of the words before is the one of the order below that ends a word earlier.
                value[at] += log_backoff
                at = at[n[at] >= least]
                value[at] = np.log(n[at]) - np.log(before[at - 1])
            before = n
        count = np.diff(words.first)
        sums = np.bincount(words.doc, value, minlength=len(count))
        empty = count == 0
        columns = [given.column("doc_id"), pa.array(count, pa.int64())]
        columns += [pa.array(x, pa.float64(), mask=empty) for x in (sums, sums / np.maximum(count, 1))]
        return pa.table(columns, schema=pa.schema(SCORED))

    def score(key, answers, asked):
        done = [pa.schema(SCORED).empty_table()]
        answers = answers.sort_by("part")
        texts = asked.filter(asked.column("texts").is_valid())
        for name, cell in zip(texts.column("slice"), texts.column("texts")):
            own = answers.filter(pa.compute.equal(answers.column("slice"), name))
            done.append(scores(pa.ipc.open_stream(cell.as_buffer()).read_all(), own))
        return pa.concat_tables(done)

    asked = docs.mapInArrow(ask, ASKED)
    answers = asked.groupBy("part").applyInArrow(answer, ANSWERED)
    # Both uses of ``asked`` are the same exchange by part, so it is made and written once.
    return answers.groupBy("home").cogroup(asked.groupBy("part")).applyInArrow(
        score, "doc_id long, n_words long, log_score double, mean_log_score double"
    )
