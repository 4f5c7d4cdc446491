"""Toxicity by multiple-instance learning.

A document is a bag of sentences (pieces between . ! ? and line ends). A sentence's probability
is a logistic score of its words and word beginnings, hashed into ``1 << BITS`` weights; the
document's is the noisy-or of its sentences. Only document labels are used for the fit, and the
sentences that raise a document's score come out of it.

The fit uses a bounded sample of labelled documents (``per_class`` of each class at most). Its words are
counted and looked up in the tasks that read them; one task gets the occurrences of the chosen features and
makes the steps. The model is an array of a fixed size. Scores cover whole texts.

Null or empty text: no sentence, score 0. Null doc_id: scored, not held out. Without labels or
with one class only, every score is 0. Repeated rows: each is scored. Extra columns: ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, crc32_text, documents_of, labelled_sample, slices, texts_of
from wattlane.llm.words import Words

BITS = 22
BEGINNINGS = (4, 5, 6)
_END = np.zeros(256, dtype=bool)
_END[list(b".!?\n")] = True
_SENTENCE_END = re.compile(r"[.!?\n]")


@dataclass
class Sentences:
    """Words of some texts with their features, and the sentence and document each is in."""

    feature: np.ndarray  # (words, 1 + beginnings)
    first_word: np.ndarray  # of each sentence
    number: np.ndarray  # which sentence of its text, counting those without words
    doc: np.ndarray  # of each sentence
    n_docs: int

    def doc_of_words(self) -> np.ndarray:
        return np.repeat(self.doc, np.diff(np.append(self.first_word, len(self.feature))))


def sentences_of(texts: Sequence[str]) -> Sentences:
    words = Words(texts, BEGINNINGS)
    shift = np.uint64(64 - BITS)
    feature = np.column_stack([words.hash >> shift, *(words.prefix[k] >> shift for k in BEGINNINGS)]).astype(np.int32)
    ends = np.cumsum(_END[words.bytes])
    sentence = ends[words.start]  # a word's first byte is no end
    first_word = np.flatnonzero(np.diff(sentence, prepend=-1))
    doc = words.doc[first_word]
    before = np.concatenate([[0], ends])[words.text_start[doc]]
    return Sentences(feature, first_word, sentence[first_word] - before, doc, len(texts))


class NoisyOr:
    """A logistic sentence model whose document score is the noisy-or of its sentences.

    ``at`` and ``value`` hold the weights that are not zero.
    """

    def __init__(self, at: np.ndarray, value: np.ndarray, bias: float) -> None:
        self.at, self.value, self.bias = at, value, bias
        self.dense: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "dense": None}

    def logits(self, s: Sentences) -> np.ndarray:
        if self.dense is None:
            self.dense = np.zeros(1 << BITS, dtype=np.float32)
            self.dense[self.at] = self.value
        return sentence_logits(self.dense, self.bias, s.feature, s.first_word)

    def score(self, s: Sentences) -> np.ndarray:
        if not len(s.doc):
            return np.zeros(s.n_docs)
        return 1 - np.exp(np.bincount(s.doc, -np.logaddexp(0, self.logits(s)), minlength=s.n_docs))


def sentence_logits(weight: np.ndarray, bias: float, feature: np.ndarray, first_word: np.ndarray) -> np.ndarray:
    if not len(first_word):
        return np.zeros(0)
    per_word = weight[feature].sum(1, dtype=np.float64)
    return np.clip(bias + np.add.reduceat(per_word, first_word), -800, 30)


NO_MODEL = NoisyOr(np.zeros(0, np.int64), np.zeros(0), -800.0)


def feature_documents(texts: Sequence[str], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the texts, and in how many texts of label 0 and of label 1 each occurs."""
    found = [(np.zeros(0, np.int64), np.zeros((0, 2), np.int64))]
    for a, b in slices(texts):
        s = sentences_of(texts[a:b])
        pairs = np.unique(s.feature.astype(np.int64) + (s.doc_of_words()[:, None].astype(np.int64) << BITS))
        feature, at = np.unique(pairs & ((1 << BITS) - 1), return_inverse=True)
        label = y[a + (pairs >> BITS)]
        found.append((feature, np.column_stack([np.bincount(at, label == k, len(feature)).astype(np.int64) for k in (0, 1)])))
    feature, at = np.unique(np.concatenate([f for f, _ in found]), return_inverse=True)
    counts = np.zeros((len(feature), 2), dtype=np.int64)
    np.add.at(counts, at, np.concatenate([c for _, c in found]))
    return feature, counts


def occurrences_of(texts: Sequence[str], used: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each text the number of its sentences, and the places in ``used`` (ascending) of its features with their sentences."""
    for a, b in slices(texts):
        s = sentences_of(texts[a:b])
        place = np.minimum(np.searchsorted(used, s.feature), max(len(used) - 1, 0))
        row, column = np.nonzero(used[place] == s.feature) if len(used) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        sentence = np.searchsorted(s.first_word, row, side="right") - 1
        first = np.searchsorted(s.doc, np.arange(s.n_docs + 1))
        cut = np.searchsorted(sentence, first)
        for d in range(s.n_docs):
            x, z = cut[d], cut[d + 1]
            yield int(first[d + 1] - first[d]), place[row[x:z], column[x:z]], sentence[x:z] - first[d]


def fit_noisy_or(texts: Sequence[str], y: np.ndarray, least_docs: int = 5, least_z: float = 4.0, **options) -> NoisyOr:
    """``fit_occurrences`` of texts with labels.

    Features are those that occur in ``least_docs`` documents of the sample and, by ``least_z`` standard
    deviations, more often in those labelled 1 than chance has it.
    """
    if len(np.unique(y)) < 2:
        return NO_MODEL
    feature, counts = feature_documents(texts, y)
    docs_with, share = counts.sum(1), float(y.mean())
    z = (counts[:, 1] - docs_with * share) / np.sqrt(np.maximum(docs_with, 1) * share * (1 - share))
    kept = (docs_with >= least_docs) & (z >= least_z)
    return fit_occurrences(feature[kept], docs_with[kept], list(occurrences_of(texts, feature[kept])), y, **options)


def fit_occurrences(
    used: np.ndarray,
    seen: np.ndarray,
    found: Sequence[tuple[int, np.ndarray, np.ndarray]],
    y: np.ndarray,
    rounds: int = 500,
    l2: float = 0.5,
    rate: float = 0.15,
) -> NoisyOr:
    """Scaled gradient steps on the log loss of the document labels.

    ``seen`` has the documents that hold each feature of ``used``, ``found`` what ``occurrences_of`` gives of each document.
    A weight's step is divided by its documents plus ``l2``, so that rare and frequent features are learnt at the same pace.
    """
    if len(np.unique(y)) < 2:
        return NO_MODEL
    # Sentences without a feature are alike, so each document has a number of them.
    size = np.array([n for n, _, _ in found])
    base = np.cumsum(size) - size
    feature = np.concatenate([places for _, places, _ in found])
    sentence, at = np.unique(np.concatenate([at + b for (_, _, at), b in zip(found, base)]), return_inverse=True)
    doc = np.searchsorted(base, sentence, side="right") - 1
    plain = size - np.bincount(doc, minlength=len(y))
    weight, bias, pace = np.zeros(len(used)), -4.0, np.zeros(len(used))
    for _ in range(rounds):
        low = np.clip(bias, -30, 30)
        z = np.clip(bias + np.bincount(at, weight[feature], minlength=len(doc)), -30, 30)
        log_clean = np.bincount(doc, -np.logaddexp(0, z), minlength=len(y)) - plain * np.logaddexp(0, low)
        odds = np.where(y == 1, -np.exp(log_clean) / np.maximum(-np.expm1(log_clean), 1e-9), 1.0)
        chance, rest = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-low))
        dz = odds[doc] * chance
        grad = np.bincount(feature, dz[at], minlength=len(used)) + l2 * weight
        pace = 0.7 * pace - rate * grad / (0.25 * seen + l2)
        weight += pace
        slope = float(dz.sum()) + rest * float((plain * odds).sum())
        bias -= rate * slope / (float((chance * (1 - chance)).sum()) + rest * (1 - rest) * float(plain.sum()) + l2)
    return NoisyOr(used, weight.astype(np.float32), bias)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train_rule: Column, per_class: int = 4_000, least_docs: int = 5, least_z: float = 4.0, **options
) -> NoisyOr:
    """The model of a bounded sample of labelled documents for which ``train_rule`` holds.

    Features are counted and looked up where the documents are; the task that fits gets their occurrences, no text.
    """
    sample = labelled_sample(documents_of(docs), labels, "toxic", train_rule, per_class)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return NO_MODEL
    share = sizes[1] / (sizes[0] + sizes[1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, y = texts_of(batch), column_of(batch, "label").to_numpy()
            for a, b in slices(texts):
                feature, counts = feature_documents(texts[a:b], y[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(feature.astype(np.int32)), *(pa.array(c) for c in counts.T)], ["at", "n0", "n1"])

    counted = sample.mapInArrow(count, "at int, n0 long, n1 long").groupBy("at")
    counted = counted.agg((F.sum("n0") + F.sum("n1")).alias("docs"), F.sum("n1").alias("n1"))
    z = (F.col("n1") - F.col("docs") * F.lit(share)) / F.sqrt(F.col("docs") * F.lit(share) * F.lit(1 - share))
    kept = counted.where((F.col("docs") >= least_docs) & (z >= least_z)).select("at", "docs").toPandas().sort_values("at")
    used, seen = kept["at"].to_numpy(np.int64), kept["docs"].to_numpy(np.int64)

    def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            if not texts:
                continue
            size, places, at = zip(*occurrences_of(texts, used))
            packed = [pa.array([x.astype("<i4").tobytes() for x in xs], pa.binary()) for xs in (places, at)]
            order = pa.array([md5(t.encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary())
            arrays = [column_of(batch, "doc_id"), order, column_of(batch, "label"), pa.array(size, pa.int32()), *packed]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "order", "label", "size", "places", "sentences"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))), key=lambda r: r[:2])
        found = [(n, np.frombuffer(places, "<i4"), np.frombuffer(at, "<i4")) for _, _, _, n, places, at in rows]
        model = fit_occurrences(used, seen, found, np.array([r[2] for r in rows]), **options)
        index = pa.array(np.append(model.at, -1), pa.int32())
        yield pa.RecordBatch.from_arrays([index, pa.array(np.append(model.value, model.bias), pa.float64())], ["at", "value"])

    schema = "doc_id long, order binary, label int, size int, places binary, sentences binary"
    learnt = sample.mapInArrow(occur, schema).repartition(1).mapInArrow(fit, "at int, value double").toPandas()
    inner = learnt[learnt["at"] >= 0]
    bias = float(learnt.loc[learnt["at"] < 0, "value"].iloc[0])
    return NoisyOr(inner["at"].to_numpy(), inner["value"].to_numpy(np.float32), bias)


def score_toxicity(
    docs: DataFrame, model: NoisyOr, keep: Sequence[str] = (), least: float = 0.5, names: Sequence[str] = ("score", "offending")
) -> DataFrame:
    """Score of every document, with its columns ``keep``, and the sentences of at least ``least`` (number, probability, text)."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    found = "struct<sentence: int, score: double, text: string>"
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keep] + [f"`{names[0]}` double", f"`{names[1]}` array<{found}>"])
    item = pa.struct([("sentence", pa.int32()), ("score", pa.float64()), ("text", pa.string())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slices(texts):
                part = texts[a:b]
                s = sentences_of(part)
                p = 1 / (1 + np.exp(-np.maximum(model.logits(s), -30)))
                spots: list[list[dict]] = [[] for _ in part]
                cut: dict[int, list[str]] = {}
                for k in np.flatnonzero(p >= least).tolist():
                    d, number = int(s.doc[k]), int(s.number[k])
                    if d not in cut:
                        cut[d] = _SENTENCE_END.split(part[d])
                    spots[d].append({"sentence": number, "score": float(p[k]), "text": cut[d][number].strip()})
                arrays = [column_of(batch, k).slice(a, b - a) for k in keep]
                arrays += [pa.array(model.score(s)), pa.array(spots, pa.list_(item))]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, *names])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(score, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending; learns from rows with crc32(doc_id) mod 5 other than 0."""
    held = F.coalesce(crc32_text(F.col("doc_id")) % 5 == 0, F.lit(False))
    model = fit_toxicity(docs, labels, ~held)
    scored = score_toxicity(documents_of(docs), model, ["doc_id"])
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )
