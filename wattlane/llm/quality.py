"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from whole texts. The trees are fitted on a bounded sample of labelled
documents (``per_class`` of each class at most) and flattened into arrays; scoring walks all
trees of a batch of documents together in NumPy.

Null or empty text: all statistics are 0 and it is scored as such. Null doc_id: scored, held out if its
crc32 is null: no. Without labels, or with one class only, the score is the share of label 1
(0.5 without labels). Repeated rows: each is scored. Extra columns: ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, crc32_text, documents_of, labelled_sample, slices, texts_of
from wattlane.llm.words import Words, mix, word_starts

STATISTICS = (
    "log_words", "mean_word", "distinct_words", "repeated_next", "top_word", "distinct_5grams", "upper",
    "capital_words", "symbols", "bars", "exclaims", "digits", "ends_per_word", "line_words",
    "distinct_lines", "not_ascii", "blanks",
)


def _bytes_where(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    out[list(chars)] = 1
    return out


_UPPER = _bytes_where(bytes(range(65, 91)))
_DIGIT = _bytes_where(bytes(range(48, 58)))
_WIDE = _bytes_where(bytes(range(128, 256)))
_BLANK = _bytes_where(b" \t\r\n")
_END = _bytes_where(b".!?")
_SYMBOL = _bytes_where(b"#$%&*+/<=>@[\\]^_`{|}~")
_BAR = _bytes_where(b"|")
_EXCLAIM = _bytes_where(b"!")


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document, and the count of its most frequent one."""
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(keys)))
    top = np.zeros(n)
    np.maximum.at(top, doc[at], runs)
    return np.bincount(doc[at], minlength=n), top


def document_statistics(texts: Sequence[str]) -> np.ndarray:
    """One row of STATISTICS for each text."""
    n = len(texts)
    words = Words(texts)
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    flat = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum([len(b) + 1 for b in raw])])[:-1]
    size = np.maximum([len(b) for b in raw], 1)

    def total(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags[flat], start, dtype=np.int64) if n else np.zeros(0)

    count = np.diff(words.first)
    some = np.maximum(count, 1)
    doc = words.doc
    distinct, top = _distinct(words.hash, doc, n)
    again = np.zeros(len(doc), dtype=bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    grams, gram_doc, _ = words.grams(5)
    distinct_grams, _ = _distinct(grams, gram_doc, n)
    gram_count = np.bincount(gram_doc, minlength=n)
    # Lower case can change a text's length in bytes but not which of its characters are in which word.
    capitals = _UPPER[flat[word_starts(flat)]]
    line_end = np.flatnonzero(words.bytes == 10)
    line = np.searchsorted(line_end, words.start)
    line_first = np.flatnonzero(np.diff(line, prepend=-1))
    line_hash = mix(np.add.reduceat(words.hash, line_first)) if len(line_first) else words.hash
    lines = np.bincount(doc[line_first], minlength=n)
    distinct_lines, _ = _distinct(line_hash, doc[line_first], n)
    length = np.bincount(doc, weights=words.end - words.start, minlength=n)
    out = np.column_stack(
        [
            np.log1p(count),
            length / some,
            distinct / some,
            np.bincount(doc[again], minlength=n) / some,
            top / some,
            distinct_grams / np.maximum(gram_count, 1),
            total(_UPPER) / size,
            np.bincount(doc, weights=capitals, minlength=n) / some,
            total(_SYMBOL) / size,
            total(_BAR) / size,
            total(_EXCLAIM) / size,
            total(_DIGIT) / size,
            total(_END) / some,
            count / np.maximum(lines, 1),
            distinct_lines / np.maximum(lines, 1),
            total(_WIDE) / size,
            (total(_BLANK) - 1) / size,
        ]
    )
    return out.astype(np.float64)


@dataclass
class BoostedTrees:
    """Complete binary trees of one depth, flattened: node i has the children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): to the right if the value is above
    leaf: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 4.0
) -> BoostedTrees:
    """Logistic boosting; splits are sought among ``bins`` quantile bins of each column."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4))
    base = float(np.log(share / (1 - share)))
    inner, columns = (1 << depth) - 1, x.shape[1]
    if len(np.unique(y)) < 2:
        return BoostedTrees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(columns)]
    code = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    offset = code + np.arange(columns) * bins
    total = np.full(len(y), base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            width, first = 1 << level, (1 << level) - 1
            key = ((node - first)[:, None] * (columns * bins) + offset).ravel()
            shape = (width, columns, bins)
            size = width * columns * bins
            gs = np.bincount(key, np.repeat(g, columns), size).reshape(shape).cumsum(2)
            hs = np.bincount(key, np.repeat(h, columns), size).reshape(shape).cumsum(2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
            gain[(hs < least) | (ht - hs < least)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c) :] = 0
            best = gain.reshape(width, -1).argmax(1)
            good = gain.reshape(width, -1).max(1) > 1e-9
            for k in np.flatnonzero(good):
                f, b = divmod(int(best[k]), bins)
                feature[first + k], threshold[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        total += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return BoostedTrees(base, np.array(features), np.array(thresholds), np.array(leaves))


_STATISTIC_SCHEMA = ", ".join(f"{name} double" for name in STATISTICS)


def with_statistics(docs: DataFrame, keys: str) -> DataFrame:
    """``keys`` (a schema of columns to keep) and the statistics of each text."""
    names = [k.split()[0] for k in keys.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slices(texts):
                stats = document_statistics(texts[a:b])
                arrays = [column_of(batch, k).slice(a, b - a) for k in names]
                arrays += [pa.array(stats[:, f]) for f in range(len(STATISTICS))]
                yield pa.RecordBatch.from_arrays(arrays, [*names, *STATISTICS])

    return docs.select(*names, "text").mapInArrow(count, f"{keys}, {_STATISTIC_SCHEMA}")


def fit_quality(docs: DataFrame, labels: DataFrame, train_rule: Column, per_class: int = 10_000, **options) -> BoostedTrees:
    """Trees fitted on labelled documents for which ``train_rule`` holds."""
    sample = labelled_sample(documents_of(docs), labels, "quality", train_rule, per_class)
    rows = with_statistics(sample, "label int").toPandas().sort_values(list(STATISTICS))
    return fit_trees(rows[list(STATISTICS)].to_numpy(float), rows["label"].to_numpy(float), **options)


def score_quality(docs: DataFrame, model: BoostedTrees, keep: Sequence[str] = (), name: str = "score") -> DataFrame:
    """The columns ``keep`` of every document and its score, in a column called ``name``."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([f"`{k}` {kinds[k]}" for k in keep] + [f"`{name}` double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slices(texts):
                got = model.score(document_statistics(texts[a:b]))
                arrays = [column_of(batch, k).slice(a, b - a) for k in keep]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(got)], [*keep, name])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from rows with crc32(doc_id) mod 4 other than 2."""
    held = F.coalesce(crc32_text(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = fit_quality(docs, labels, ~held)
    scored = score_quality(documents_of(docs), model, ["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
