"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of shingles of five words: weight (1 + ln tf) * (1 + idf) / 2. The idf is
min(ln(N / df), ln 100) / ln 100, so only shingles of over 1 % of the documents count for less; at
most 100 times the mean number of shingles of a document can be that frequent, which bounds the
table of their counts at any corpus size. Counts cover all documents.

1. Improved consistent weighted sampling gives ``bands * rows`` samples of a document. Their gamma
   and uniform draws come from a table of 65,536 triples, picked by a hash of shingle and sample.
2. Documents whose ``rows`` samples of a band agree share a bucket, led by the one that meets most others in
   its buckets: in a group of copies that is the text they were made from, or one near it. Each is compared with
   the best of its leads, by exact weighted Jaccard similarity of the whole texts.
3. Buckets that still hold several components are compared in blocks of bounded size: the similarities of all
   pairs of a block are exact matrix products over the shingles they share, and the block gives back the few links
   that join its components. So every pair that shares a bucket is compared or already in one
   class, no pair is ruled out by its samples, and what a block gives grows with its rows, not its pairs.
4. Components of all links are the classes.

Texts with the same words are one node from the start. Buckets, nodes and links stay in Spark.

A text without words (null, empty, marks only) is alone in its class. One to four words make one
shingle. Null doc_id: class null. Rows of one doc_id: one row each; their classes are those of
their texts. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, documents_of, slices, texts_of
from wattlane.llm.components import connected_components
from wattlane.llm.words import Words, mix
from wattlane.session import materialize, settled

SHINGLE = 5
BUCKETS = 1 << 18
FREQUENT_SHARE = 0.01
SPAN = -np.log(FREQUENT_SHARE)
_TABLE = 1 << 16
# Rows up to which a table of (node, row) is sent to all tasks rather than shuffled.
SENT_ROWS = 100_000
# Blocks of a bucket: texts and characters on either side, and cells of a dense matrix at a time.
BLOCK_ROWS = 256
BLOCK_CHARS = 1 << 20
DENSE_CELLS = 1 << 22


@dataclass
class Vectors:
    """Distinct shingles of some texts, ordered by text."""

    shingle: np.ndarray
    doc: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, words: Words) -> Vectors:
        shingle, doc, _ = words.grams(SHINGLE, short=True)
        order = np.lexsort((shingle, doc))
        shingle, doc = shingle[order], doc[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(new)
        return cls(shingle[at], doc[at], np.diff(np.append(at, len(doc))))


class Idf:
    """Weights of shingles; ``shingle`` (sorted) holds the frequent ones."""

    def __init__(self, shingle: np.ndarray, count: np.ndarray, n_docs: int) -> None:
        order = np.argsort(shingle)
        self.shingle = shingle[order].astype(np.uint64)
        rare = np.log(np.maximum(n_docs, 1) / np.maximum(count[order], 1))
        self.value = np.minimum(np.maximum(rare, 0), SPAN) / SPAN

    def factor(self, shingle: np.ndarray) -> np.ndarray:
        """(1 + idf) / 2, the weight of a shingle that occurs once."""
        idf = np.ones(len(shingle))
        if len(self.shingle):
            at = np.minimum(np.searchsorted(self.shingle, shingle), len(self.shingle) - 1)
            idf = np.where(self.shingle[at] == shingle, self.value[at], 1.0)
        return (1 + idf) / 2

    def log_weights(self, v: Vectors) -> np.ndarray:
        return np.log((1 + np.log(v.times)) * self.factor(v.shingle))


class Sampler:
    """Consistent weighted samples of weighted shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 20) -> None:
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2, 1, _TABLE).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, _TABLE)).astype(np.float32)
        self.beta = rng.random(_TABLE).astype(np.float32)
        n = bands * rows
        self.factor = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.unit = self._ordered(self.log_c - self.r * (1 - self.beta))

    @staticmethod
    def _ordered(a: np.ndarray) -> np.ndarray:
        """Bits of a 32-bit float in the upper half, such that their order is that of the floats."""
        bits = a.astype(np.float32).view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
        return bits.astype(np.uint64) << np.uint64(32)

    def band_keys(self, shingle: np.ndarray, log_weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(sets, bands) keys; ``first`` is where each (non-empty) set starts."""
        other = np.flatnonzero(log_weight)
        log_s = log_weight[other].astype(np.float32)
        low = np.uint64(0xFFFFFFFF)
        out = np.zeros((len(first), self.bands), dtype=np.uint64)
        for k in range(self.bands * self.rows):
            drawn = (shingle ^ self.salt[k]) * self.factor[k]
            at = (drawn >> np.uint64(48)).astype(np.int64)
            key = self.unit[at]
            key |= (drawn >> np.uint64(16)) & low
            if len(other):
                i = at[other]
                r = self.r[i]
                t = np.floor(log_s / r + self.beta[i])
                value = self._ordered(self.log_c[i] - r * (t + 1 - self.beta[i]))
                step = t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                key[other] = value | (((drawn[other] >> np.uint64(16)) ^ (step >> np.uint64(20))) & low)
            sample = np.minimum.reduceat(key, first)
            band = k // self.rows
            out[:, band] = mix(out[:, band] * np.uint64(0x9FB21C651E98DF25) + sample + np.uint64(band + 1))
        return out


def _node_of(words: Words, d: int) -> bytes:
    return hashlib.md5(words.hash[words.first[d] : words.first[d + 1]].tobytes()).digest()


def frequent_shingles(docs: DataFrame) -> Idf:
    """Document counts of the shingles of over 1 % of the documents.

    First counts in 2**18 hash buckets, which never fall below a member's count; then exact
    counts of the shingles in buckets that reach the limit.
    """

    def bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n_docs = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slices(texts):
                v = Vectors.of(Words(texts[a:b]))
                total += np.bincount((v.shingle >> np.uint64(46)).astype(np.int64), minlength=BUCKETS)
                n_docs += len(np.unique(v.doc))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n_docs), pa.int64())], ["bucket", "n"]
        )

    counts = docs.select("text").mapInArrow(bucket_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "shingle-buckets")
    n_docs = int((counts.where("bucket = -1").first() or {"n": 0})["n"])
    least = FREQUENT_SHARE * n_docs
    full = np.zeros(BUCKETS, dtype=bool)
    full[[r["bucket"] for r in counts.where((F.col("bucket") >= 0) & (F.col("n") >= least) & (F.col("n") > 1)).collect()]] = True

    def shingle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for a, b in slices(texts):
                v = Vectors.of(Words(texts[a:b]))
                found, n = np.unique(v.shingle[full[(v.shingle >> np.uint64(46)).astype(np.int64)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])

    if not full.any():
        return Idf(np.zeros(0, np.uint64), np.zeros(0), n_docs)
    exact = docs.select("text").mapInArrow(shingle_counts, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = exact.where((F.col("n") >= least) & (F.col("n") > 1)).toPandas()
    return Idf(rows["shingle"].to_numpy().view(np.uint64), rows["n"].to_numpy(float), n_docs)


def signatures(docs: DataFrame, idf: Idf, bands: int, rows: int) -> DataFrame:
    """(row, doc_id, node, keys): a node is a text up to case, marks and spacing; keys once for each node and slice."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands, rows)
        for batch in batches:
            texts, rows_of, ids = texts_of(batch), column_of(batch, "row"), column_of(batch, "doc_id")
            for a, b in slices(texts, 1 << 18):
                words = Words(texts[a:b])
                nodes: list[bytes | None] = []
                fresh = np.zeros(b - a, dtype=bool)
                seen = set()
                for d in range(b - a):
                    node = _node_of(words, d) if words.first[d + 1] > words.first[d] else None
                    fresh[d] = node is not None and node not in seen
                    seen.add(node)
                    nodes.append(node)
                v = Vectors.of(words)
                keep = fresh[v.doc]
                shingle, doc, weight = v.shingle[keep], v.doc[keep], idf.log_weights(v)[keep]
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                keys: list[list[int] | None] = [None] * (b - a)
                if len(first):
                    for d, row in zip(doc[first].tolist(), sampler.band_keys(shingle, weight, first).view(np.int64).tolist()):
                        keys[d] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        rows_of.slice(a, b - a),
                        ids.slice(a, b - a),
                        pa.array(nodes, pa.binary()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["row", "doc_id", "node", "keys"],
                )

    kind = docs.schema["row"].dataType.simpleString()
    return docs.mapInArrow(sign, f"row {kind}, doc_id long, node binary, keys array<long>")


def _texts_of_nodes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of the nodes in ``wanted`` (node, row)."""
    if wanted.count() <= SENT_ROWS:
        wanted = F.broadcast(wanted)
    return docs.join(wanted, "row").select("node", "text")


def compare(pairs: DataFrame, texts: DataFrame, idf: Idf, least: float) -> DataFrame:
    """Pairs (a, b, similarity) of nodes whose weighted Jaccard similarity reaches ``least``."""
    rows = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = {k: column_of(batch, k).to_pylist() for k in ("a", "b")}
            text_a, text_b = texts_of(batch, "text_a"), texts_of(batch, "text_b")
            for start, stop in slices([x + y for x, y in zip(text_a, text_b)], 1 << 20):
                part: dict[bytes, str] = {}
                for i in range(start, stop):
                    part[names["a"][i]], part[names["b"][i]] = text_a[i], text_b[i]
                place = {node: k for k, node in enumerate(part)}
                v = Vectors.of(Words(list(part.values())))
                weight = np.exp(idf.log_weights(v))
                first = np.searchsorted(v.doc, np.arange(len(part) + 1))
                found = []
                for i in range(start, stop):
                    p, q = place[names["a"][i]], place[names["b"][i]]
                    x, y = slice(first[p], first[p + 1]), slice(first[q], first[q + 1])
                    _, i_x, i_y = np.intersect1d(v.shingle[x], v.shingle[y], assume_unique=True, return_indices=True)
                    common = np.minimum(weight[x][i_x], weight[y][i_y]).sum()
                    joint = weight[x].sum() + weight[y].sum() - common
                    found.append(common / joint if joint else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names["a"][start:stop], pa.binary()), pa.array(names["b"][start:stop], pa.binary()), pa.array(found, pa.float64())],
                    ["a", "b", "similarity"],
                )

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(measure, "a binary, b binary, similarity double").where(F.col("similarity") >= least)


def similarities(left: list[str], right: list[str] | None, idf: Idf, least: float) -> np.ndarray:
    """Exact weighted Jaccard similarities of all pairs, of ``left`` with itself if ``right`` is None.

    A pair has in common, for each shingle, the weight of the lower of two counts: a sum over counts l of what the
    l-th occurrence adds where both have it. So each distinct count is one matrix product over shared shingles.
    """
    own = len(left)
    v = Vectors.of(Words(left if right is None else left + right))
    n = own if right is None else own + len(right)
    factor = idf.factor(v.shingle)
    weight = np.bincount(v.doc, (1 + np.log(v.times)) * factor, minlength=n)
    _, code = np.unique(v.shingle, return_inverse=True)
    if right is None:
        shared = np.bincount(code)[code] > 1
    else:
        shared = (np.bincount(code, v.doc < own)[code] > 0) & (np.bincount(code, v.doc >= own)[code] > 0)
    doc, times, factor, code = v.doc[shared], v.times[shared], factor[shared], code[shared]
    rows, columns = slice(0, own), slice(0, own) if right is None else slice(own, n)
    common = np.zeros((own, n if right is None else n - own))
    if len(code):
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        doc, times, factor, code = doc[order], times[order], factor[order], code[order]
        step = max(1, DENSE_CELLS // n)
        for start in range(0, int(code[-1]) + 1, step):
            a, b = np.searchsorted(code, [start, start + step])
            before = 0.0
            for count in np.unique(times[a:b]).tolist():
                at = a + np.flatnonzero(times[a:b] >= count)
                has = np.zeros((n, step))
                has[doc[at], code[at] - start] = np.sqrt(factor[at])
                common += (1 + np.log(count) - before) * (has[rows] @ has[columns].T)
                before = 1 + np.log(count)
    joint = weight[rows, None] + weight[None, columns] - common
    out = np.where(joint > 0, common / np.where(joint > 0, joint, 1.0), 0.0)
    if right is None:
        np.fill_diagonal(out, weight > 0)
    # At the limit the order of summation must not decide.
    return np.where(np.abs(out - least) < 1e-12, least, out)


def _bridges(a: list[int], b: list[int]) -> list[int]:
    """Positions of as few of the pairs (a, b) of components as join what all of them join."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a, b)):
        x, y = find(x), find(y)
        if x != y:
            parent[x] = y
            kept.append(k)
    return kept


def _between_components(members: DataFrame, texts: DataFrame, components: DataFrame, idf: Idf, least: float) -> DataFrame:
    """Links (a, b) between the components of nodes that share a bucket, found by comparing all pairs in blocks."""
    sized = texts.select("node", F.length("text").alias("chars"))
    placed = members.join(components, "node", "left").withColumn("component", F.coalesce("component", "node")).join(sized, "node")
    marks = [F.sum(F.xxhash64("node", F.lit(salt)).cast("decimal(38,0)")).alias(f"mark{salt}") for salt in (1, 2)]
    buckets = placed.groupBy("key").agg(
        (F.min("component") != F.max("component")).alias("mixed"), F.count("*").alias("n"), F.sum("chars").alias("chars"), *marks
    )
    # Buckets of the same members are compared once.
    buckets = buckets.where("mixed").groupBy("mark1", "mark2", "n", "chars").agg(F.min("key").alias("key"))
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("chars") / BLOCK_CHARS)).cast("int")
    buckets = materialize(buckets.select("key", "n", F.least(parts, F.col("n").cast("int")).alias("parts")), "mixed-buckets")
    small = buckets.where("parts = 1").agg(F.sum("n")).first()[0] or 0
    units = max(1, -(-small // BLOCK_ROWS))

    mine = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    each = placed.join(buckets.select("key", "parts"), "key").withColumns(
        {"mine": mine, "other": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))}
    )
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    # Small buckets share a task's group, a block of a large one is a group of its own.
    unit = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("key"), F.lit(units))).otherwise(F.lit(units) + F.abs(F.shiftright(F.xxhash64("key", low, high), 2)))
    side = F.when(low == high, 0).when(F.col("mine") == low, 0).otherwise(1)
    each = each.select(unit.alias("unit"), "key", low.alias("low"), high.alias("high"), side.alias("side"), "node", "component")

    def compare_blocks(key, table):
        groups: dict[tuple, tuple[list, list]] = {}
        columns = (table.column(c).to_pylist() for c in ("key", "low", "high", "side", "node", "component", "text"))
        for bucket, x, y, where, *row in zip(*columns):
            groups.setdefault((bucket, x, y), ([], []))[where].append(row)
        found: list[tuple[bytes, bytes]] = []
        for (_, x, y), (here, there) in groups.items():
            other = here if x == y else there
            if not here or not other:
                continue
            near = similarities([r[2] for r in here], None if x == y else [r[2] for r in other], idf, least)
            names = {name: k for k, name in enumerate({r[1] for r in here + other})}
            in_here, in_other = (np.array([names[r[1]] for r in rows]) for rows in (here, other))
            i, j = np.nonzero((near >= least) & (in_here[:, None] != in_other[None]))
            for k in _bridges(in_here[i].tolist(), in_other[j].tolist()):
                found.append((here[i[k]][0], other[j[k]][0]))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return each.join(texts, "node").groupBy("unit").applyInArrow(compare_blocks, "a binary, b binary")


def _placed(pairs: DataFrame, components: DataFrame, end: str) -> DataFrame:
    """``pairs`` with the component of the node ``end``, which is the node itself if it has no link."""
    names = components.select(F.col("node").alias(end), F.col("component").alias(f"in_{end}"))
    return pairs.join(names, end, "left").withColumn(f"in_{end}", F.coalesce(f"in_{end}", end))


def _joined(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more ``links`` between their nodes: those of the components as nodes, carried over."""
    ends = _placed(_placed(links.select("a", "b"), components, "a"), components, "b")
    ends = materialize(ends.select(F.col("in_a").alias("a"), F.col("in_b").alias("b")), "links")
    over = connected_components(ends).select(F.col("node").alias("component"), F.col("component").alias("over"))
    old = components.join(over, "component", "left").select("node", F.coalesce("over", "component").alias("component"))
    single = over.join(components, "component", "left_anti").select(F.col("component").alias("node"), F.col("over").alias("component"))
    return materialize(old.unionByName(single), "components")


def rows_of_documents(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) with a key of its own for each row, written so that it stays the same."""
    return materialize(documents_of(docs).withColumn("row", F.monotonically_increasing_id()), "rows")


def near_duplicates(docs: DataFrame, least: float = 0.8, bands: int = 20, rows: int = 6) -> DataFrame:
    """(doc_id, class_id): the class of a document is the least doc_id in it.

    With 20 bands of 6 samples a pair at the limit shares a bucket with a chance of 99.8 %.
    """
    every = rows_of_documents(docs)
    known = every.where("doc_id IS NOT NULL")
    out = settled(lambda: row_classes(known, least, bands, rows).select("doc_id", "class_id"), docs.sparkSession, "classes")
    return out.unionByName(every.where("doc_id IS NULL").select("doc_id", F.col("doc_id").alias("class_id")))


def row_classes(known: DataFrame, least: float = 0.8, bands: int = 20, rows: int = 6) -> DataFrame:
    """(row, doc_id, class_row, class_id) of a table of (row, doc_id, text) with distinct rows of any orderable kind.

    A class has the name of its row of least doc_id (nulls last), then of least row.
    """
    idf = frequent_shingles(known)
    signed = materialize(signatures(known, idf, bands, rows), "signatures")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row")).alias("who"))
    keyed = signed.where("keys IS NOT NULL").select("node", F.explode("keys").alias("key")).distinct()
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(keyed.join(shared, "key"), "buckets")
    met = materialize(members.groupBy("node").agg(F.sum("n").alias("met")), "met")
    first = F.max_by("node", F.struct("met", "node"))
    lead = members.join(met, "node").groupBy("key").agg(first.alias("lead"), F.max("met").alias("lead_met"))
    members = materialize(members.join(lead, "key"), "led-buckets")
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "who.row")
    texts = materialize(_texts_of_nodes(known, materialize(wanted, "wanted")), "candidate-texts")
    pairs = members.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b"), "lead_met")
    best = F.max_by("a", F.struct("lead_met", "a"))
    done = pairs.groupBy("b").agg(best.alias("a")).select("a", "b")
    component = connected_components(materialize(compare(done, texts, idf, least).select("a", "b"), "links"))
    component = _joined(component, _between_components(members.select("key", "node"), texts, component, idf, least))
    named = nodes.join(component, "node")
    least_who = named.groupBy("component").agg(F.min("who").alias("class"))
    classes = named.join(least_who, "component").select("node", "class")
    own = signed.select("row", "doc_id", "node").join(nodes, "node", "left").join(classes, "node", "left")
    own = own.withColumn("class", F.coalesce("class", "who", F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row")))
    return own.select("row", "doc_id", F.col("class.row").alias("class_row"), F.col("class.doc_id").alias("class_id"))
