"""Packing of token sequences by best fit and a swap-based local search.

Documents are tokenised once; only (length, crc) of their pieces travel on. Pieces are dealt at
random into groups of bounded size, and each group is packed by itself: best fit in descending
order, then a local search over the bins that are not full. A step exchanges one piece for one,
two for one, or moves a piece, always so that the sum of squared fills grows, which drains
bins until they are empty. A group leaves at most about one bin more than it needs, a share that
falls with the group's size and is the same at every corpus size.

Null or empty text: a document of the end id alone. Null doc_id and repeated rows: packed as
any other row. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, crc_of_ids, documents_of, slices, texts_of
from wattlane.llm.tokens import encoder
from wattlane.session import materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, draw long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids; only documents longer than that are cut."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(tokenizer_path)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, keys = texts_of(batch), column_of(batch, "doc_id").to_pylist()
            for a, b in slices(texts):
                rows = []
                for key, got in zip(keys[a:b], coder.ids(texts[a:b])):
                    ids = np.frombuffer(got + end, dtype=coder.dtype)
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        piece_ids = ids[at : at + capacity]
                        rows.append((key, k, at, len(piece_ids), crc_of_ids(piece_ids), part << 40 | number))
                        number += 1
                doc, piece, start, length, crc, row = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc, pa.int64()),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(row, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "row"],
                )

    found = documents_of(docs).mapInArrow(cut, PIECES.replace("draw", "row"))
    # The row number spreads equal rows over all groups; the table that ``pack`` writes keeps it fixed.
    return found.withColumn("draw", F.xxhash64("doc_id", "piece", "ids_crc32", "row")).drop("row")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit in descending order: each piece goes where the least space is left over."""
    bins: list[list[int]] = []
    by_free: dict[int, list[int]] = {}
    spaces: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect_left(spaces, size)
        if at < len(spaces):
            space = spaces[at]
            k = by_free[space].pop()
            if not by_free[space]:
                del by_free[space]
                spaces.pop(at)
        else:
            space, k = capacity, len(bins)
            bins.append([])
        bins[k].append(i)
        if left := space - size:
            if left not in by_free:
                by_free[left] = []
                insort(spaces, left)
            by_free[left].append(k)
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int, partners: int = 64, rounds: int = 40) -> list[list[int]]:
    """Drain the emptiest bins into the others while the sum of squared fills grows.

    The emptiest bin is taken first. A piece x of it moves to a bin with room, or is exchanged
    for one smaller piece, or for two that are smaller together, of a fuller bin that then holds more.
    Each exchange looks at the ``partners`` fullest bins that can take part; ``rounds`` bounds
    the exchanges of one bin. Both bound the time of a search, not which pieces are packed.
    """
    bins = [list(b) for b in bins]
    size = lengths.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    open_bins = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: fill[k])
    alive = set(open_bins)
    for k in open_bins:
        if k not in alive or fill[k] == capacity:
            continue
        for _ in range(rounds):
            if not bins[k]:
                break
            others = sorted((j for j in alive if j != k and fill[k] <= fill[j] < capacity), key=lambda j: -fill[j])
            if not (step := _step(bins, fill, size, k, others[:partners], others, capacity)):
                break
            j, give, take = step
            for i in give:
                bins[k].remove(i)
                bins[j].append(i)
            for i in take:
                bins[j].remove(i)
                bins[k].append(i)
            moved = sum(size[i] for i in give) - sum(size[i] for i in take)
            fill[k] -= moved
            fill[j] += moved
            if fill[j] == capacity:
                alive.discard(j)
        if not bins[k]:
            alive.discard(k)
    return [b for b in bins if b]


def _step(bins, fill, size, k, near, others, capacity):
    """(bin, pieces given, pieces taken) of the first step that makes bin ``j`` fuller."""
    for i in sorted(bins[k], key=lambda i: -size[i]):
        for j in others:
            if fill[j] + size[i] <= capacity:
                return j, [i], []
    for j in near:
        room = capacity - fill[j]
        for i in sorted(bins[k], key=lambda i: -size[i]):
            least = size[i] - room
            own = sorted(bins[j], key=lambda o: size[o])
            at = bisect_left(own, least, key=lambda o: size[o])
            if at < len(own) and size[own[at]] < size[i]:
                return j, [i], [own[at]]
            a, b = 0, len(own) - 1
            while a < b:
                both = size[own[a]] + size[own[b]]
                if both < least:
                    a += 1
                elif both >= size[i]:
                    b -= 1
                else:
                    return j, [i], [own[a], own[b]]
        inner = sorted(bins[k], key=lambda i: size[i])
        for o in sorted(bins[j], key=lambda o: size[o]):
            a, b = 0, len(inner) - 1
            while a < b:
                gain = size[inner[a]] + size[inner[b]] - size[o]
                if gain <= 0:
                    a += 1
                elif gain > room:
                    b -= 1
                else:
                    return j, [inner[a], inner[b]], [o]
    return None


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, group_pieces: int = 30_000) -> DataFrame:
    """One row for each piece with its sequence and its place there, gapless from 0.

    ``group_pieces`` is the mean number of pieces packed together.
    """
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces")
    total = pieces.count()
    groups = max(1, round(total / group_pieces))

    def fill(key, table):
        group = key[0].as_py()
        table = table.sort_by([("draw", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        lengths = column_of_table(table, "length")
        bins = improve(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for k, members in enumerate(bins):
            sequence[members] = k * groups + group
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        kept = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    grouped = pieces.withColumn("pack_group", F.pmod("draw", F.lit(groups)))
    return grouped.groupBy("pack_group").applyInArrow(fill, PACKED)


def column_of_table(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)
