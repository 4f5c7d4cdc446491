"""Token-id files with Elias-Fano coded document boundaries.

A shard image holds whole documents in ascending doc_id order: the concatenated ids (16 bits
where the vocabulary allows it) and, for the document boundaries and the doc_ids, an Elias-Fano
sequence each. A sequence of n values below u takes about 2 + log2(u / n) bits a value; select
samples (the position of every 128th set bit, in 32 bits) let a single offset be read without
decoding the rest and without a table of 64-bit offsets.

Spark writes the images as binary cells of a Parquet folder, so a task that runs twice or dies
leaves one committed copy, on any store. A shard is closed at ``shard_tokens`` ids; a longer
document is a shard of its own. Offsets across shards need one number for each write partition.

Null or empty text: a document of the end id alone. Null doc_id: kept, before all others. Equal
doc_ids and repeated rows: all kept, ordered by text. Empty table: no image. Extra columns: ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.llm.common import column_of, documents_of, slices, texts_of
from wattlane.llm.tokens import encoder
from wattlane.session import shuffle_width

MAGIC = b"WLTOK1\0\0"
SAMPLE = 128
IMAGE_SCHEMA = "part int, seq int, part_start long, n_docs long, n_tokens long, image binary"
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, sampled select."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """``values`` are non-negative and do not decrease."""
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        where = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(where[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[where] = 1
        if low_bits:
            shifts = np.arange(low_bits, dtype=np.uint64)
            low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, dtype=np.uint8)
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), where[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Position of set bit ``i`` of the high part, from the sample before it."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        head = int(self.high[byte]) >> (at % 8) << (at % 8)
        while True:
            ones = int(_ONES[head])
            if left < ones:
                for bit in range(8):
                    if head >> bit & 1:
                        if left == 0:
                            return byte * 8 + bit
                        left -= 1
            left -= ones
            byte += 1
            head = int(self.high[byte])

    def __getitem__(self, i: int) -> int:
        low = 0
        for k in range(self.low_bits):
            bit = i * self.low_bits + k
            low |= (int(self.low[bit // 8]) >> (bit % 8) & 1) << k
        return (self.select(i) - i) << self.low_bits | low

    def decode(self) -> np.ndarray:
        """All values."""
        where = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (where - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits and self.n:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, -1)
            out |= bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out

    def pack(self) -> bytes:
        head = struct.pack("<QBQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def unpack(cls, buffer: memoryview, at: int) -> tuple[EliasFano, int]:
        n, low_bits, n_low, n_high, n_samples = struct.unpack_from("<QBQQQ", buffer, at)
        at += struct.calcsize("<QBQQQ")
        low = np.frombuffer(buffer, np.uint8, n_low, at)
        high = np.frombuffer(buffer, np.uint8, n_high, at + n_low)
        samples = np.frombuffer(buffer, "<u4", n_samples, at + n_low + n_high)
        return cls(n, low_bits, low, high, samples), at + n_low + n_high + 4 * n_samples


def shard_image(keys: list[int | None], parts: list[bytes], dtype: np.dtype, end: bytes = b"") -> tuple[bytes, int]:
    """An image of the documents, each with ``end`` after it, and its number of ids; null keys come first."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], dtype=np.int64)
    base = int(known[0]) if len(known) else 0
    bounds = np.concatenate([[0], np.cumsum([(len(p) + len(end)) // dtype.itemsize for p in parts])]).astype(np.int64)
    gaps = known.astype(np.uint64) - np.int64(base).astype(np.uint64)
    head = MAGIC + struct.pack("<BqQQ", dtype.itemsize, base, nulls, int(bounds[-1]))
    return head + EliasFano.encode(bounds).pack() + EliasFano.encode(gaps).pack() + end.join([*parts, b""]), int(bounds[-1])


class ShardReader:
    """Documents of one image; ``offset(i)`` reads one boundary, ``bounds`` all of them."""

    def __init__(self, image: bytes | memoryview) -> None:
        view = memoryview(image)
        if bytes(view[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token shard")
        width, self.base, self.nulls, self.n_tokens = struct.unpack_from("<BqQQ", view, len(MAGIC))
        self.boundaries, at = EliasFano.unpack(view, len(MAGIC) + struct.calcsize("<BqQQ"))
        self.gaps, at = EliasFano.unpack(view, at)
        self.ids = np.frombuffer(view, np.dtype(f"<u{width}"), self.n_tokens, at)

    def __len__(self) -> int:
        return self.boundaries.n - 1

    def offset(self, i: int) -> int:
        return self.boundaries[i]

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offset(i) : self.offset(i + 1)]

    def keys(self) -> list[int | None]:
        return self.key_array().to_pylist()

    def key_array(self) -> pa.Array:
        known = self.gaps.decode() + self.base
        return pa.concat_arrays([pa.nulls(self.nulls, pa.int64()), pa.array(known, pa.int64())])

    def digests(self, bounds: np.ndarray) -> list[int]:
        """Unsigned crc32 of each document's ids as little-endian unsigned 32-bit integers, which are made once."""
        wide = memoryview(self.ids.astype("<u4")).cast("B") if len(self.ids) else memoryview(b"")
        ends = (4 * bounds).tolist()
        return [zlib.crc32(wide[a:b]) for a, b in zip(ends, ends[1:])]


def token_images(docs: DataFrame, tokenizer_path: str, end_id: int = 0, shard_tokens: int = 1 << 21) -> DataFrame:
    """Shard images of ``docs`` (doc_id, text), in ascending doc_id order over (part, seq)."""
    spark = docs.sparkSession
    placed = documents_of(docs).repartitionByRange(shuffle_width(spark), "doc_id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = encoder(tokenizer_path)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        parts: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            image, n = shard_image(keys, parts, coder.dtype, end)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([len(keys)], pa.int64()),
                    pa.array([n], pa.int64()),
                    pa.array([image], pa.binary()),
                ],
                ["part", "seq", "part_start", "n_docs", "n_tokens", "image"],
            )

        for batch in batches:
            texts, ids = texts_of(batch), column_of(batch, "doc_id").to_pylist()
            for a, b in slices(texts):
                for key, got in zip(ids[a:b], coder.ids(texts[a:b])):
                    n = len(got) // coder.dtype.itemsize + 1
                    if keys and size + n > shard_tokens:
                        yield close()
                        seq, before = seq + 1, before + size
                        keys, parts, size = [], [], 0
                    keys.append(key)
                    parts.append(got)
                    size += n
        if keys:
            yield close()

    return placed.sortWithinPartitions("doc_id", "text").mapInArrow(write, IMAGE_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, shard_tokens: int = 1 << 21) -> None:
    images = token_images(docs, tokenizer_path, end_id, shard_tokens)
    images.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files (and its ids)."""
    images = spark.read.schema(IMAGE_SCHEMA).parquet(path)
    sizes = images.groupBy("part").agg(F.sum("n_tokens").alias("size")).orderBy("part").collect()
    ends = np.cumsum([r["size"] for r in sizes]).tolist()
    bases = spark.createDataFrame(
        [(r["part"], end - r["size"]) for r, end in zip(sizes, ends)], "part int, base long"
    )
    placed = images.join(F.broadcast(bases), "part").select(
        "image", (F.col("base") + F.col("part_start")).alias("shard_start")
    )
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = ShardReader(memoryview(column_of(batch, "image")[i].as_buffer()))
                first = column_of(batch, "shard_start")[i].as_py()
                bounds = shard.boundaries.decode()
                out = [
                    shard.key_array(),
                    pa.array(bounds[:-1] + first, pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(shard.digests(bounds), pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    flat = pa.array(shard.ids.astype(np.int32))
                    out.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    return placed.mapInArrow(read, schema)
