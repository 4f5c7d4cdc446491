"""Fill-in-the-middle forms of documents over seekable compressed frames.

``frame_texts`` stores each text as independent zstandard frames of about ``frame_bytes`` bytes, with the
units and code points that have ended by the end of each frame. ``fill_in_middle`` finds the frames that
hold the two cuts from those counts alone, decompresses only them, and puts the output together from whole
frames, which it moves as they are, and the re-compressed pieces of the cut ones. ``stream_digests`` reads
the frames of the output in order, never more than one at a time beside the last one kept, finds the
marks and gives the digests of the output and of the text rebuilt from it.

A unit is a run of white space with the run of other characters after it, or the white space at the end. A
frame ends with a unit; only a unit longer than a frame is cut, between characters. So memory is
a text as Spark holds it, and for a long one a byte's worth of flags for each byte of it.

Null or empty text: no frames, 0 units, plain. Null doc_id: drawn as the word "null". Repeated rows: one row
each, with equal draws for equal ids. Empty table: no rows. Extra columns: ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of

FRAME_BYTES = 1 << 16
MARKS = (b"<P>", b"<S>", b"<M>")
FRAMED = (
    "doc_id long, draw string, marked boolean, frames array<binary>, units array<long>, chars array<long>"
)
FILLED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, frames array<binary>"
)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def unit_ends(raw: bytes, last: bool = True) -> np.ndarray:
    """Where the units of a text end, in bytes; without ``last``, only those that end before the end."""
    space = _SPACE[np.frombuffer(raw, dtype=np.uint8)]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(raw)) if last and len(raw) else ends


def code_points(raw: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80))


def _character_start(raw: bytes, at: int) -> int:
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


def frame_cuts(raw: bytes, ends: np.ndarray, frame_bytes: int) -> list[int]:
    """Ends of the frames: the last end of a unit within ``frame_bytes``, or else the next character there."""
    cuts, at = [], 0
    while at < len(raw):
        limit = at + frame_bytes
        if limit >= len(raw):
            cut = len(raw)
        else:
            k = int(np.searchsorted(ends, limit, side="right")) - 1
            cut = int(ends[k]) if k >= 0 and ends[k] > at else _character_start(raw, limit)
        cuts.append(cut)
        at = cut
    return cuts


def pieces_of(raw: bytes, frame_bytes: int, press: zstandard.ZstdCompressor) -> tuple[list[bytes], list[int], list[int]]:
    """Frames of a text with the units and the code points that have ended by the end of each."""
    ends = unit_ends(raw)
    frames, units, chars, at, seen = [], [], [], 0, 0
    for cut in frame_cuts(raw, ends, frame_bytes):
        part = raw[at:cut]
        frames.append(press.compress(part))
        seen += code_points(part)
        chars.append(seen)
        units.append(int(np.searchsorted(ends, cut, side="right")))
        at = cut
    return frames, units, chars


def frame_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES, seed: int = 42) -> DataFrame:
    """doc_id, draw (hex digest of seed and key), frames and what has ended by each, and whether a mark is in the text."""

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            marked, frames, units, chars = [], [], [], []
            for value in column_of(batch, "raw"):
                raw = value.as_py()
                got = pieces_of(raw, frame_bytes, press)
                marked.append(any(m in raw for m in MARKS))
                for column, part in zip((frames, units, chars), got):
                    column.append(part)
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    column_of(batch, "draw"),
                    pa.array(marked, pa.bool_()),
                    pa.array(frames, pa.list_(pa.binary())),
                    pa.array(units, pa.list_(pa.int64())),
                    pa.array(chars, pa.list_(pa.int64())),
                ],
                ["doc_id", "draw", "marked", "frames", "units", "chars"],
            )

    number = F.col(key).cast("long")
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(number.cast("string"), F.lit("null")))
    rows = docs.select(
        number.alias("doc_id"),
        F.sha2(told, 256).alias("draw"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("raw"),
    )
    return rows.mapInArrow(frame, FRAMED)


def _draw(part: int) -> Column:
    return F.conv(F.substring("draw", 8 * part + 1, 8), 16, 10).cast("long")


def planned(framed: DataFrame, share: int = 50, spm_share: int = 80) -> DataFrame:
    """The framed texts with n, the form and the units (low, high) at which prefix and middle end."""
    n = F.coalesce(F.try_element_at("units", F.lit(-1)), F.lit(0)).cast("long")
    df = framed.withColumn("n", n)
    one, two = _draw(0) % (F.col("n") + 1), _draw(1) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (_draw(2) % 100 >= share)
    form = F.when(plain, "plain").when(_draw(3) % 100 < spm_share, "spm").otherwise("psm")
    return df.withColumns({"form": form, "low": F.least(one, two), "high": F.greatest(one, two)})


class _Cut:
    """A place in a framed text: ``frame`` holds it, ``at`` bytes in; ``chars`` code points lie before it."""

    def __init__(self, unit: int, units: list[int], chars: list[int], open_frame) -> None:
        self.frame = bisect_left(units, unit) if unit else 0
        before = self.frame - 1
        wanted = unit - (units[before] if self.frame else 0)
        raw = open_frame(self.frame)
        inside = unit_ends(raw, last=False)
        self.at = 0 if not wanted else int(inside[wanted - 1]) if wanted <= len(inside) else len(raw)
        self.chars = (chars[before] if self.frame else 0) + code_points(raw[: self.at])


def _between(frames: list[bytes], open_frame, start: _Cut | None, stop: _Cut | None) -> list[tuple[bool, bytes]]:
    """(already compressed, bytes) of what lies between two cuts; none stands for the text's start or end."""
    first, low = (start.frame, start.at) if start else (0, 0)
    last, high = (stop.frame, stop.at) if stop else (len(frames), 0)
    if first == last:
        return [(False, open_frame(first)[low:high])]
    parts = [(True, frames[first])] if not low else [(False, open_frame(first)[low:])]
    parts += [(True, f) for f in frames[first + 1 : last]]
    return [*parts, (False, open_frame(last)[:high])] if high else parts


def _assembled(parts: list[tuple[bool, bytes]], press: zstandard.ZstdCompressor) -> list[bytes]:
    """Frames of the parts in order; neighbours that are not compressed yet share one."""
    frames, loose = [], b""
    for done, part in parts:
        if not done:
            loose += part
            continue
        if loose:
            frames.append(press.compress(loose))
            loose = b""
        frames.append(part)
    return [*frames, press.compress(loose)] if loose else frames


def fill_in_middle(framed: DataFrame, share: int = 50, spm_share: int = 80) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the frames of the output."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, unpress = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            prefix, middle, output = [], [], []
            names = ["form", "low", "high", "units", "chars"]
            for frames, form, low, high, units, chars in zip(column_of(batch, "frames"), *(column_of(batch, c).to_pylist() for c in names)):
                frames = frames.as_py()
                if form == "plain":
                    prefix.append(None)
                    middle.append(None)
                    output.append(frames)
                    continue
                opened: dict[int, bytes] = {}

                def open_frame(k: int) -> bytes:
                    if k not in opened:
                        opened[k] = unpress.decompress(frames[k])
                    return opened[k]

                a, b = (_Cut(unit, units, chars, open_frame) for unit in (low, high))
                p, m, s = (_between(frames, open_frame, *ends) for ends in ((None, a), (a, b), (b, None)))
                mark = [[(False, m)] for m in MARKS]
                if form == "psm":
                    parts = mark[0] + p + mark[1] + s + mark[2] + m
                else:
                    parts = mark[1] + s + mark[0] + p + mark[2] + m
                prefix.append(a.chars)
                middle.append(b.chars - a.chars)
                output.append(_assembled(parts, press))
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(batch, "doc_id"),
                    column_of(batch, "n"),
                    column_of(batch, "form"),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.list_(pa.binary())),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames"],
            )

    df = planned(framed, share, spm_share).select("doc_id", "n", "form", "low", "high", "frames", "units", "chars")
    return df.mapInArrow(fill, FILLED)


class FrameReader:
    """Ordered frames as one run of bytes that can be read from any place; keeps the last frame it opened."""

    def __init__(self, frames: list[bytes], unpress: zstandard.ZstdDecompressor) -> None:
        self.frames, self.unpress = frames, unpress
        sizes = [zstandard.frame_content_size(f) for f in frames]
        self.starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).tolist()
        self._last = (-1, b"")

    @property
    def size(self) -> int:
        return self.starts[-1]

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            self._last = (k, self.unpress.decompress(self.frames[k]))
        return self._last[1]

    def read(self, start: int = 0, stop: int | None = None) -> Iterator[bytes]:
        stop = self.size if stop is None else stop
        k = max(0, bisect_left(self.starts, start + 1) - 1)
        while k < len(self.frames) and self.starts[k] < stop:
            low, high = max(start - self.starts[k], 0), min(stop, self.starts[k + 1]) - self.starts[k]
            yield self.frame(k)[low:high]
            k += 1

    def find(self, what: bytes, start: int) -> int:
        """The first place of ``what`` at or after ``start``, also across frames; -1 where there is none."""
        tail, at = b"", start
        for part in self.read(start):
            if (found := (tail + part).find(what)) >= 0:
                return at - len(tail) + found
            at += len(part)
            tail = (tail + part)[1 - len(what) :]
        return -1


def original_ranges(reader: FrameReader, form: str) -> list[tuple[int, int]]:
    """Where prefix, middle and suffix stand in an output; all of a plain one is its text."""
    if form == "plain":
        return [(0, reader.size)]
    head, other = MARKS[:2] if form == "psm" else MARKS[1::-1]
    second = reader.find(other, len(head))
    third = reader.find(MARKS[2], second + 3)
    first, next_ = (len(head), second), (second + 3, third)
    prefix, suffix = (first, next_) if form == "psm" else (next_, first)
    return [prefix, (third + 3, reader.size), suffix]


def _read_back(filled: DataFrame, results, fields: dict[str, pa.DataType], kinds: str) -> DataFrame:
    """The rows of ``filled`` with what ``results(reader, form)`` gives in place of the frames."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            got = [results(FrameReader(f.as_py(), unpress), form) for f, form in zip(column_of(batch, "frames"), column_of(batch, "form").to_pylist())]
            columns = [pa.array([row[i] for row in got], kind) for i, kind in enumerate(fields.values())]
            keep = [c for c in batch.schema.names if c != "frames"]
            yield pa.RecordBatch.from_arrays([*(column_of(batch, c) for c in keep), *columns], [*keep, *fields])

    return filled.mapInArrow(read, f"{FILLED.replace(', frames array<binary>', '')}, {kinds}")


def stream_digests(filled: DataFrame) -> DataFrame:
    """``filled`` with sha256 digests of each output and of the text rebuilt from it, in place of the frames."""

    def digests(reader: FrameReader, form: str) -> tuple[str, str]:
        output = hashlib.sha256()
        for part in reader.read():
            output.update(part)
        restored = hashlib.sha256()
        for start, stop in original_ranges(reader, form):
            for part in reader.read(start, stop):
                restored.update(part)
        return output.hexdigest(), restored.hexdigest()

    fields = {"output_sha256": pa.string(), "restored_sha256": pa.string()}
    return _read_back(filled, digests, fields, "output_sha256 string, restored_sha256 string")


def output_texts(filled: DataFrame) -> DataFrame:
    """``filled`` with the output as text in place of its frames."""
    return _read_back(filled, lambda reader, form: (b"".join(reader.read()),), {"output": pa.binary()}, "output binary").withColumn(
        "output", F.col("output").cast("string")
    )


def oracle_sql() -> str:
    """The same digests by plain string functions of DuckDB."""
    pattern = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
    draws = ", ".join(f"('0x' || substr(sha256('42:' || doc_id), {8 * i + 1}, 8))::bigint AS h{i + 1}" for i in range(4))
    return f"""
    WITH t AS (
      SELECT doc_id, coalesce(text, '') AS text, {draws},
        regexp_extract_all(coalesce(text, ''), '{pattern}') AS u
      FROM documents
    ), c AS (
      SELECT *, len(u)::bigint AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS low,
        greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS high,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
          THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM t
    ), p AS (
      SELECT doc_id, n, form, text, array_to_string(u[1:low], '') AS prefix,
        array_to_string(u[low + 1:high], '') AS middle, array_to_string(u[high + 1:], '') AS suffix
      FROM c
    )
    SELECT doc_id, n, form,
      CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
      CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
      sha256(text) AS restored_sha256
    FROM p
    """
