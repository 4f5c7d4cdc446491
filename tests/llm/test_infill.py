import hashlib
import random
import re

import pytest

from wattlane.llm.infill import FrameReader, fill_in_middle, frame_texts, output_texts, pieces_of, stream_digests

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_form(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("frame_bytes", [1 << 16, 40, 7, 1])
def test_forms_equal_plain_strings(spark, docs, texts, frame_bytes):
    odd = ["<P> a mark", "half <P marks <S and M> \n", " lead", "tail \t", "\x0b\x0c", "a b  c", "é" * 90, "𝄞 " * 60, "a <" * 30]
    rows = [*enumerate([*texts, *odd]), *((1000 + i, t) for i, t in enumerate(odd)), *((2000 + i, "x y <S\tz" * i) for i in range(40))]
    frame = spark.createDataFrame([(t, i, "f", [1]) for i, t in rows], "text string, doc_id long, form string, frames array<int>")
    filled = fill_in_middle(frame_texts(frame, frame_bytes=frame_bytes))
    got = {r.doc_id: r for r in stream_digests(filled).collect()}
    output = {r.doc_id: r.output for r in output_texts(filled).collect()}
    assert len(got) == len(rows)
    forms = set()
    for i, text in rows:
        n, form, p, m, out = plain_form(i, text)
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, output[i]) == (n, form, p, m, out)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        forms.add(form)
    assert forms == {"plain", "spm", "psm"}


def test_null_and_repeated_ids_and_empty_tables(spark, docs, no_docs):
    got = stream_digests(fill_in_middle(frame_texts(docs))).collect()
    assert len(got) == docs.count()
    row = next(r for r in got if r.doc_id is None)
    assert (row.n, row.form) == plain_form(None, "a row without a key and enough words")[:2]
    assert sum(r.doc_id == 3 for r in got) == 2
    assert stream_digests(fill_in_middle(frame_texts(no_docs))).collect() == []


def test_frames_are_read_from_any_place():
    import zstandard

    rng = random.Random(3)
    raw = " ".join("".join(rng.choices("abcé", k=rng.randint(1, 30))) for _ in range(300)).encode()
    frames, units, chars = pieces_of(raw, 64, zstandard.ZstdCompressor())
    assert units[-1] == 300 and chars[-1] == len(raw.decode()) and len(frames) > 20
    reader = FrameReader(frames, zstandard.ZstdDecompressor())
    for _ in range(200):
        a, b = sorted(rng.randint(0, len(raw)) for _ in range(2))
        assert b"".join(reader.read(a, b)) == raw[a:b]
        assert reader.find(raw[a : a + 5], a) == raw.find(raw[a : a + 5], a)
