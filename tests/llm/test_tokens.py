import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from wattlane.llm.packing import best_fit, improve, pack, token_pieces
from wattlane.llm.queries import tokenizer
from wattlane.llm.token_files import EliasFano, ShardReader, read_token_files, shard_image, token_images, write_token_files
from wattlane.llm.tokens import PieceEncoder
from wattlane.session import scratch_path

ODD = [" ", "\n", " \n", "  ", "a", "É", ".", "'s", "<|endoftext|>", "\t", "1", "\x01", "\xa0", "ı", "é", "ΑΣ", "\x1c", "日本", "İ", "ẞ"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_whole_text(name, texts):
    coder = PieceEncoder(tokenizer(name))
    rng = random.Random(2)
    some = [t for t in texts if t and len(t) < 10_000] + ["".join(rng.choices(ODD, k=rng.randint(0, 25))) for _ in range(1500)]
    for text, got in zip(some, coder.ids(some)):
        assert np.frombuffer(got, coder.dtype).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_unaltered_tokenizer(name):
    plain = Tokenizer.from_file(tokenizer(name))
    coder = PieceEncoder(tokenizer(name))
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>"]
    some = [f"a{x}{m}{x}b {m}{m} c" for m in marks for x in ("", " ", "\n", "\t")] + [*marks, "no mark in this one"]
    for text, got in zip(some, coder.ids(some), strict=True):
        assert np.frombuffer(got, coder.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_kept_once_in_the_caches():
    """Twice over, the caches are full and made anew after half as many texts."""
    coder = PieceEncoder(tokenizer("byte_bpe_50k.json"))
    text = "The cat, élan's end. cat élan, l'été 12 cats end\nnow it's"
    assert np.frombuffer(coder.ids([text])[0], coder.dtype).tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert {"cat", "élan", "end"} <= coder.inner.keys()
    assert not any(part.startswith(" ") for part in coder.parts)


def test_elias_fano_round_trip_and_single_offsets():
    rng = np.random.default_rng(1)
    for values in ([], [0], [7], [0, 0, 0], [5, 5, 9], np.cumsum(rng.integers(0, 3000, 1000)), np.cumsum(rng.integers(0, 2, 700)), [0, 1 << 40]):
        values = np.asarray(values, dtype=np.int64)
        got, end = EliasFano.unpack(memoryview(EliasFano.encode(values).pack()), 0)
        assert got.decode().tolist() == values.tolist()
        assert [got[i] for i in range(len(values))] == values.tolist()
    even = np.arange(0, 1_000_000, 100)
    assert len(EliasFano.encode(even).pack()) * 8 / len(even) < 10  # of 64 bits in a plain table


def test_shard_reads_one_document():
    parts = [np.array(x, "<u2").tobytes() for x in ([1, 2, 0], [0], [9, 9, 9, 0])]
    image, n = shard_image([None, -3, 8], parts, np.dtype("<u2"))
    shard = ShardReader(image)
    assert (n, len(shard), shard.keys()) == (8, 3, [None, -3, 8])
    assert shard.document(2).tolist() == [9, 9, 9, 0] and shard.document(1).tolist() == [0]


def test_token_files_round_trip(spark, docs, no_docs):
    path = scratch_path(spark, "test")
    write_token_files(docs, path, tokenizer("byte_bpe_50k.json"), shard_tokens=300)
    got = read_token_files(spark, path, with_ids=True).orderBy("start").collect()
    coder = PieceEncoder(tokenizer("byte_bpe_50k.json"))
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    at = 0
    for r, g in zip(rows, got, strict=True):
        ids = coder.tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert (g.doc_id, g.start, g.n_tokens, g.ids) == (r.doc_id, at, len(ids), ids)
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_images(docs, tokenizer("byte_bpe_50k.json"), shard_tokens=300).count() > 3
    empty = scratch_path(spark, "test")
    write_token_files(no_docs, empty, tokenizer("byte_bpe_50k.json"))
    assert read_token_files(spark, empty).count() == 0


def test_packing_keeps_every_piece_without_gaps(spark, docs, no_docs):
    rows = pack(docs, tokenizer("word_bpe_49k.json"), capacity=64).toPandas()
    coder = PieceEncoder(tokenizer("word_bpe_49k.json"))
    want = sum(len(coder.tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    assert rows.length.sum() == want and rows.length.max() <= 64
    for _, part in rows.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 64
    assert rows.sequence_id.nunique() <= -(-want // 64) + 2
    assert pack(no_docs, tokenizer("word_bpe_49k.json")).count() == 0


def test_equal_rows_spread_over_the_groups(spark):
    same = spark.createDataFrame([(None, "")] * 400, "doc_id long, text string")
    draws = [r.draw % 4 for r in token_pieces(same, tokenizer("word_bpe_49k.json"), 64).collect()]
    assert len(draws) == 400 and all(60 <= draws.count(k) <= 140 for k in range(4))


def test_local_search_beats_best_fit_where_it_can():
    rng = np.random.default_rng(5)
    better = 0
    for _ in range(60):
        lengths = rng.integers(10, 60, 40)
        first = best_fit(lengths, 100)
        last = improve(first, lengths, 100)
        assert sorted(i for b in last for i in b) == list(range(40))
        assert all(lengths[b].sum() <= 100 for b in last) and len(last) <= len(first)
        squares = [sum(int(lengths[b].sum()) ** 2 for b in bins) for bins in (first, last)]
        assert squares[1] >= squares[0]
        better += squares[1] > squares[0]
    assert better
