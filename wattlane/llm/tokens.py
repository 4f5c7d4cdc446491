"""Token ids of whole texts through a public tokenizer file, with a cache of pieces.

A byte-level tokenizer splits a text before every white space that follows something else, and
the word tokenizer drops white space, so a text's ids are those of its blank-separated pieces
joined together. Pieces repeat; each is encoded once for each cache.
Pieces beyond the Latin blocks, texts with white space other than blanks and line ends, texts that
hold an added token such as ``<|endoftext|>`` literally, and other kinds of tokenizer take the tokenizer's whole path.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import regex

_PIECE = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]")
_OTHER_ASCII = tuple(map(chr, [9, 11, 12, 13, 28, 29, 30, 31]))
_OTHER_WIDE = tuple(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
CACHE_PIECES = 1_000_000
_LATIN_END = "\u0250"

# The split of the byte-level tokenizers, and the characters that stand for bytes.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BLANK = chr(256 + 32)
_BYTES = {b: b if b in _SHOWN else 256 + sum(x not in _SHOWN for x in range(b)) for b in range(256)}


def _other_space(text: str) -> bool:
    return any(c in text for c in _OTHER_ASCII) or not text.isascii() and any(c in text for c in _OTHER_WIDE)


class _Cache(dict):
    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make = make

    def __missing__(self, key: str) -> bytes:
        self[key] = out = self.make(key)
        return out


class PieceEncoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        with open(path, encoding="utf-8") as f:
            head = json.load(f)
        kinds = [n["type"] for n in (head["normalizer"] or {}).get("normalizers", [])]
        before = head["pre_tokenizer"] or {}
        self.kind = "whole"
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = tuple(t.content for t in added)
        if any(t.normalized for t in added):
            pass  # These are found in the normalized text, which pieces do not show.
        elif before.get("type") == "ByteLevel" and before["use_regex"] and not head["normalizer"]:
            self.kind = "byte"
            self.split = regex.compile(BYTE_LEVEL_SPLIT).findall
        elif kinds == ["NFC", "Replace", "Lowercase"] and head["model"].get("end_of_word_suffix") == "</w>":
            self.kind = "word"
            self.split = regex.compile(before["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.model = self.tokenizer.model
        self.parts = _Cache(self._part)
        self.inner = _Cache(self._inner)
        self.first = _Cache(self._whole)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():
            mapped = part.replace(" ", _BLANK)
        else:
            mapped = part.encode().decode("latin-1").translate(_BYTES)
        return array("I" if self.dtype.itemsize == 4 else "H", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _inner(self, piece: str) -> bytes:
        """Ids of a piece that follows a blank (or, for the word kind, of any)."""
        if not piece.isascii() and max(piece) >= _LATIN_END:
            return self._whole(" " + piece if self.kind == "byte" else piece)
        if self.kind == "byte":
            if piece.isalpha():
                return self._part(" " + piece)
            # Letters before a mark are mostly a piece elsewhere, so each part is kept once.
            head, *rest = self.split(" " + piece)
            return b"".join([self.inner[head[1:]], *map(self.parts.__getitem__, rest)]) if rest else self._part(head)
        text = piece.lower() if piece.isascii() else self.tokenizer.normalizer.normalize_str(piece)
        return b"".join(map(self.parts.__getitem__, self.split(text)))

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``dtype``."""
        if self.kind == "whole":
            return [self._whole(t) for t in texts]
        out = []
        look, first = self.inner.__getitem__, self.first.__getitem__
        if len(self.inner) + len(self.first) + len(self.parts) > CACHE_PIECES:
            for cache in (self.inner, self.first, self.parts):
                cache.clear()
        for text in texts:
            if _other_space(text) or any(token in text for token in self.added):
                out.append(self._whole(text))
            elif self.kind == "word":
                out.append(b"".join(map(look, text.replace("\n", " ").split(" "))))
            elif "  " in text or "\n " in text or " \n" in text:
                out.append(b"".join(map(first, _PIECE.findall(text))))
            else:
                head, *rest = text.split(" ")
                out.append(first(head) + b"".join(map(look, rest)))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each file and worker process."""
    return PieceEncoder(path)
