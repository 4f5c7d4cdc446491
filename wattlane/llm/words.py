"""Word hashes of whole texts, computed over byte arrays.

A word is a longest run of ASCII letters and digits and of non-ASCII characters, in lower case. Every
word gets a 64-bit hash; n-grams get the mixed hash of their words. Memory follows a slice of
about a megabyte of text, plus eight bytes for each word.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BLOCK = 1 << 19

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_IS_WORD[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.full(n, _BASE, dtype=np.uint64)
    step[0] = 1
    back = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64)
    back[0] = 1
    return np.multiply.accumulate(step), np.multiply.accumulate(back)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 2 * _BLOCK
    while size < n:
        size *= 2
    return _powers(size)


def is_word(flat: np.ndarray) -> np.ndarray:
    """Which bytes are of words."""
    return _IS_WORD[flat]


def word_starts(flat: np.ndarray) -> np.ndarray:
    """Where words start in an array of bytes."""
    return np.flatnonzero(np.diff(_IS_WORD[flat].view(np.int8), prepend=0) == 1)


class Words:
    """Words of a list of texts: ``hash``, byte ``start`` and ``end`` and the ``first`` word of each text."""

    def __init__(self, texts: Sequence[str], prefixes: Sequence[int] = ()) -> None:
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter((len(b) + 1 for b in raw), dtype=np.int64, count=len(raw))
        self.text_start = np.concatenate([[0], np.cumsum(sizes)])
        self.bytes = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
        inside = _IS_WORD[self.bytes]
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, self.text_start)
        self.hash = np.empty(len(self.start), dtype=np.uint64)
        self.prefix = {k: np.empty(len(self.start), dtype=np.uint64) for k in prefixes}
        a = 0
        while a < len(self.start):
            low = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, low + _BLOCK, side="right")))
            self._hash_block(a, b)
            a = b

    def _hash_block(self, a: int, b: int) -> None:
        low, high = int(self.start[a]), int(self.end[b - 1])
        power, back = _power_tables(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((self.bytes[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        s, e = self.start[a:b] - low, self.end[a:b] - low
        shift = back[s]
        self.hash[a:b] = mix((sums[e] - sums[s]) * shift + (e - s).astype(np.uint64))
        for k, out in self.prefix.items():
            cut = np.minimum(e, s + k)
            out[a:b] = mix((sums[cut] - sums[s]) * shift + np.uint64(1000 + k))

    @property
    def doc(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words, the text of each, and its first word's position.

        With ``short``, a text of one to n-1 words gives one hash of all its words, as ``grams`` of that size does.
        """
        count = np.diff(self.first)
        runs = np.maximum(count - n + 1, 0)
        doc = np.repeat(np.arange(len(count)), runs)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + self.first[:-1][doc]
        total = np.full(len(at), np.uint64(n))
        for k in range(n):
            total = total * np.uint64(0x9FB21C651E98DF25) + self.hash[at + k]
        total = mix(total)
        if short and (few := np.flatnonzero((count > 0) & (count < n))).size:
            extra = np.empty(len(few), dtype=np.uint64)
            for i, d in enumerate(few):
                h = np.uint64(count[d])
                with np.errstate(over="ignore"):
                    for w in self.hash[self.first[d] : self.first[d + 1]]:
                        h = h * np.uint64(0x9FB21C651E98DF25) + w
                extra[i] = h
            total = np.concatenate([total, mix(extra)])
            doc, at = np.concatenate([doc, few]), np.concatenate([at, self.first[:-1][few]])
            order = np.argsort(doc, kind="stable")
            total, doc, at = total[order], doc[order], at[order]
        return total, doc, at
