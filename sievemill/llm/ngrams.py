"""Character n-grams of the words of a batch of texts, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from . import pieces

_SPACE = 0x20
_BASE = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def cut(text: str, size: int) -> Iterator[str]:
    """Pieces of at least ``size`` characters of a text, none of which ends within a word."""
    kind, at = pieces.classes(), 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and kind[ord(text[end])] in (pieces.LETTER, pieces.NUMBER):
            end += 1
        yield text[at:end]
        at = end


class Words:
    """The lower-cased words of some texts: runs of letters (and numbers), each between single blanks."""

    def __init__(self, texts: list[str], numbers: bool = False):
        lower = [t.lower() for t in texts]
        codes = np.frombuffer("\n".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = pieces.classes()[codes]
        inside = kind == pieces.LETTER
        if numbers:
            inside |= kind == pieces.NUMBER
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        self.codes = np.concatenate([[_SPACE], np.where(inside, codes, _SPACE)[keep], [_SPACE]]).astype(np.uint32)
        blank = self.codes == _SPACE
        if len(self.codes) > 1 and blank[-2]:
            self.codes, blank = self.codes[:-1], blank[:-1]
        self._blanks = np.cumsum(blank)
        begins = np.flatnonzero(keep & inside & ~np.concatenate([[False], inside[:-1]]))
        heads = np.cumsum([0, *(len(t) + 1 for t in lower)])
        #: words before each text, and before the end
        self.bounds = np.searchsorted(begins, heads)
        self.count = len(begins)

    def hashes(self) -> np.ndarray:
        """A hash of each word."""
        blanks = np.flatnonzero(self.codes == _SPACE)
        return pieces.hashes(self.codes, blanks[:-1] + 1, blanks[1:]) if self.count else np.zeros(0, np.uint64)

    def first_of_each(self) -> np.ndarray:
        """Whether a word is the first of its kind in its text."""
        first = np.zeros(self.count, bool)
        doc = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds)).astype(np.uint64)
        first[np.unique(self.hashes() ^ doc * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]] = True
        return first

    def grams(self, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and word of each n-gram that lies within a word and its two blanks."""
        m = len(self.codes) - n + 1
        if m <= 0 or not self.count:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        at = np.flatnonzero(self._blanks[n - 2 : n - 2 + m] == self._blanks[:m])
        h = np.full(len(at), n, np.uint32)
        for k in range(n):
            h = h * _BASE ^ self.codes[at + k]
        h *= _MIX
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        return h >> np.uint32(32 - bits), self._blanks[at + 1] - 1
