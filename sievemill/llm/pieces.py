"""Vectorised pre-tokenisation: the boundaries that two public split patterns set, found on arrays of code points.

Character classes come from ``unicodedata``. A text with an unassigned code point, where libraries of different Unicode
versions may differ, is reported so that its caller can hand it to the tokenizer library whole.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = 0, 1, 2, 3, 4
# The code points of the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_APOSTROPHE = ord("'")
_MULTIPLIER = 0x9E3779B97F4A7C15


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((UNKNOWN if (c := unicodedata.category(chr(i))) == "Cn" else kinds.get(c[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    table[WHITE_SPACE] = SPACE
    return table


@functools.cache
def _inverse() -> int:
    return pow(_MULTIPLIER, -1, 1 << 64)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _MULTIPLIER, np.uint64)
    down = np.full(n, _inverse(), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of the code points."""
    n = 1 << max(12, (len(codes) + 1).bit_length())
    up, down = _powers(n)
    mixed = (codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    mixed *= up[: len(codes)]
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed, out=prefix[1:])
    found = (prefix[ends] - prefix[starts]) * down[starts]
    return found ^ (found >> np.uint64(32)) ^ ((ends - starts).astype(np.uint64) << np.uint64(48))


def _runs(codes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = classes()[codes]
    start = np.zeros(len(codes) + 1, bool)
    start[1:-1] = kind[1:] != kind[:-1]
    start[heads] = True
    return kind, start


def _contractions(codes: np.ndarray, start: np.ndarray, heads: np.ndarray) -> None:
    """Cut 's 't 'm 'd 're 've 'll off what follows them."""
    at = np.flatnonzero((codes == _APOSTROPHE) & start[:-1])
    if not len(at):
        return
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    begins = np.zeros(len(padded), bool)
    begins[heads[heads < len(padded)]] = True
    one, two = padded[at + 1], padded[at + 2]
    fits = ~begins[at + 1]
    short = fits & np.isin(one, [ord(c) for c in "stmd"])
    long = fits & ~begins[at + 2] & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
    for which, k in ((short, 2), (long, 3)):
        i = at[which]
        start[i + 1] = False
        start[i + k] = True


def byte_level(codes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of the byte-level pattern: a run of letters, of numbers or of others with the one blank
    before it, contractions, and white space less its last character before a run. ``heads``: where texts begin."""
    kind, start = _runs(codes, heads)
    first = np.flatnonzero(start[:-1] & (kind != SPACE))
    head = np.zeros(len(codes) + 1, bool)
    head[heads] = True
    first = first[~head[first] & (first > 0)]
    first = first[kind[first - 1] == SPACE]
    start[first - 1] = True
    start[first[codes[first - 1] == 0x20]] = False
    _contractions(codes, start, heads)
    cuts = np.flatnonzero(start[:-1])
    return cuts, np.append(cuts[1:], len(codes))


def word_level(codes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of the word pattern: contractions, runs of letters, single numbers and runs of others;
    white space is dropped."""
    kind, start = _runs(codes, heads)
    start[:-1] |= kind == NUMBER
    _contractions(codes, start, heads)
    cuts = np.flatnonzero(start[:-1])
    ends = np.append(cuts[1:], len(codes))
    keep = kind[cuts] != SPACE
    return cuts[keep], ends[keep]


def safe_cuts(codes: np.ndarray, size: int) -> list[int]:
    """Places about ``size`` apart where a blank stands between two letters: both patterns begin a piece there."""
    cuts, at, letter = [], size, classes()
    while at < len(codes):
        window = codes[at : at + 65536]
        kind = letter[window]
        good = np.flatnonzero((window[1:-1] == 0x20) & (kind[:-2] == LETTER) & (kind[2:] == LETTER))
        if len(good):
            cuts.append(at + 1 + int(good[0]))
            at = cuts[-1] + size
        else:
            at += max(1, len(window) - 2)
    return cuts
