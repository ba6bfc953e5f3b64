"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import unicodedata

import numpy as np

from .common import code_points

U = np.uint64
_LOW = np.empty(0, np.uint32)


def _low() -> np.ndarray:
    """From a code point to its small letter or digit, 0 for what is part of no word. One a process."""
    global _LOW
    if not len(_LOW):
        table = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if unicodedata.category(chr(c))[0] in "LNM":
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LOW = table
    return _LOW


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits with full avalanche (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text); words are runs of letters, marks and digits, in small letters."""
    return sized_words(texts)[::2]


def sized_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its characters, words of each text)."""
    low = _low()[code_points("\x00".join(texts) + "\x00")]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    inside = low > 0
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.empty(0, U), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    sizes = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    power = np.cumprod(np.concatenate([[U(1)], np.full(int(sizes.max()), U(0x100000001B3 * 2 + 1), U)]))
    hashed = mix(np.add.reduceat((low[at].astype(U) + U(0x9E37)) * power[place], first) + sizes.astype(U))
    of = np.searchsorted(np.cumsum(lengths), starts, side="right")
    return hashed, sizes, np.bincount(of, minlength=len(texts))


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, text) of each distinct shingle of each text, by text, then hash; fewer words than `size` are one shingle."""
    hashed, counts = words(texts)
    n = len(hashed)
    ends = np.cumsum(counts)
    begin = ends - counts
    of = np.repeat(np.arange(len(texts)), counts)
    total = np.zeros(n, U)
    for k in range(size):
        part = np.zeros(n, U)
        part[: max(0, n - k)] = hashed[k:] * U(2 * (0x51ED270B + 0x1000193 * k) + 1)
        inside = np.arange(n) + k < ends[of] if n else np.zeros(0, bool)
        total = mix(total + np.where(inside, part + U(k + 1), U(0)))
    keep = (np.arange(n) + size <= ends[of]) | (np.arange(n) == begin[of]) & (counts[of] < size) if n else np.zeros(0, bool)
    h, t = total[keep], of[keep]
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])) if len(h) else np.empty(0, np.int64)
    return h[new], np.diff(np.append(new, len(h))), t[new]
