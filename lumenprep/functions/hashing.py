"""64-bit perceptual hashes of grey images and SimHashes of words (numpy), Hamming distance (built-in)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def shrink(grey: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each cell of a height x width grid (area resampling)."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.linspace(0, n, m + 1)
        at = np.arange(n)
        return np.clip(np.minimum(edges[1:, None], at + 1) - np.maximum(edges[:-1, None], at), 0, 1) / (n / m)

    return weights(grey.shape[0], height) @ grey.astype(float) @ weights(grey.shape[1], width).T


def pack(bits: np.ndarray) -> int:
    """64 booleans as a signed 64-bit number, the first the highest."""
    return int(np.packbits(bits.ravel()).view(">i8")[0])


def average_hash(grey: np.ndarray) -> int:
    small = shrink(grey, 8, 8)
    return pack(small > small.mean())


def difference_hash(grey: np.ndarray) -> int:
    small = shrink(grey, 8, 9)
    return pack(small[:, 1:] > small[:, :-1])


def perceptual_hash(grey: np.ndarray) -> int:
    """The low 8 x 8 coefficients of a 32 x 32 cosine transform against their median."""
    n = 32
    k = np.arange(n)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    low = (basis @ shrink(grey, n, n) @ basis.T)[:8, :8]
    return pack(low > np.median(low))


def wavelet_hash(grey: np.ndarray) -> int:
    """The 8 x 8 Haar approximation without its constant part, against its median."""
    small = shrink(grey, 64, 64) / 255
    while len(small) > 8:
        small = (small[::2, ::2] + small[1::2, ::2] + small[::2, 1::2] + small[1::2, 1::2]) / 2
    small = small - small.mean()
    return pack(small > np.median(small))


def edge_fraction(grey: np.ndarray, low: float = 50, high: float = 150) -> float:
    """Share of edge pixels: Sobel gradient, thinned along its direction, strong edges and the weak ones that touch them."""
    p = np.pad(grey.astype(float), 1, mode="edge")
    gx = p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:] - p[:-2, :-2] - 2 * p[1:-1, :-2] - p[2:, :-2]
    gy = p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:] - p[:-2, :-2] - 2 * p[:-2, 1:-1] - p[:-2, 2:]
    size = np.abs(gx) + np.abs(gy)
    q = np.pad(size, 1)
    h, w = size.shape
    turn = np.round(np.arctan2(gy, gx) / (np.pi / 4)).astype(int) % 4
    keep = np.zeros_like(size, bool)
    for d, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        ahead, behind = q[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w], q[1 - dy : 1 - dy + h, 1 - dx : 1 - dx + w]
        keep |= (turn == d) & (size > behind) & (size >= ahead)
    weak, strong = keep & (size > low), keep & (size > high)
    while True:
        s = np.pad(strong, 1)
        grown = weak & np.any([s[i : i + h, j : j + w] for i in range(3) for j in range(3)], axis=0)
        if (grown == strong).all():
            return float(strong.mean()) if strong.size else 0.0
        strong = grown


def corner_edges(grey: np.ndarray) -> list[float]:
    """Edge share of the four corner squares of side min(height, width) // 4."""
    n = min(grey.shape) // 4
    if not n:
        return []
    return [edge_fraction(c) for c in (grey[:n, :n], grey[:n, -n:], grey[-n:, :n], grey[-n:, -n:])]


def simhashes(texts: list[str | None], salts: tuple[str, ...]) -> Iterator[np.ndarray | None]:
    """For each text its 64-bit SimHashes of the words between blanks and line breaks, one for each salt that goes before a
    word's md5; None without a word."""
    digests: dict[str, bytes] = {}
    before = [md5(s.encode()) for s in salts]

    def digest(w: str) -> bytes:
        found = digests.get(w)
        if found is None:
            if len(digests) >= 1 << 17:
                digests.clear()
            parts = []
            for b in before:
                m = b.copy()
                m.update(w.encode())
                parts.append(m.digest()[:8])
            found = digests[w] = b"".join(parts)
        return found

    for text in texts:
        counts = Counter((text or "").replace("\n", " ").split(" "))
        del counts[""]
        if not counts:
            yield None
            continue
        # A bit is set where more of the words (with their counts) have it than not.
        words, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
        ones = np.zeros(64 * len(salts), np.int64)
        for i in range(0, len(words), 1 << 14):
            bits = np.unpackbits(np.frombuffer(b"".join(map(digest, words[i : i + (1 << 14)])), np.uint8).reshape(-1, 8 * len(salts)), axis=1)
            ones += bits.sum(0, dtype=np.int64)
            again = np.flatnonzero(n[i : i + (1 << 14)] > 1)
            ones += (n[i + again] - 1) @ bits[again]
        yield np.packbits(2 * ones > n.sum()).view(">i8").astype(np.int64)
