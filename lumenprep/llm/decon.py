"""Benchmark decontamination: a lossless q-gram filter, then exact edit verification of each window that passes.

A part of a text is an item, or nearly, if it has edit similarity 1 - distance / item length of at least `similarity`.
Windows are as long as their item. To start one at every character of 100 TB is out of reach and not needed: such a part
of an item of n characters keeps at least n - q + 1 - q * edits of its q-grams (edits = floor of (1 - similarity) n), on
diagonals that are at most `edits` apart, so windows start where that many q-gram occurrences of an item are. Each item
has the longest q up to Q for which the bound is at least ENOUGH (at 0.85 mostly 6). Windows that hold as many of the
item's 4-grams as must be left are verified: the part nearest to the item is found by bit-parallel columns. Nothing is
sampled, so every text with such a part is found; of parts that start within a quarter of an item the best counts.

The CGK embedding (cgk(), repetitions()) reads a string by a random walk; windows chosen by its keys missed some planted
passages and took more time than verifying all windows, so matches() has no use of it.

Texts and items are compared in small letters with every run of white space as one blank; spans are of the original text.

The benchmark is read in blocks of at most `block_chars` characters, a query set of stated size against all rows; each
block is one pass. Defined results: null texts and items are empty and match nothing; benchmark rows with a null item_id
are not searched for, as a match could not name them; an item shorter than Q that the threshold allows no edit must occur
exactly; repeated rows each have their matches; equal rows of the benchmark count once, and different texts under one
item_id are each searched for; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, code_points, hold, maybe_in, save, ship
from .edits import best_infix
from .shingles import U, mix

Q = 8
ENOUGH = 4
SALT = U(0x9E3779B97F4A7C15)


def repetitions(recall: float, agree: float, bits: int) -> int:
    """How many keys of `bits` sampled positions find a pair that agrees on a share `agree` with probability `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agree**bits))


_FOLD: dict[str, np.ndarray] = {}


def fold(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points in small letters, runs of white space as one blank; where each was): of many texts, joined by NUL."""
    if not _FOLD:
        low = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x110000):
            x = chr(c).lower()
            if len(x) == 1:
                low[c] = ord(x)
        low[[c for c in range(0x3001) if chr(c).isspace()]] = 32
        _FOLD["low"] = low
    low = _FOLD["low"][points]
    blank = low == 32
    blank[1:] &= blank[:-1]
    blank[:1] = False
    at = np.flatnonzero(~blank)
    return low[at], at


def normalise(text: str) -> str:
    return fold(code_points(text))[0].tobytes().decode("utf-32-le")


def grams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the q-gram at each position."""
    h = np.zeros(max(0, len(points) - q + 1), U)
    for k in range(q):
        h = h * U(0x9E3779B97F4A7C15) + points[k : k + len(h)] + U(1)
    return mix(h + U(q))


def gram_size(n: int, edits: int) -> tuple[int, int]:
    """(q, how many q-grams of n characters are left after so many edits): the longest q up to Q that leaves ENOUGH, or what leaves most."""
    left = [(q, n - q + 1 - q * edits) for q in range(min(Q, n), 0, -1)]
    return next((x for x in left if x[1] >= ENOUGH), max(left, key=lambda x: x[1]))


def cgk(strings: np.ndarray, lengths: np.ndarray, steps: int, walk: np.ndarray) -> np.ndarray:
    """uint32 (strings, steps): the embedding of each row of code points under its walk; 0 beyond its length."""
    place = np.zeros(len(strings), np.int64)
    out = np.zeros((steps, len(strings)), np.uint32)
    rows = np.arange(len(strings)) * strings.shape[1]
    flat, last, salt = strings.ravel(), strings.shape[1] - 1, mix(walk.astype(U) + U(1))
    for t in range(steps):
        inside = place < lengths
        if not inside.any():
            break
        c = flat[rows + np.minimum(place, last)] * inside
        out[t] = c
        place += inside & (((c + salt + U(t)) * SALT >> U(37)) & U(1)).astype(bool)
    return out.T


class Items:
    """What a task needs of one block of items."""

    def __init__(self, rows: list[tuple[int, str]], similarity: float):
        self.ids, self.texts = [r[0] for r in rows], [normalise(r[1] or "").strip() for r in rows]
        self.similarity = similarity
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        edits = np.floor((1 - similarity) * self.sizes + 1e-9).astype(np.int64)
        self.slack = np.maximum(1, edits)
        chosen = [gram_size(int(n), int(e)) if n >= Q or e else (Q, 1) for n, e in zip(self.sizes, edits, strict=True)]
        self.need = np.array([max(1, left) for _, left in chosen], np.int64)
        self.fours = [[t[k : k + 4] for k in range(len(t) - 3)] for t in self.texts]
        self.grams = []  # of each q: what _windows() takes
        for q in sorted({q for q, _ in chosen}):
            mine = [i for i, x in enumerate(chosen) if x[0] == q and self.sizes[i] >= q]
            if not mine:
                continue
            hashes = [grams(code_points(self.texts[i]), q) for i in mine]
            h, count = np.concatenate(hashes), [len(g) for g in hashes]
            order = np.argsort(h, kind="stable")
            bits_ = 21
            while bits_ < 27 and 64 * len(h) > 1 << bits_:
                bits_ += 1
            distinct, size = np.unique(h, return_counts=True)
            slots, at, run = np.unique(self._slot(distinct, bits_), return_index=True, return_counts=True)
            where = np.zeros(1 << bits_, np.int32)  # from a slot to its first gram, counted from 1
            where[slots] = at + 1
            # An occurrence as a number: its item, and what the place of a hit has to be added to for the diagonal.
            codes = (np.repeat(mine, count).astype(np.int64) * (1 << 40) + (1 << 20) - np.concatenate([np.arange(n) for n in count]))[order]
            self.grams.append((q, bits_, where, int(run.max()), distinct, np.cumsum(size) - size, size, codes))
        self.short = [i for i, n in enumerate(self.sizes) if 0 < n < Q and not edits[i]]

    @staticmethod
    def _slot(h: np.ndarray, bits: int) -> np.ndarray:
        return (h >> U(64 - bits)).astype(np.int64)

    def windows(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, first and last diagonal) of the windows with enough of an item's q-grams, over the code points of joined texts."""
        return [w for part in self.grams for w in self._windows(points, *part)]

    def _windows(self, points: np.ndarray, q: int, bits: int, where: np.ndarray, run: int, distinct: np.ndarray, first_of: np.ndarray, size: np.ndarray, codes: np.ndarray) -> list[tuple[int, int, int]]:
        h = grams(points, q)
        k = where[self._slot(h, bits)]
        at = np.flatnonzero(k)
        h, k = h[at], k[at] - 1
        found = np.where(distinct[k] == h, k, -1)
        for further in range(1, run):
            next_ = np.minimum(k + further, len(distinct) - 1)
            found = np.where(distinct[next_] == h, next_, found)
        at, k = at[found >= 0], found[found >= 0]
        n = size[k]
        which = np.repeat(first_of[k] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        joint = np.sort(codes[which] + np.repeat(at, n))
        item, start = joint >> 40, (joint & ((1 << 40) - 1)) - (1 << 20)
        # A hit with enough hits of its item whose diagonal is at most slack further: each edit moves it by one at most.
        far = np.arange(len(joint)) + self.need[item] - 1
        enough = np.flatnonzero(far < len(joint))
        enough = enough[joint[far[enough]] - joint[enough] <= self.slack[item[enough]]]
        until = np.searchsorted(joint, joint[enough] + self.slack[item[enough]], "right")
        if not len(enough):
            return []
        of, x, y = item[enough], start[enough], start[until - 1]
        # One window of those that start near its first; the diagonals of a part within the edits are all from x to y.
        reach = np.maximum(self.slack, self.sizes // 4)[of]
        first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (np.diff(x) > reach[1:])))
        last = np.append(first[1:], len(of)) - 1
        wide = x[last] - x[first] > reach[first]
        out = list(zip(of[first][~wide].tolist(), x[first][~wide].tolist(), np.maximum.reduceat(y, first)[~wide].tolist(), strict=True))
        for p, q in zip(first[wide].tolist(), last[wide].tolist(), strict=True):
            while p <= q:
                end = int(np.searchsorted(x[p : q + 1], x[p] + reach[p], "right")) + p
                out.append((int(of[p]), int(x[p]), int(y[p:end].max())))
                p = end
        return out

    def likely(self, i: int, part: str) -> bool:
        """Whether as many of the item's 4-grams are in the part as must be; loses nothing."""
        there = set(map("".join, zip(part, part[1:], part[2:], part[3:], strict=False)))
        return sum(map(there.__contains__, self.fours[i])) >= len(self.fours[i]) - 4 * int(self.slack[i])

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int, float]]:
        """(text, item, start, end, distance, similarity), spans in the original texts."""
        raw = code_points("\x00".join(texts) + "\x00")
        points, at = fold(raw)
        ends = np.flatnonzero(raw == 0) if raw.size - np.count_nonzero(raw) == len(texts) else np.cumsum([len(t) + 1 for t in texts]) - 1
        origin = np.concatenate([[0], ends[:-1] + 1])  # of each text in raw
        begin = np.concatenate([[0], np.searchsorted(at, ends) + 1])  # of each text in points
        text_of = lambda a, b: points[a:b].tobytes().decode("utf-32-le")
        found: dict[tuple[int, int, int], tuple] = {}

        def put(t: int, i: int, x: int, y: int, distance: int) -> None:
            found.setdefault((t, i, y), (t, i, int(at[x] - origin[t]), int(at[y - 1] + 1 - origin[t]), distance, 1 - distance / int(self.sizes[i])))

        if windows := self.windows(points):
            item, first, last = np.array(windows, np.int64).T
            size, slack = self.sizes[item], self.slack[item]
            # Every text that the window, as far as its item can reach, has a part in.
            a, b = np.maximum(first - 2 * slack, 0), np.minimum(last + size + 2 * slack, len(points))
            for k in range(len(item)):
                i = int(item[k])
                for t in range(int(np.searchsorted(begin, a[k], "right")) - 1, int(np.searchsorted(begin, b[k], "left"))):
                    if t >= len(texts):
                        break
                    x, y = max(int(a[k]), int(begin[t])), min(int(b[k]), int(begin[t + 1]) - 1)
                    if y - x < size[k] - slack[k] or not self.likely(i, part := text_of(x, y)):
                        continue
                    distance, start, end = best_infix(self.texts[i], part)
                    if end > start and 1 - distance / int(size[k]) >= self.similarity - 1e-12:
                        put(t, i, x + start, x + end, distance)
        for i in self.short:
            for t in range(len(texts)):
                text = text_of(begin[t], begin[t + 1] - 1)
                x = text.find(self.texts[i])
                while x >= 0:
                    put(t, i, int(begin[t]) + x, int(begin[t]) + x + len(self.texts[i]), 0)
                    x = text.find(self.texts[i], x + 1)
        return sorted(found.values())


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.85, block_chars: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, char_start, char_end, distance, similarity: each part of a text that is an item, or nearly."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL AND item_id IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, char_start int, char_end int, distance int, similarity double"
    out = None
    for block in range(blocks):
        # About block_chars characters: bounded, whatever the benchmark's size.
        rows = [(r["item_id"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct().orderBy("item_id", "text").collect()]
        if not rows:
            continue
        held = spark.sparkContext.broadcast(Items(rows, similarity))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            hold(__name__)
            block_items = held.value
            for batch in batches:
                for a, b, texts in chunks(batch, "text", 1 << 18):
                    if found := block_items.matches(texts):
                        ids = batch.column(0).slice(a, b - a)
                        t, i, x, y, d, s = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(t)), pa.array([block_items.ids[k] for k in i]), pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(d, pa.int32()), pa.array(s, pa.float64())],
                            names=["doc_id", "item_id", "char_start", "char_end", "distance", "similarity"],
                        )

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.85) -> DataFrame:
    """docs without the rows whose text holds a benchmark item."""
    row = F.struct("doc_id", F.xxhash64("text").alias("text"))
    marked = docs.withColumn("__row", row)
    hit = save(matches(marked.select(F.col("__row").alias("doc_id"), "text"), benchmark, similarity).select(F.col("doc_id").alias("__row")).distinct(), "contaminated")
    some = maybe_in(marked, F.col("__row"), hit)
    return some.filter("__maybe").join(hit, "__row", "left_anti").select(*docs.columns).unionByName(some.filter("NOT __maybe").select(*docs.columns))
