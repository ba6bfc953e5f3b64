"""Byte-level BPE: boundaries by an associative scan of transition functions, slices by cached pair merging.

Pre-tokenisation uses no regular expression. Every code point gets a class (letter, number, other, space, other white
space, and apostrophes that open a contraction). Each class is a function on the states of a small automaton; functions
compose, composition is associative, and the closed set of composed functions is a small table. A blocked prefix scan over
that table gives the state before every character of a whole batch at once; a boundary is then a table look-up.

Defined results: null text is encoded as empty (no ids); an empty text gives no ids; texts of any length are whole;
repeated rows are each encoded; an empty table gives an empty one; columns other than `keep` are ignored, so clashing
names cannot occur (a kept column may not be called like an output column: ValueError).
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import CACHES, chunks, code_points, hold, ship

DEFAULT_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Symbols: what a character does to the automaton.
LETTER, NUMBER, OTHER, SPACE, WHITE, SHORT, LONG = range(7)
FIRST = 7  # added to the symbol of a text's first character
# States: what the text up to here has left open.
START, IN_L, IN_N, IN_O, AT_SP, AT_W, WANT1, WANT2, CLOSED = range(9)
STATES = 9


def _step(state: int, symbol: int) -> int:
    if symbol >= FIRST:
        state, symbol = START, symbol - FIRST
    if symbol == LETTER:
        return {WANT2: WANT1, WANT1: CLOSED}.get(state, IN_L)
    if symbol in (SHORT, LONG):  # an apostrophe opens a contraction only where a token starts
        return IN_O if state in (IN_O, AT_SP) else (WANT1 if symbol == SHORT else WANT2)
    return {NUMBER: IN_N, OTHER: IN_O, SPACE: AT_SP, WHITE: AT_W}[symbol]


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, element after composing a then b at a*M+b, state after element e from s at e*STATES+s)."""
    maps = {tuple(_step(s, k) for s in range(STATES)): None for k in range(2 * FIRST)}
    known = list(maps)
    index = {m: i for i, m in enumerate(known)}
    generators = list(known)
    for m in known:  # grows while it is read: the closure
        for g in generators:
            new = tuple(g[x] for x in m)
            if new not in index:
                index[new] = len(known)
                known.append(new)
    size = len(known)
    compose = np.empty(size * size, np.uint16)
    for a, m in enumerate(known):
        for b, g in enumerate(known):
            compose[a * size + b] = index[tuple(g[x] for x in m)]
    of = np.array([index[tuple(_step(s, k) for s in range(STATES))] for k in range(2 * FIRST)], np.uint16)
    return of, compose, np.array(known, np.uint8).ravel()


def _boundary_table() -> np.ndarray:
    """Whether a token starts before a character, at (state before, symbol, whether a character that isn't white follows)."""
    out = np.zeros((STATES, 2 * FIRST, 2), bool)
    out[:, FIRST:, :] = True
    for s in range(STATES):
        for k in range(FIRST):
            for follows in (0, 1):
                if k in (SPACE, WHITE):
                    out[s, k, follows] = bool(follows) if s in (AT_SP, AT_W) else True
                elif s == AT_SP:
                    out[s, k, follows] = False
                elif k == LETTER:
                    out[s, k, follows] = s not in (IN_L, WANT1, WANT2)
                else:
                    out[s, k, follows] = s != (IN_N if k == NUMBER else IN_O)
    return out.ravel()


_TABLES: dict = {}


def _tables() -> dict:
    if not _TABLES:
        kinds = {"L": LETTER, "N": NUMBER}
        classes = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
        # Unicode's White_Space property.
        classes[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
        classes[0x20] = SPACE
        of, compose, apply = _monoid()
        _TABLES.update(classes=classes, of=of, compose=compose, apply=apply, size=int(len(compose) ** 0.5), boundary=_boundary_table())
    return _TABLES


def _scan(elements: np.ndarray, block: int = 256) -> np.ndarray:
    """Inclusive prefix composition, in blocks: each step composes one position of all blocks, then the blocks' ends are scanned alike."""
    t = _tables()
    compose, size, n = t["compose"], t["size"], len(elements)
    if n <= block:
        out = elements.astype(np.uint16)
        for i in range(1, n):
            out[i] = compose[int(out[i - 1]) * size + int(elements[i])]
        return out
    wide = -(-n // block)
    grid = np.resize(elements, wide * block)
    grid[n:] = elements[-1]
    grid = np.ascontiguousarray(grid.reshape(wide, block).T)
    for k in range(1, block):
        np.take(compose, grid[k - 1].astype(np.int32) * size + grid[k], out=grid[k])
    before = _scan(grid[-1], block)[:-1]
    grid[:, 1:] = np.take(compose, before.astype(np.int32)[None, :] * size + grid[:, 1:])
    return np.ascontiguousarray(grid.T).ravel()[:n]


def boundaries(text: str, starts: np.ndarray) -> np.ndarray:
    """Positions in `text` where a pre-token starts; starts: where each of the texts joined in it begins (none is empty)."""
    if not text:
        return np.empty(0, np.int64)
    t = _tables()
    points = code_points(text)
    symbols = t["classes"][points]
    first = np.zeros(len(points) + 1, bool)
    first[starts] = True
    first[-1] = True
    at = np.flatnonzero(points == 0x27)
    if len(at):
        padded = np.concatenate([points, np.zeros(2, np.uint32)])
        one, two = padded[at + 1], padded[at + 2]
        inside = ~first[at + 1]
        symbols[at[inside & np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        symbols[at[inside & ~first[np.minimum(at + 2, len(points))] & pair]] = LONG
    follows = np.zeros(len(points), np.uint8)
    follows[:-1] = ~((symbols[1:] == SPACE) | (symbols[1:] == WHITE)) & ~first[1:-1]
    symbols = symbols + FIRST * first[:-1].astype(np.uint8)
    after = t["apply"][_scan(t["of"][symbols]).astype(np.int32) * STATES]  # from START, which the first symbol ignores
    before = np.concatenate([[START], after[:-1]]).astype(np.int32)
    return np.flatnonzero(t["boundary"][(before * (2 * FIRST) + symbols) * 2 + follows])


NONE = 1 << 60


def byte_pairs(ranks: dict[bytes, int]) -> list[list[int]]:
    """The rank of each pair of bytes, by its first and its second byte."""
    return [[ranks.get(bytes((a, b)), NONE) for b in range(256)] for a in range(256)]


def merge(piece: bytes, ranks: dict[bytes, int], first: list[list[int]] | None = None) -> list[int]:
    """The ids of one slice: the pair of least rank (leftmost of equals) merges first. Long slices take a heap: n log n.
    first: byte_pairs() of the ranks, which saves asking for each pair of bytes."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    if n <= 64:
        cut = list(range(n + 1))
        pairs = [first[a][b] for a, b in zip(piece, piece[1:])] if first else [ranks.get(piece[i : i + 2], NONE) for i in range(n - 1)]
        while pairs and (least := min(pairs)) != NONE:
            i = pairs.index(least)
            del cut[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(piece[cut[i] : cut[i + 2]], NONE)
            if i:
                pairs[i - 1] = ranks.get(piece[cut[i - 1] : cut[i + 1]], NONE)
        return [ranks[piece[a:b]] for a, b in zip(cut, cut[1:], strict=False)]
    ends, prev, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if ends[i] else n
        if not ends[i] or j >= n or ends[j] != end:
            continue  # one of the pair has merged meanwhile
        ends[i], ends[j] = end, 0
        after[i] = after[j]
        if after[i] < n:
            prev[after[i]] = i
            if (r := ranks.get(piece[i : ends[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, ends[after[i]]))
        if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:end])) is not None:
            heapq.heappush(heap, (r, p, end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = after[i]
    return out


class Encoder(dict):
    """From a slice to its ids as packed int32. Two generations of at most `most` slices: a full one becomes the old one,
    and what is asked for again comes back from there, so that frequent slices stay."""

    def __init__(self, ranks: dict[bytes, int], most: int = 120_000):
        super().__init__()
        self.ranks, self.most = ranks, most
        self.old: dict[str, bytes] = {}
        self.first = byte_pairs(ranks)
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = np.zeros(max(self.bytes_of) + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.length[i] = len(b)

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            out = array("i", merge(piece.encode(), self.ranks, self.first)).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids of each slice, first character of each slice in its text, slices of each text)."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        text_starts = np.cumsum(lengths) - lengths
        joined = "".join(texts)
        starts = boundaries(joined, text_starts[lengths > 0])
        ends = np.append(starts[1:], len(joined))
        packed = list(map(self.__getitem__, map(joined.__getitem__, map(slice, starts.tolist(), ends.tolist()))))
        counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        of = np.searchsorted(text_starts + lengths, starts, side="right")
        return np.frombuffer(b"".join(packed), np.int32), counts, starts - text_starts[of], np.bincount(of, minlength=len(texts))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_ENCODERS: dict[str, Encoder] = {}
CACHES[__name__] = _ENCODERS


def encoder(path: str = DEFAULT_RANKS) -> Encoder:
    """One a process. The file of ranks belongs to the installation of every machine, as the library that reads it does."""
    if path not in _ENCODERS:
        with open(path, "rb") as f:
            _ENCODERS[path] = Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    return _ENCODERS[path]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values.astype(np.int32, copy=False)))


def encode(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ranks: str = DEFAULT_RANKS, offsets: bool = True, decoded: str | None = None) -> DataFrame:
    """Per row: `keep`, ids array<int>; with offsets piece_starts array<int> (first character of each slice) and piece_tokens
    array<int> (its number of ids); with `decoded` a binary column so called, the bytes of the ids just as decode() gives them."""
    names = ("ids", *(("piece_starts", "piece_tokens") if offsets else ()), *((decoded,) if decoded else ()))
    if set(names) & set(keep):
        raise ValueError(f"a kept column is called like one of {names}")
    ship(df.sparkSession)
    source = df.select(*keep, df[text].alias("__text"))
    kinds = [T.BinaryType() if n == decoded else T.ArrayType(T.IntegerType()) for n in names]
    schema = T.StructType([*source.schema.fields[:-1], *map(T.StructField, names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        enc = encoder(ranks)
        for batch in batches:
            for a, b, texts in chunks(batch, "__text", 1 << 18):
                ids, counts, starts, pieces = enc.encode(texts)
                ends = np.cumsum(pieces)
                sums = np.concatenate([[0], np.cumsum(counts)])
                per_text = sums[ends] - sums[ends - pieces]
                out = [_lists(ids, per_text)]
                if offsets:
                    out += [_lists(starts, pieces), _lists(counts, pieces)]
                if decoded:
                    last = np.cumsum(per_text).tolist()
                    out.append(pa.array([enc.decode(ids[y - n : y].tolist()) for y, n in zip(last, per_text.tolist(), strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], *out], names=[*keep, *names])

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """df with `out` binary in place of `ids` and piece offsets: the bytes of the ids (null ids: null; an unknown id fails the job)."""
    ship(df.sparkSession)
    others = [c for c in df.columns if c not in (ids, out)]
    source = df.select(*others, ids)
    schema = T.StructType([*source.schema.fields, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        enc = encoder(ranks)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            if batch.num_rows == 0:
                continue
            values = column.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).tolist()
            there = column.is_valid().to_pylist()
            rows = [enc.decode(values[offsets[i] : offsets[i + 1]].tolist()) if there[i] else None for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.binary())], names=[*batch.schema.names, out])

    return source.mapInArrow(run, schema)


def spans(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ranks: str = DEFAULT_RANKS) -> DataFrame:
    """Per row: `keep`, token_starts and token_ends array<int>: the characters that each token touches (end exclusive)."""
    ship(df.sparkSession)
    source = df.select(*keep, df[text].alias("__text"))
    names = ("token_starts", "token_ends")
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        enc = encoder(ranks)
        for batch in batches:
            for a, b, texts in chunks(batch, "__text", 1 << 18):
                starts, ends, sizes = token_spans(enc, texts)
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], _lists(starts, sizes), _lists(ends, sizes)], names=[*keep, *names])

    return source.mapInArrow(run, schema)


def token_spans(enc: Encoder, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first character, end character, tokens of each text); a token of part of a character's bytes touches that character."""
    ids, counts, _, pieces = enc.encode(texts)
    ends = np.cumsum(pieces)
    sums = np.concatenate([[0], np.cumsum(counts)])
    sizes = sums[ends] - sums[ends - pieces]
    points = code_points("".join(texts))
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    char_of = np.repeat(np.arange(len(points)), width)  # of each byte
    length = enc.length[ids]
    last = np.cumsum(length)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.repeat(np.cumsum(lengths) - lengths, sizes)
    if not len(ids):
        return np.empty(0, np.int64), np.empty(0, np.int64), sizes
    return char_of[last - length] - base, char_of[last - 1] + 1 - base, sizes
