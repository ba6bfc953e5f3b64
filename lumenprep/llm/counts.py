"""Token counts by offset-mapped attribution: a whole document is encoded once, tokens go to its sections by their spans.

Sections are non-overlapping character intervals in order (lines, fields of a record, or what a function returns). Token
spans and sections are both sorted, so their interval join is a merge. A token that lies in several sections, or partly in
none, goes by `rule`: "start" (the section of its first character), "end" (of its last), "majority" (of most of its
characters; of equals the first), "fraction" (to each in proportion to its characters). What lies in no section is
section -1. A token that is part of a character's bytes counts as that character.

Defined results: a null or empty text has one section 0 of no tokens with lines_of (others: what the function gives for
""); repeated rows are each counted; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import DEFAULT_RANKS, encoder, token_spans
from .common import chunks, ship

RULES = ("start", "end", "majority", "fraction")


def lines_of(text: str) -> list[tuple[int, int]]:
    """Lines with their line feed; the last one may be empty only if it is the only one."""
    out, at = [], 0
    while (end := text.find("\n", at)) >= 0:
        out.append((at, end + 1))
        at = end + 1
    if at < len(text) or not out:
        out.append((at, len(text)))
    return out


def allocate(starts: np.ndarray, ends: np.ndarray, sections: list[tuple[int, int]], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of each section and, last, of none; tokens of each that cross its bounds) for the token spans of one text."""
    n = len(sections)
    lo = np.array([a for a, _ in sections], np.int64)
    hi = np.array([b for _, b in sections], np.int64)

    def of(position: np.ndarray) -> np.ndarray:
        if not n:
            return np.full(len(position), -1)
        i = np.searchsorted(hi, position, "right")  # the first section that ends after it
        i = np.minimum(i, n - 1)
        return np.where((lo[i] <= position) & (position < hi[i]), i, -1)

    first, last = of(starts), of(ends - 1)
    crossing = (first != last) | ((first == -1) & (ends - starts > 1))
    counts, across = np.zeros(n + 1), np.zeros(n + 1)
    plain = ~crossing
    np.add.at(counts, first[plain], 1)
    for k in np.flatnonzero(crossing).tolist():
        where = of(np.arange(starts[k], ends[k]))
        parts, sizes = np.unique(where, return_counts=True)
        crosses = len(parts) > 1
        if rule == "fraction":
            counts[parts] += sizes / sizes.sum()
            across[parts] += crosses
            continue
        if rule == "majority":
            best = sizes == sizes.max()
            to = next(x for x in where.tolist() if best[np.searchsorted(parts, x)])
        else:
            to = int(where[0] if rule == "start" else where[-1])
        counts[to] += 1
        across[to] += crosses
    return counts, across


def attribute(docs: DataFrame, split: Callable[[str], list[tuple[int, int]]] = lines_of, rule: str = "start", text: str = "text", key: str = "doc_id", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """key, section long, char_start, char_end, n_tokens double, n_crossing long: a row for each section, -1 only where it has tokens."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs.sparkSession)
    source = docs.select(F.col(key), F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        for batch in batches:
            for a, b, texts in chunks(batch, "__text", 1 << 18):
                starts, ends, sizes = token_spans(enc, texts)
                until = np.cumsum(sizes)
                row, section, low, high, tokens, across = [], [], [], [], [], []
                for i, t in enumerate(texts):
                    own = slice(until[i] - sizes[i], until[i])
                    parts = split(t)
                    counts, crossing = allocate(starts[own], ends[own], parts, rule)
                    ids = list(range(len(parts))) + ([-1] if counts[-1] else [])
                    row += [i] * len(ids)
                    section += ids
                    low += [parts[k][0] if k >= 0 else None for k in ids]
                    high += [parts[k][1] if k >= 0 else None for k in ids]
                    tokens.append(counts[ids])
                    across.append(crossing[ids])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(row, pa.int64())),
                        pa.array(section, pa.int64()),
                        pa.array(low, pa.int64()),
                        pa.array(high, pa.int64()),
                        pa.array(np.concatenate(tokens)),
                        pa.array(np.concatenate(across).astype(np.int64)),
                    ],
                    names=[key, "section", "char_start", "char_end", "n_tokens", "n_crossing"],
                )

    return source.mapInArrow(run, f"`{key}` {source.schema[0].dataType.simpleString()}, section long, char_start long, char_end long, n_tokens double, n_crossing long")


def attribute_fields(rows: DataFrame, fields: tuple[str, ...], key: str = "doc_id", between: str = "\n", rule: str = "start") -> DataFrame:
    """As attribute(), of the fields of a record joined by `between` (which belongs to none) and encoded as one text; section is the field's place."""
    mark = "\x00"

    def split(text: str) -> list[tuple[int, int]]:
        head, _, _ = text.partition(mark)
        sizes, out, at = [int(x) for x in head.split(",")], [], 0
        for n in sizes:
            out.append((at, at + n))
            at += n + len(between)
        return out

    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    lengths = F.concat_ws(",", *[F.length(v).cast("string") for v in values])
    joined = rows.select(F.col(key), F.concat_ws(between, *values).alias("text"), lengths.alias("sizes"))
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder()
        for batch in batches:
            sizes = batch.column(2).to_pylist()
            for a, b, texts in chunks(batch, "text", 1 << 18):
                starts, ends, counts = token_spans(enc, texts)
                until = np.cumsum(counts)
                for i in range(len(texts)):
                    own = slice(until[i] - counts[i], until[i])
                    parts = split(sizes[a + i] + mark)
                    found, crossing = allocate(starts[own], ends[own], parts, rule)
                    ids = list(range(len(parts))) + ([-1] if found[-1] else [])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(a + i, 1).take(pa.array([0] * len(ids))),
                            pa.array(ids, pa.int64()),
                            pa.array([parts[k][0] if k >= 0 else None for k in ids], pa.int64()),
                            pa.array([parts[k][1] if k >= 0 else None for k in ids], pa.int64()),
                            pa.array(found[ids]),
                            pa.array(crossing[ids].astype(np.int64)),
                        ],
                        names=[key, "section", "char_start", "char_end", "n_tokens", "n_crossing"],
                    )

    return joined.mapInArrow(run, f"`{key}` {joined.schema[0].dataType.simpleString()}, section long, char_start long, char_end long, n_tokens double, n_crossing long")
