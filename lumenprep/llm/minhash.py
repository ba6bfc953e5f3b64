"""Near-duplicates by DartMinHash: darts thrown at weighted elements, the earliest of each coordinate, banded joining, exact check.

A dart lands in the plane weight x rank; the plane above an element is cut into regions (weight cells [0,1), [1,2), [2,4)..
by rank cells [0,1/8), [1/8,1/4), [1/4,1/2)..) and a hash of element and region says how many darts lie in it (Poisson, by
its area) and where. A dart counts for a text if it lies under the element's weight there; the dart of least rank of each
of `k` coordinates is the signature, and two texts agree in a coordinate with probability of their weighted Jaccard
similarity. Only regions up to rank (k ln k + 2k) / total weight are looked at, further ones for texts with a coordinate
still empty: about k log k darts a text, however many shingles it has.

Elements are five-word shingles; by default each weighs 1 (Jaccard of sets), with weighted=True its count in the text.
Texts with equal elements and weights are one node; bands propose pairs of nodes, links.joined() compares them exactly
(similarity >= 0.8) and makes classes. At 0.8 a pair shares one of 25 bands of 5 with probability 0.99995.

Defined results: null or empty text, and text without a word, is alone in its class; fewer than five words are one
shingle; a null doc_id is alone with a null class; repeated rows are in one class (the class of their text); class_id is
the least doc_id of the class; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, drop, hold, maybe_in, save, ship
from .links import joined, members_of
from .shingles import U, mix, shingles

BANDS, ROWS = 25, 5
BASE = -3  # log2 of the first rank cell
#: Texts whose darts are held at once.
PART = 256


def _poisson(mean: float) -> np.ndarray:
    """The distribution function, until it is 1 in double precision."""
    out, p, total, k = [], np.exp(-mean), 0.0, 0
    while k < 10 or total < 1 - 1e-15 and k < mean + 40 * (1 + mean**0.5):
        total += p
        out.append(min(total, 1.0))
        k += 1
        p *= mean / k
    return np.array(out)


_CDF: dict[float, np.ndarray] = {}


def darts(h: np.ndarray, weight: np.ndarray, of: np.ndarray, rank_cell: int, weight_cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, rank, identity) of the darts of one region under the elements given."""
    low, wide = (0.0, 2.0**BASE) if rank_cell == BASE else (2.0 ** (rank_cell - 1), 2.0 ** (rank_cell - 1))
    bottom, tall = (0.0, 1.0) if weight_cell == 0 else (2.0 ** (weight_cell - 1), 2.0 ** (weight_cell - 1))
    mean = wide * tall
    cdf = _CDF.setdefault(mean, _poisson(mean))
    seed = mix(h ^ U(((rank_cell + 64) * 0x1F123BB5 + weight_cell * 0x5DEECE66D + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
    chance = (seed >> U(11)) * 2.0**-53
    some = np.flatnonzero(chance >= cdf[0])
    n = np.searchsorted(cdf, chance[some], side="right")
    which = np.repeat(some, n)
    number = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    identity = mix(seed[which] + (number.astype(U) + U(1)) * U(0xD1342543DE82EF95))
    rank = low + wide * ((identity >> U(11)) * 2.0**-53)
    height = bottom + tall * ((mix(identity ^ U(0xA24BAED4963EE407)) >> U(11)) * 2.0**-53)
    under = height < weight[which]
    return of[which][under], rank[under], identity[under]


def signatures(h: np.ndarray, weight: np.ndarray, of: np.ndarray, texts: int, k: int = BANDS * ROWS) -> np.ndarray:
    """uint64 (texts, k): the identity of the earliest dart of each coordinate; a text without elements has zeros.

    of is sorted. A text needs about k log k darts even if it has one element, so PART texts at a time are thrown at.
    """
    out = np.zeros((texts, k), U)
    for a in range(0, texts, PART):
        b = min(a + PART, texts)
        part = slice(*np.searchsorted(of, [a, b]).tolist())
        out[a:b] = _signatures(h[part], weight[part], of[part] - a, b - a, k)
    return out


def _signatures(h: np.ndarray, weight: np.ndarray, of: np.ndarray, texts: int, k: int) -> np.ndarray:
    weight = weight.astype(float)
    total = np.bincount(of, weight, minlength=texts)
    best_rank, best = np.full(texts * k, np.inf), np.zeros(texts * k, U)
    reach = np.full(texts, BASE)
    reach[total > 0] = np.maximum(BASE, np.ceil(np.log2((k * np.log(k) + 2 * k) / total[total > 0]))).astype(int)
    done = np.full(texts, BASE - 1)
    waiting = total > 0
    while waiting.any():
        for cell in range(done[waiting].min() + 1, reach[waiting].max() + 1):
            now = np.flatnonzero((waiting & (done < cell) & (reach >= cell))[of])
            top = weight[now].max() if len(now) else 0
            level = 0
            while level == 0 or top > 2.0 ** (level - 1):
                at = now if level == 0 else now[weight[now] > 2.0 ** (level - 1)]
                text, rank, identity = darts(h[at], weight[at], of[at], cell, level)
                slot = text * k + (mix(identity + U(0x632BE59BD9B4E019)) % U(k)).astype(np.int64)
                order = np.lexsort((rank, slot))
                slot, rank, identity = slot[order], rank[order], identity[order]
                first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.empty(0, np.int64)
                slot, rank, identity = slot[first], rank[first], identity[first]
                earlier = rank < best_rank[slot]
                best_rank[slot[earlier]], best[slot[earlier]] = rank[earlier], identity[earlier]
                level += 1
        done = np.where(waiting, reach, done)
        waiting = waiting & np.isinf(best_rank.reshape(texts, k)).any(axis=1)
        reach = reach + waiting
    return best.reshape(texts, k)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(signature), bands), U)
    for r in range(rows):
        keys = mix(keys + signature.reshape(len(signature), bands, rows)[:, :, r] + U(0x2545F4914F6CDD1D))
    return mix(keys + np.arange(bands, dtype=U)[None, :]).view(np.int64)


def _nodes(h: np.ndarray, weight: np.ndarray, of: np.ndarray, texts: int) -> list[str | None]:
    """128 bits of each text's elements and weights, in whatever order; None without elements."""
    sums = []
    for salt in (0x8CB92BA72F3D8DD7, 0x3C6EF372FE94F82B):
        s = np.zeros(texts, U)
        np.add.at(s, of, mix(mix(h ^ U(salt)) + weight.astype(U)))
        sums.append(s)
    there = np.bincount(of, minlength=texts) > 0
    return [f"{a:016x}{b:016x}" if ok else None for a, b, ok in zip(sums[0].tolist(), sums[1].tolist(), there.tolist(), strict=True)]


def sketch(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """doc_id, node string, keys array<long> (none without a word)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        for batch in batches:
            for a, b, texts in chunks(batch, "text", 1 << 18):
                h, n, of = shingles(texts)
                n = n if weighted else np.ones_like(n)
                keys = band_keys(signatures(h, n, of, len(texts)))
                nodes = _nodes(h, n, of, len(texts))
                offsets = np.concatenate([[0], np.cumsum([BANDS if x else 0 for x in nodes])]).astype(np.int32)
                there = np.array([x is not None for x in nodes])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(nodes, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[there].ravel()))], names=["doc_id", "node", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node string, keys array<long>")


def elements(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """node and its elements as array<long>; an element that counts n times is n elements."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(__name__)
        for batch in batches:
            for _, _, texts in chunks(batch, "text", 1 << 18):
                h, n, of = shingles(texts)
                n = n if weighted else np.ones_like(n)
                nodes = _nodes(h, n, of, len(texts))
                turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                each = mix(np.repeat(h, n) + turn.astype(U) * U(0x9E3779B97F4A7C15)).view(np.int64)
                sizes = np.bincount(np.repeat(of, n), minlength=len(texts))
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(each))], names=["node", "elements"])

    return docs.select("text").mapInArrow(run, "node string, elements array<long>")


def _bound(x: Column, y: Column) -> Column:
    """The highest Jaccard similarity of two sets of n elements of which u are in no other set at all."""
    both = F.least(x["n"] - x["u"], y["n"] - y["u"])
    return both / (x["n"] + y["n"] - both)


def classes(docs: DataFrame, threshold: float = 0.8, weighted: bool = False) -> DataFrame:
    """doc_id and class_id (the least doc_id of its class): a row for each row of docs.

    Elements that only one node has (`u` of its `n`) bound the similarity that it can have to any other; that bound, which
    needs no element sets, keeps heavily edited copies of a large group from being compared with the whole group.
    """
    sketched = save(sketch(docs, weighted), "sketch")
    grouped = sketched.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"), F.first("keys").alias("keys"))
    nodes = save(grouped.withColumn("id", F.monotonically_increasing_id()), "nodes")
    members = members_of(nodes.select(F.explode("keys").alias("key"), "id"))
    wanted = save(members.select("id").distinct().join(nodes.select("id", "node", "first"), "id"), "wanted")
    some = maybe_in(docs.select("doc_id", "text"), F.col("doc_id"), wanted.select("first")).filter("__maybe")
    texts = some.join(wanted.select("first"), some["doc_id"] == F.col("first"), "left_semi").select("text")
    held = save(elements(texts, weighted).join(wanted.select("node", "id"), "node").dropDuplicates(["id"]).select("id", "elements", F.size("elements").alias("n")), "elements")
    alone = held.select("id", F.explode("elements").alias("e")).groupBy(F.hash("e").alias("e")).agg(F.count("*").alias("c"), F.min("id").alias("id")).filter("c = 1").groupBy("id").agg(F.count("*").alias("u"))
    sized = held.select("id", "n").join(alone, "id", "left").select("id", F.struct("n", F.coalesce("u", F.lit(0)).alias("u")).alias("at"))
    able = save(sized.filter(F.col("at.n") - F.col("at.u") >= threshold * F.col("at.n")), "able")
    left = members_of(members.join(able, "id"))

    def verify(pairs: DataFrame) -> DataFrame:
        x = held.select(F.col("id").alias("a"), F.col("elements").alias("x"), F.col("n").alias("nx"))
        y = held.select(F.col("id").alias("b"), F.col("elements").alias("y"), F.col("n").alias("ny"))
        both = F.size(F.array_intersect("x", "y"))
        return pairs.join(x, "a").join(y, "b").filter(both >= threshold * (F.col("nx") + F.col("ny") - both)).select("a", "b")

    roots = joined(left, [F.col("at.u") / F.col("at.n")], lambda x, y: _bound(x, y) >= threshold - 1e-9, verify)
    rooted = nodes.select("id", "node", "first").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    firsts = save(rooted.groupBy("root").agg(F.min("first").alias("class_id")), "firsts")
    named = save(rooted.select("node", "root").join(firsts, "root").select("node", "class_id"), "classes")
    drop(nodes, members, wanted, held, able, left, roots, firsts)
    return sketched.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")).join(named, "node", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
