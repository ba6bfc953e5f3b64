"""What the operators of this subpackage share: the shared folder, written tables, text arrays."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import BATCH, BATCH_SETTING, drop, save, shared_dir, ship  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, read by Spark alone (the folder may be in any store that Spark knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_points(text: str) -> np.ndarray:
    """The code points of a string as uint32."""
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


CACHES: dict[str, dict] = {}


def hold(name: str) -> None:
    """Says what this process needs now: what else it holds in CACHES (tables, slices that met before) goes."""
    for other, held in CACHES.items():
        if other != name:
            held.clear()


def _give_back() -> None:
    """Memory that has been freed goes back to the system, where there is a way: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, end row, texts) of parts of a batch of about `most` bytes (a longer text alone); nulls are empty.

    Only one part at a time is held as Python strings, and what Arrow has freed goes back when a batch is done.
    """
    texts = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, end, [x or "" for x in texts.slice(start, end - start).to_pylist()]
        start = end
    _give_back()


BITMAP_BITS = 23


def bitmap(wanted: DataFrame, key: Column) -> np.ndarray:
    """2**23 bits as uint64, set where the low bits of a key (already a hash) say: at most 2**17 rows come to the driver."""
    words = wanted.select(key.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("s")).selectExpr("s div 64 AS w", "shiftleft(1L, cast(s % 64 AS int)) AS bit").groupBy("w").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    found = words.toArrow()
    out[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def maybe_in(df: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """df with __maybe boolean: false where the key is certainly not in the one (long) column of `wanted`.

    A bitmap of 2**23 bits that the wanted keys set, broadcast as at most 2**17 rows of two numbers whatever the sizes; a
    full one lets all pass and is still right.
    """
    slot = F.pmod(F.xxhash64(wanted.columns[0]), F.lit(1 << BITMAP_BITS))
    words = wanted.select(slot.alias("s")).selectExpr("s div 64 AS __w", "shiftleft(1L, cast(pmod(s, 64) AS int)) AS __bit").groupBy("__w").agg(F.bit_or("__bit").alias("__bits"))
    marked = df.withColumn("__slot", F.pmod(F.xxhash64(key), F.lit(1 << BITMAP_BITS))).join(F.broadcast(words), F.expr("__slot div 64 = __w"), "left")
    return marked.withColumn("__maybe", F.expr("coalesce(shiftrightunsigned(__bits, cast(pmod(__slot, 64) AS int)) & 1, 0) = 1")).drop("__slot", "__w", "__bits")
