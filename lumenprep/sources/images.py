"""Image corpora: root/<dataset>/train/<file>, one level deep."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stem
from ..operators.rank import with_rank

EXTENSIONS = ("jpg", "jpeg", "png", "bmp", "gif", "tiff", "webp")


def is_image(path: Column) -> Column:
    return F.lower(path).rlike(rf"\.({'|'.join(EXTENSIONS)})$")


def _scan(spark: SparkSession, root: str, form: str) -> DataFrame | None:
    P = spark._jvm.org.apache.hadoop.fs.Path
    at = P(f"{root.rstrip('/')}/*/train")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    if found is None or len(found) == 0:
        return None
    return spark.read.format(form).load([str(f.getPath()) for f in found if f.isDirectory()] or [])


def load_images(spark: SparkSession, root: str) -> DataFrame:
    """path, dataset, filename, id (the stem), uid (a hash of the path: ids collide across datasets), ordinal (by path).

    Extensions in any case; folders without train/ and deeper files are left out; a root that isn't there is empty.
    """
    schema = "path string, dataset string, filename string, id string, uid string, ordinal long"
    files = _scan(spark, root, "binaryFile")
    if files is None:
        return spark.createDataFrame([], schema)
    pattern = r"/([^/]+)/train/([^/]+)$"
    named = files.filter(is_image(F.col("path")) & F.col("path").rlike(pattern)).select(
        "path", F.regexp_extract("path", pattern, 1).alias("dataset"), F.regexp_extract("path", pattern, 2).alias("filename"), stem(F.col("path")).alias("id"), F.sha2("path", 256).alias("uid")
    )
    return with_rank(named, [F.col("path")], "ordinal").withColumn("ordinal", F.col("ordinal") - 1)


def image_paths(spark: SparkSession, root: str) -> DataFrame:
    return load_images(spark, root).select("path")


def header_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) from the header of PNG, GIF, BMP, JPEG, WebP or TIFF bytes; None for anything else."""
    n = int.from_bytes
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return n(data[16:20]), n(data[20:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return n(data[6:8], "little"), n(data[8:10], "little")
    if data[:2] == b"BM" and len(data) >= 26:
        return n(data[18:22], "little", signed=True), abs(n(data[22:26], "little", signed=True))
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        if data[12:16] == b"VP8X":
            return n(data[24:27], "little") + 1, n(data[27:30], "little") + 1
        if data[12:16] == b"VP8L":
            bits = n(data[21:25], "little")
            return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        return n(data[26:28], "little") & 0x3FFF, n(data[28:30], "little") & 0x3FFF
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(data) and data[at] == 0xFF:
            kind = data[at + 1]
            if kind in (0xFF, 0x01) or 0xD0 <= kind <= 0xD8:
                at += 1 if kind == 0xFF else 2
                continue
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                return n(data[at + 7 : at + 9]), n(data[at + 5 : at + 7])
            at += 2 + n(data[at + 2 : at + 4])
        return None
    if data[:4] in (b"II*\x00", b"MM\x00*") and len(data) >= 8:
        order = "little" if data[:2] == b"II" else "big"
        at, got = n(data[4:8], order), {}
        for k in range(n(data[at : at + 2], order)):
            e = data[at + 2 + 12 * k : at + 14 + 12 * k]
            if len(e) == 12 and (tag := n(e[:2], order)) in (256, 257):
                got[tag] = n(e[8:10], order) if n(e[2:4], order) == 3 else n(e[8:12], order)
        return (got[256], got[257]) if len(got) == 2 else None
    return None


def with_sizes(files: DataFrame) -> DataFrame:
    """A binaryFile scan (path, content) as path, width, height from headers; -1 for what is no image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes = [header_size(bytes(c)) or (-1, -1) if c is not None else (-1, -1) for c in b["content"]]
            yield pd.DataFrame({"path": b["path"], "width": [s[0] for s in sizes], "height": [s[1] for s in sizes]})

    return files.select("path", "content").mapInPandas(run, "path string, width int, height int")


def decode(spark: SparkSession, root: str) -> DataFrame:
    """path, width, height and Spark's image struct of a corpus; what cannot be decoded has width and height -1."""
    found = _scan(spark, root, "image")
    if found is None:
        return spark.createDataFrame([], "path string, width int, height int")
    return found.select(F.col("image.origin").alias("path"), "image.width", "image.height", "image").filter(is_image(F.col("path")))
