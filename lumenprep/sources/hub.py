"""Hub datasets (Parquet shards) as image files: which column holds images, what its values are, where they go."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_url, sanitize_repo_id
from ..operators.rank import with_rank


def detect_image_column(schema: T.StructType) -> str:
    """The first column of images (struct<bytes:binary,path:string>), else the shortest name that says so; else ValueError."""
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType) and {x.name: x.dataType.simpleString() for x in f.dataType.fields} == {"bytes": "binary", "path": "string"}:
            return f.name
    named = [f.name for f in schema.fields if "image" in f.name.lower() or f.name.lower() == "img" or "img_path" in f.name.lower()]
    if not named:
        raise ValueError("no image column")
    return min(named, key=len)


def zip_member(value: Column) -> Column:
    """struct<archive,member> of zip://a.zip::inner, a.zip::inner or a.zip/inner; null for anything else."""
    bare = F.regexp_replace(value, "^zip://", "")
    pattern = r"(?i)^(.*?\.zip)(?:::|/)(.+)$"
    return F.when(bare.rlike(pattern), F.struct(F.regexp_extract(bare, pattern, 1).alias("archive"), F.regexp_extract(bare, pattern, 2).alias("member")))


def value_kind(value: Column) -> Column:
    """url, zip or path of a string value; null for null."""
    return F.when(value.isNull(), F.lit(None)).when(is_url(value), "url").when(zip_member(value).isNotNull(), "zip").otherwise("path")


def extract_zips(archives: DataFrame) -> DataFrame:
    """archive, member, content of every file in zip archives (a binaryFile scan); members that leave the archive's root are left out, broken archives empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    z = zipfile.ZipFile(io.BytesIO(bytes(content)))
                except zipfile.BadZipFile:
                    continue
                for name in z.namelist():
                    if not name.endswith("/") and not name.startswith("/") and ".." not in name.split("/"):
                        yield pd.DataFrame({"archive": [path], "member": [name], "content": [z.read(name)]})

    return archives.select("path", "content").mapInPandas(run, "archive string, member string, content binary")


def export_split(df: DataFrame, repo: str, order: list[str], existing: DataFrame | None = None, fetch: Callable[[str], bytes] | None = None) -> DataFrame:
    """path (<repo>/train/<number>.jpg, numbered by `order`) and content: bytes, else what fetch(url or path) brings; existing paths are left out."""
    column = detect_image_column(df.schema)
    kind = df.schema[column].dataType
    content = F.col(f"{column}.bytes") if isinstance(kind, T.StructType) else F.col(column) if isinstance(kind, T.BinaryType) else F.lit(None).cast("binary")
    place = F.col(f"{column}.path") if isinstance(kind, T.StructType) else F.col(column) if isinstance(kind, T.StringType) else F.lit(None).cast("string")
    numbered = with_rank(df, [F.col(c) for c in order], "__n")
    name = F.concat(sanitize_repo_id(F.lit(repo)), F.lit("/train/"), F.lpad((F.col("__n") - 1).cast("string"), 6, "0"), F.lit(".jpg"))
    out = numbered.select(name.alias("path"), content.alias("content"), place.alias("source"))
    if existing is not None:
        out = out.join(existing.select("path"), "path", "left_anti")
    if fetch is None:
        return out.filter("content IS NOT NULL").select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = []
            for c, s in zip(b["content"], b["source"], strict=True):
                try:
                    got.append(c if c is not None else fetch(s) if s else None)
                except Exception:  # an image that cannot be had is left out
                    got.append(None)
            yield b[["path"]].assign(content=got).dropna()

    return out.mapInPandas(run, "path string, content binary")


def sample_rows(df: DataFrame, n: int = 10, key: str = "id", seed: int = 0) -> DataFrame:
    """At most n rows, drawn by a hash."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
