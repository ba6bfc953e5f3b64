"""Training rows and their packaging: solutions, resized dimensions, embedded images, collected files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, suffix

LONGEST = 840


def option_text(answer: Column, options: Column) -> Column:
    """The option of a letter A to D; beyond the options "Option X"; anything else as it is; nulls are ""."""
    raw = F.coalesce(answer, F.lit(""))
    at = F.ascii(raw) - F.ascii(F.lit("A"))
    return F.when(raw.isin("A", "B", "C", "D"), F.coalesce(F.get(options, at), F.concat(F.lit("Option "), raw))).otherwise(raw)


def solution(described: Column, reasoning: Column, answer: Column, options: Column) -> Column:
    """The target text of a training row: description, reasoning trace, final answer (both texts stripped, nulls "")."""
    # The headings.
    d, r = strip(F.coalesce(described, F.lit(""))), strip(F.coalesce(reasoning, F.lit("")))
    a = option_text(strip(F.coalesce(answer, F.lit(""))), F.coalesce(options, F.array().cast("array<string>")))
    return F.concat(F.lit("Image Description:\n"), d, F.lit("\n\nReasoning Trace:\n"), r, F.lit("\n\nFinal Answer:\n"), a)


def training_rows(df: DataFrame) -> DataFrame:
    """image (a path), problem, solution."""
    return df.select(F.col("path").alias("image"), F.col("question").alias("problem"), solution(F.col("reasoning_description"), F.col("reasoning_trace"), F.col("answer"), F.col("options")).alias("solution"))


def fitted(width: Column, height: Column, longest: int = LONGEST) -> Column:
    """struct<width,height> scaled so that the longest side is at most `longest` (halves round to even), never larger."""
    scale = F.lit(float(longest)) / F.greatest(width, height)
    return F.when(F.greatest(width, height) <= longest, F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))).otherwise(
        F.struct(F.bround(width * scale).cast("int").alias("width"), F.bround(height * scale).cast("int").alias("height"))
    )


def embed_images(rows: DataFrame, files: DataFrame) -> DataFrame:
    """rows with image as struct<bytes,path> of files (path, content; a binaryFile scan); rows without a readable file go."""
    there = files.filter(F.octet_length("content") > 0).select(F.col("path").alias("__path"), "content")
    joined = rows.join(there, F.col("image") == F.col("__path"))
    return joined.withColumn("image", F.struct(F.col("content").alias("bytes"), F.lit(None).cast("string").alias("path"))).drop("__path", "content")


def collected_path(by_bin: bool = False, uid: bool = False) -> Column:
    """images/[bin/]id.ext; uid: a hash of the path in place of id, which several datasets may share."""
    name = F.concat(F.sha2("path", 256) if uid else F.col("id"), suffix(F.col("path")))
    return F.concat(F.lit("images/"), F.concat(F.coalesce("bin", F.lit("C")), F.lit("/")), name) if by_bin else F.concat(F.lit("images/"), name)


def collect(rows: DataFrame, files: DataFrame, by_bin: bool = False, uid: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with their collected path as `path` and the old one as source_path, rows whose file is missing)."""
    there = files.select("path").distinct().withColumn("__there", F.lit(True))
    marked = rows.join(there, "path", "left")
    found = marked.filter("__there").withColumn("source_path", F.col("path")).withColumn("path", collected_path(by_bin, uid)).drop("__there")
    return found, marked.filter("__there IS NULL").drop("__there")


def copy_files(found: DataFrame, root: str, move: bool = False) -> None:
    """Copies (or moves) source_path to root/path, on a file system that all machines mount, in parallel; what exists stays."""
    import pandas as pd

    def run(batches):  # noqa: ANN001, ANN202
        from pathlib import Path
        from shutil import copy2
        from shutil import move as mv

        for b in batches:
            for s, p in zip(b["source_path"], b["path"], strict=True):
                source, to = Path(s.removeprefix("file:")), Path(root) / p
                to.parent.mkdir(parents=True, exist_ok=True)
                if not to.exists():
                    (mv if move else copy2)(str(source), str(to))
            yield pd.DataFrame({"n": [len(b)]})

    found.select("source_path", "path").dropDuplicates(["path"]).mapInPandas(run, "n long").agg(F.sum("n")).collect()


def duplicate_paths(rows: DataFrame) -> DataFrame:
    """path and count of paths that more than two rows have, the most frequent first."""
    return rows.groupBy("path").agg(F.count("*").alias("count")).filter("count > 2").orderBy(F.desc("count"), "path")


def replace_table(df: DataFrame, path: str, stamp: int | None = None) -> str | None:
    """Writes df as JSON lines beside `path`, then puts it there; what was there moves to path.backup_<stamp>, which is returned."""
    import time
    import uuid

    spark = df.sparkSession
    new = f"{path}.tmp_{uuid.uuid4().hex}"
    P = spark._jvm.org.apache.hadoop.fs.Path
    fs = P(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.write.option("ignoreNullFields", "false").json(new)
    except BaseException:
        fs.delete(P(new), True)
        raise
    backup = None
    if fs.exists(P(path)):
        backup = f"{path}.backup_{int(time.time()) if stamp is None else stamp}"
        fs.rename(P(path), P(backup))
    fs.rename(P(new), P(path))
    return backup


def write_models_csv(df: DataFrame, path: str, model: str = "model_name") -> None:
    """path/all and path/by_model/model_name=..: a comparison as CSV, together and by model."""
    df.write.mode("overwrite").option("header", True).csv(f"{path}/all")
    df.write.mode("overwrite").option("header", True).partitionBy(model).csv(f"{path}/by_model")
