"""Written tables in the folder that driver and executors share: where lineage is cut."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes a query's shuffle files when the query ends; else they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or on local[*] a temporary folder where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = f"file://{tempfile.gettempdir()}/checkpoints/{spark.sparkContext.applicationId}"
    spark.conf.set("spark.checkpoint.dir", own)
    return own


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """What queries shuffle in this block is deleted as each ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def save(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again, so that a lost executor loses nothing of it. What was
    shuffled for it is deleted with the write."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*saved: DataFrame) -> DataFrame:
    """Tables of one schema that save() wrote, read as one, so that a plan doesn't grow with their number."""
    first = saved[0]
    return first.sparkSession.read.schema(first.schema).parquet(*[f for df in saved for f in df.inputFiles()])


def drop(*saved: DataFrame) -> None:
    """Deletes tables that save() wrote and that nothing reads any more."""
    for df in saved:
        spark = df.sparkSession
        for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()
BATCH_SETTING, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once an application, so that its functions can be loaded there.

    Batches on their way to Python are bounded to BATCH bytes (and a row), where the session has Spark's own 64 MB.
    """
    if spark.conf.get(BATCH_SETTING, "64m") in ("67108864b", "64m"):
        spark.conf.set(BATCH_SETTING, BATCH)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
