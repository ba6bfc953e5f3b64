"""JSON lines: lenient readers that count what they skip, strict ones for checkpoints, writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value and at (file and place in it) of the lines that aren't blank."""
    return spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n")).alias("at")).filter(F.trim("value") != "")


def _parsed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    good = _lines(spark, path).filter(F.try_parse_json("value").isNotNull())
    return good.select(F.from_json("value", schema).alias("entry"), "at")


def read_lenient(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The good lines; blank and bad ones are left out; a missing path raises."""
    return _parsed(spark, path, schema).select("entry.*")


def skipped(spark: SparkSession, path: str) -> int:
    """How many lines are neither blank nor JSON."""
    return _lines(spark, path).filter(F.try_parse_json("value").isNull()).count()


def read_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """As a checkpoint is read: one bad line fails the scan."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_dynamic(spark: SparkSession, path: str) -> DataFrame:
    """entry variant and line string: keys as they come, so that a missing key differs from a null."""
    return _lines(spark, path).select(F.try_parse_json("value").alias("entry"), F.col("value").alias("line")).filter("entry IS NOT NULL")


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "path") -> DataFrame:
    """One row a key, the last line's values at the first line's place (line_no, by file and position)."""
    from ..operators.retry import last_wins

    return last_wins(_parsed(spark, path, schema).select("entry.*", F.col("at").alias("line_no")), key)


def write(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Nulls are written, too."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(partition) if partition else writer).json(path)
