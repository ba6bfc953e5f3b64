"""Manifests that keep arriving: the row-wise operators over a stream of JSON lines.

The batch operators of rows (filters, features, validation) are column expressions, so they run on streams as they are;
those that need the order of a whole corpus (dedup, quotas) run on what the stream has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ValidationConfig
from ..operators.validation import reject_reason

ENTRY = "question string, answer string, reasoning string, image string, bin string"


def validated(spark: SparkSession, folder: str, config: ValidationConfig = ValidationConfig()) -> DataFrame:
    """Entries of JSON-line files as they appear in a folder, with reject_reason (null: valid)."""
    return spark.readStream.schema(ENTRY).json(folder).withColumn("reject_reason", reject_reason(config))


def write_valid(entries: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends valid entries to Parquet, each once, and stops when what is there is done."""
    return entries.filter(F.col("reject_reason").isNull()).drop("reject_reason").writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
