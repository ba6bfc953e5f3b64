"""Query of the token counts: every line of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import counts
from .common import table


def op8_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.attribute(table(spark, sf_dir, "documents")).withColumn("n_tokens", F.col("n_tokens").cast("long"))
