"""Query of the near-duplicate operator."""

from pyspark.sql import DataFrame, SparkSession

from . import minhash
from .common import table


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))
