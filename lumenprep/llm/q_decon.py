"""Query of the decontamination operator."""

from pyspark.sql import DataFrame, SparkSession

from . import decon
from .common import table


def op1_decon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decon.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
