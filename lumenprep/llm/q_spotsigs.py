"""Query of the document fingerprints."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spotsigs
from .common import table


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = spotsigs.with_next(spotsigs.with_signatures(docs, "text", "s"))
    both = spotsigs.with_signatures(paired.withColumn("edited", spotsigs.edited(F.col("text"), F.col("next.text"))), "edited", "e")
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.fingerprint(F.col("s")).alias("fingerprint"),
        spotsigs.fingerprint(F.col("e")).alias("edited_fingerprint"),
        spotsigs.jaccard(F.col("s"), F.col("e")).alias("near_edited"),
        spotsigs.jaccard(F.col("s"), F.col("next.s")).alias("near_next"),
    )
