"""Query of the secret scanner."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets
from .common import table


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def of(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def judged(what: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["verdict"] == what)).cast("long")

    return found.select(
        "doc_id",
        *(of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"] != "token")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        judged("example").alias("n_example"),
        judged("live").alias("n_live"),
    )
