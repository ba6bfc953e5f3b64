"""Query of the language identifier."""

from pyspark.sql import DataFrame, SparkSession

from . import langid
from .common import table


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = langid.crc_part(docs["doc_id"]) == 1
    model = langid.train(docs.filter(~held_out))
    out = langid.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (langid.crc_part(out["doc_id"]) == 1).alias("held_out"), "lang_pred", "score", "languages")
