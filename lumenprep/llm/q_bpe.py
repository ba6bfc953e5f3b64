"""Query of the byte-level BPE operator."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import table


def digests(docs: DataFrame) -> DataFrame:
    """Encodes, decodes the ids, and hashes both; n_pieces and last_piece_start come from the retained offsets."""
    return bpe.encode(docs, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.size("piece_starts").cast("long").alias("n_pieces"),
        F.try_element_at("piece_starts", F.lit(-1)).cast("long").alias("last_piece_start"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
