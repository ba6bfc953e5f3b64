"""Global ranks without a window over the whole table: range partitions, local counters, partition offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import save


def with_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with `name` long: 1, 2, .. in `order`, which should end in a unique key.

    Rows are dealt by ranges of the order and sorted there; monotonically_increasing_id() then holds partition and local
    place. Only the partitions' sizes, as many numbers as partitions, come together.
    """
    ranked = save(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__at", 33)
    sizes = {r["p"]: r["n"] for r in ranked.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for p in sorted(sizes):
        offsets.append((p, total))
        total += sizes[p]
    starts = df.sparkSession.createDataFrame(offsets, "__p long, __start long")
    return ranked.join(F.broadcast(starts), part == F.col("__p")).withColumn(name, F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__at", "__p", "__start")


def top(df: DataFrame, order: list[Column], k: int) -> tuple[DataFrame, DataFrame]:
    """(the first k rows with rank, the rest without)."""
    ranked = with_rank(df, order, "__rank")
    return ranked.filter(F.col("__rank") <= k), ranked.filter(F.col("__rank") > k).drop("__rank")
