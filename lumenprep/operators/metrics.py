"""Counts, shares, histograms and summaries of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import histogram_bin
from ..tables import save


def bin_counts(df: DataFrame, bins: tuple[str, ...] = ("A", "B", "C")) -> DataFrame:
    """bin and n of every bin, zeros included."""
    names = df.sparkSession.createDataFrame([(b,) for b in bins], "bin string")
    return F.broadcast(names).join(df.groupBy("bin").agg(F.count("*").alias("n")), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), column)


def removal_rate(before: Column, after: Column) -> Column:
    """Percent removed, two places; of nothing 0."""
    return F.when(before == 0, 0.0).otherwise(F.round(100.0 * (before - after) / before, 2))


def success_rate(df: DataFrame, status: str = "status") -> DataFrame:
    out = df.agg(F.count("*").alias("total"), F.count_if(F.col(status) == "success").alias("succeeded"))
    return out.withColumn("failed", F.col("total") - F.col("succeeded")).withColumn("success_pct", F.coalesce(F.round(100.0 * F.col("succeeded") / F.nullif("total", F.lit(0)), 2), F.lit(0.0)))


def length_histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """bin (from 0) and n of an equal-width histogram between the least and greatest value; empty bins are left out."""
    # Each value once with its count, written: bounds and bins are of that small table, and a filter on the values can't be
    # pushed below it, so that the rows are read, and an expression behind the column is evaluated, once.
    counts = save(df.groupBy(column).agg(F.count("*").alias("__n")), "lengths").filter(F.col(column).isNotNull())
    bounds = counts.agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
    return counts.crossJoin(F.broadcast(bounds)).groupBy(histogram_bin(F.col(column), F.col("__low"), F.col("__high"), F.lit(bins)).alias("bin")).agg(F.sum("__n").alias("n"))


def head_per_bin(df: DataFrame, n: int = 2, order: str = "ordinal") -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn("__n", F.row_number().over(Window.partitionBy("bin").orderBy(order))).filter(F.col("__n") <= n).drop("__n")


def model_comparison(df: DataFrame) -> DataFrame:
    """Per model_name: images, mean_latency, total_latency, passed."""
    return df.groupBy("model_name").agg(F.count("*").alias("images"), F.avg("latency").alias("mean_latency"), F.sum("latency").alias("total_latency"), F.count_if("passes_filter").alias("passed"))


def run_metrics(filtered: DataFrame | None, binned: DataFrame | None, generated: DataFrame | None, validated: DataFrame | None) -> dict:
    """{filtered_count, bins, generated_qa, validated_qa}: of the stages that ran."""
    out: dict = {}
    if filtered is not None:
        out["filtered_count"] = filtered.count()
    if binned is not None:
        out["bins"] = {r["bin"]: r["n"] for r in bin_counts(binned).collect()}
    if generated is not None:
        out["generated_qa"] = generated.count()
    if validated is not None:
        out["validated_qa"] = validated.count()
    return out
