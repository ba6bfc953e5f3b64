"""Repair of partial runs: what is missing, tried again, merged by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

REQUIRED = ("path", "id", "ocr_text", "detected_objects", "bin")


def last_wins(df: DataFrame, key: str = "path", order: str = "line_no") -> DataFrame:
    """One row a key: the last one's values at the place of the first; null keys are left out. `copies` counts its rows."""
    others = [c for c in df.columns if c not in (key, order)]
    keyed = df.filter(F.col(key).isNotNull())
    return keyed.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("__v"), F.min(order).alias(order), F.count("*").alias("copies")).select(key, "__v.*", order, "copies")


def failed(inputs: DataFrame, outputs: DataFrame, key: str = "path") -> DataFrame:
    """The rows of inputs whose key outputs doesn't have (null keys are rows without output)."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def failure_counts(inputs: DataFrame, outputs: DataFrame, key: str = "path") -> DataFrame:
    """One row: total, succeeded, failed, failed_pct (0 of 0 is 0)."""
    there = outputs.select(key).distinct().withColumn("__there", F.lit(1))
    counts = inputs.join(there, key, "left").agg(F.count("*").alias("total"), F.count("__there").alias("succeeded"))
    return counts.withColumn("failed", F.col("total") - F.col("succeeded")).withColumn("failed_pct", F.coalesce(F.round(100.0 * F.col("failed") / F.nullif("total", F.lit(0)), 2), F.lit(0.0)))


def entry_error(raw: Column, described: bool = True) -> Column:
    """Why a JSON entry is no good (null: it is): a key of REQUIRED is absent (null is fine), or its description is blank."""
    doc = F.try_parse_json(raw)
    error = F.when(doc.isNull(), "no JSON")
    for k in REQUIRED:
        error = error.when(F.try_variant_get(doc, f"$.{k}", "variant").isNull(), f"missing field: {k}")
    if described:
        error = error.when(F.coalesce(strip(F.try_variant_get(doc, "$.reasoning_description", "string")), F.lit("")) == "", "missing or empty reasoning_description")
    return error


def merge(original: DataFrame, retried: DataFrame, key: str = "path", order: str = "line_no", prefer: str = "retry") -> DataFrame:
    """All keys of both (each last_wins), on conflict the rows of `prefer` ("retry" or "original"); original keys first, then new ones, by `place`.

    origin is "original", "retry" or "conflict".
    """
    if prefer not in ("retry", "original"):
        raise ValueError("prefer must be 'retry' or 'original'")
    a, b = last_wins(original, key, order).drop("copies"), last_wins(retried, key, order).drop("copies")
    values = [c for c in a.columns if c not in (key, order)]
    x = a.select(key, F.struct(*values).alias("__a"), F.col(order).alias("__oa"))
    y = b.select(key, F.struct(*values).alias("__b"), F.col(order).alias("__ob"))
    first, second = ("__b", "__a") if prefer == "retry" else ("__a", "__b")
    both = x.join(y, key, "full")
    origin = F.when(F.col("__oa").isNull(), "retry").when(F.col("__ob").isNull(), "original").otherwise("conflict")
    chosen = F.when(F.col(f"__o{first[-1]}").isNotNull(), F.col(first)).otherwise(F.col(second))
    return both.select(key, chosen.alias("__v"), origin.alias("origin"), F.struct(F.col("__oa").isNull().cast("int").alias("new"), F.coalesce("__oa", "__ob").alias("at")).alias("place")).select(key, "__v.*", "origin", "place")


def good_entries(df: DataFrame, text: str = "reasoning_description") -> DataFrame:
    return df.filter(F.coalesce(strip(F.col(text)), F.lit("")) != "")


def repair(inputs: DataFrame, outputs: DataFrame, again: Callable[[DataFrame], DataFrame], key: str = "path", order: str = "line_no", prefer: str = "retry") -> DataFrame:
    """Identify, retry, merge: outputs with what again(failed rows) brings; without any success, outputs as they are."""
    from ..tables import save

    new = save(good_entries(again(failed(inputs, outputs, key))), "retried")
    return good_entries(outputs) if new.isEmpty() else good_entries(merge(outputs, new, key, order, prefer))
