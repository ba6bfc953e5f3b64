"""Row filters of image records and their cascade.

An image row has path, ordinal (its place in the corpus order), width, height, and what scorers add: `predictions`
array<struct<label,score>> (null: no detector), `image_error` boolean, `edge_ratios` array<double>, `phash` bigint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BinningConfig, FilterConfig
from .dedup import greedy_dedup


def resolution_ok(least: int = 256, most: int | None = None, width: str = "width", height: str = "height") -> Column:
    """Both sides at least `least` (and at most `most`); unknown or undecodable (negative) sizes fail."""
    ok = (F.col(width) >= least) & (F.col(height) >= least)
    if most is not None:
        ok = ok & (F.col(width) <= most) & (F.col(height) <= most)
    return F.coalesce(ok, F.lit(False))


def nsfw_ok(threshold: float = 0.5, predictions: str = "predictions", error: str | None = None) -> Column:
    """False where any prediction of label "nsfw" (any case) scores above the threshold, or the image failed; no detector: true."""
    bad = F.exists(F.col(predictions), lambda p: (F.lower(p["label"]) == "nsfw") & (p["score"] > threshold))
    ok = ~F.coalesce(bad, F.lit(False))
    return ok & ~F.coalesce(F.col(error), F.lit(False)) if error else ok


def watermark_ok(ratio: float = 0.3, edges: str = "edge_ratios") -> Column:
    """False where any corner's edge share exceeds the ratio; unknown: true."""
    return ~F.coalesce(F.exists(F.col(edges), lambda x: x > ratio), F.lit(False))


def complexity_ok(config: BinningConfig = BinningConfig()) -> Column:
    return F.coalesce(
        (F.col("unique_classes") > config.unique_objects_threshold) | (F.col("num_objects") > config.object_count_threshold) | (F.col("dispersion") > config.spatial_dispersion_threshold), F.lit(False)
    )


def oversample(df: DataFrame, wanted: int, seed: int = 0, key: str = "path") -> DataFrame:
    """Where there are more than 2 * wanted rows: exactly 2 * wanted of them, drawn and ordered by a hash (their new ordinal); else all."""
    if wanted < 0 or df.count() <= 2 * wanted:
        return df
    from .rank import with_rank

    mixed = df.withColumn("__h", F.xxhash64(F.col(key), F.lit(seed)))
    return with_rank(mixed, [F.col("__h"), F.col(key), F.col("ordinal")], "__r").filter(F.col("__r") <= 2 * wanted).withColumn("ordinal", F.col("__r") - 1).drop("__h", "__r")


def cascade(df: DataFrame, config: FilterConfig = FilterConfig(), wanted: int = -1) -> DataFrame:
    """The rows that pass all steps of config.order ("resolution", "nsfw", "watermark", "dedup").

    Only the place of "dedup" among them matters: an image that later steps drop has by then suppressed its near copies.
    With wanted >= 0 the first `wanted` rows by ordinal stay.
    """
    for step in config.order:
        if step == "dedup":
            df = greedy_dedup(df, "phash", "ordinal", config.phash_threshold)
        elif step == "resolution":
            df = df.filter(resolution_ok(config.min_resolution, config.max_resolution))
        elif step == "nsfw":
            df = df.filter(nsfw_ok(config.nsfw_threshold, error="image_error" if "image_error" in df.columns else None))
        elif step == "watermark":
            df = df.filter(watermark_ok(config.watermark_ratio))
        else:
            raise ValueError(f"no filter step {step!r}")
    if wanted < 0:
        return df
    from .rank import with_rank

    return with_rank(df, [F.col("ordinal")], "__r").filter(F.col("__r") <= wanted).drop("__r")


def funnel(df: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    """One row: how many rows came, passed each predicate after the ones before it, and the shares in percent (0 of 0 is 0)."""
    r = resolution_ok(config.min_resolution, config.max_resolution)
    n = nsfw_ok(config.nsfw_threshold)
    counts = df.agg(F.count("*").alias("n_in"), F.count_if(r).alias("n_resolution"), F.count_if(r & n).alias("n_nsfw"))
    return counts.withColumns({f"pct_{k}": F.coalesce(F.round(100.0 * F.col(f"n_{k}") / F.nullif("n_in", F.lit(0)), 4), F.lit(0.0)) for k in ("resolution", "nsfw")})


def funnel_to_end(df: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    """funnel() and what the whole cascade leaves: n_out, the near copies that its last step drops, and their shares in percent."""
    out = cascade(df, config).agg(F.count("*").alias("n_out"))
    both = funnel(df, config).crossJoin(F.broadcast(out)).withColumn("n_duplicates", F.col("n_nsfw") - F.col("n_out"))
    return both.withColumns({f"pct_{k}": F.coalesce(F.round(100.0 * F.col(f"n_{k}") / F.nullif("n_in", F.lit(0)), 4), F.lit(0.0)) for k in ("duplicates", "out")})
