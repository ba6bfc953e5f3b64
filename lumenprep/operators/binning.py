"""Bins of images: the rule cascade with its details, ranked quotas, user criteria and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BinningConfig
from ..tables import save
from .filters import complexity_ok
from .rank import top

BINS = ("A", "B", "C")


def rule_bin(config: BinningConfig = BinningConfig()) -> Column:
    """A: many text boxes or much text; else B: many classes or objects; else C. All comparisons are strict."""
    a = (F.col("num_boxes") > config.text_boxes_threshold) | (F.col("text_area_ratio") > config.text_area_threshold)
    b = (F.col("unique_classes") > config.unique_objects_threshold) | (F.col("num_objects") > config.object_count_threshold)
    return F.when(a, "A").when(b, "B").otherwise("C")


def details(config: BinningConfig = BinningConfig()) -> Column:
    """The struct of a categorised image: for each bin its values, thresholds and what passes."""

    def over(c: str, t: float) -> Column:
        return F.coalesce(F.col(c) > t, F.lit(False))

    boxes, area = over("num_boxes", config.text_boxes_threshold), over("text_area_ratio", config.text_area_threshold)
    objects, classes = over("num_objects", config.object_count_threshold), over("unique_classes", config.unique_objects_threshold)
    spread = over("dispersion", config.spatial_dispersion_threshold)
    similar = F.coalesce(F.col("similarity") >= config.clip_similarity_threshold, F.lit(False))
    assigned = rule_bin(config)

    def threshold(x: float, name: str) -> Column:
        return F.lit(x).alias(name)

    return F.struct(
        F.col("path").alias("image_path"),
        F.regexp_extract("path", r"([^/]*)$", 1).alias("filename"),
        assigned.alias("assigned_bin"),
        F.struct(
            F.col("num_boxes").alias("num_text_boxes"), threshold(config.text_boxes_threshold, "text_boxes_threshold"), boxes.alias("text_boxes_passes"),
            "text_area_ratio", threshold(config.text_area_threshold, "text_area_threshold"), area.alias("text_area_passes"), (boxes | area).alias("overall_passes"),
        ).alias("bin_a_criteria"),
        F.struct(
            "num_objects", threshold(config.object_count_threshold, "object_count_threshold"), objects.alias("object_count_passes"),
            "unique_classes", threshold(config.unique_objects_threshold, "unique_objects_threshold"), classes.alias("unique_classes_passes"),
            F.col("dispersion").alias("spatial_dispersion"), threshold(config.spatial_dispersion_threshold, "spatial_dispersion_threshold"), spread.alias("spatial_dispersion_passes"),
            (objects | classes).alias("overall_passes"),
        ).alias("bin_b_criteria"),
        F.struct(
            F.coalesce("caption", F.lit("")).alias("caption"), F.col("similarity").alias("clip_similarity"), threshold(config.clip_similarity_threshold, "clip_threshold"), similar.alias("similarity_passes"),
            (assigned == "C").alias("overall_passes"),
        ).alias("bin_c_criteria"),
    )


def flatten(df: DataFrame, column: str = "details") -> DataFrame:
    """Nested details as one wide row: bin_a_criteria.x becomes bin_a_x."""
    out = []
    for f in df.schema[column].dataType.fields:
        if f.dataType.typeName() == "struct":
            out += [F.col(f"{column}.{f.name}.{g.name}").alias(f"{f.name.removesuffix('_criteria')}_{g.name}") for g in f.dataType.fields]
        else:
            out.append(F.col(f"{column}.{f.name}"))
    return df.select(*out)


def rank_bins(df: DataFrame, ratios: tuple[float, float, float] = (0.4, 0.4, 0.2), size: int | None = None) -> DataFrame:
    """df with bin and bin_rank: the first int(size * ratio) by text area are A, then of the rest by objects B, then by similarity C.

    Ties fall back on the keys of the bins before and at last on ordinal. Rows beyond the quotas are left out; size may exceed
    the number of rows.
    """
    size = df.count() if size is None else size
    keys = [F.col("text_area_ratio").desc(), F.col("ordinal")]
    orders = [keys, [F.col("num_objects").desc(), *keys], [F.col("similarity").desc(), F.col("num_objects").desc(), *keys]]
    out, rest = None, df
    for name, ratio, order in zip(BINS, ratios, orders, strict=True):
        chosen, rest = top(rest, order, int(size * ratio))
        chosen = chosen.withColumnRenamed("__rank", "bin_rank").withColumn("bin", F.lit(name))
        out = chosen if out is None else out.unionByName(chosen)
    return out


def balance_bins(df: DataFrame, ratios: tuple[float, float, float] = (0.4, 0.4, 0.2), strict: bool = False) -> DataFrame:
    """The bins as they are (what shortages take and extras give always cancels out); strict: each bin capped at its share."""
    if not strict:
        return df
    total = df.count()
    cap = F.when(F.col("bin") == "A", int(total * ratios[0])).when(F.col("bin") == "B", int(total * ratios[1])).otherwise(int(total * ratios[2]))
    return df.filter(F.col("bin_rank") <= cap)


def bin_stage(df: DataFrame, config: BinningConfig = BinningConfig(), size: int | None = None, only_complex: bool = False) -> DataFrame:
    return rank_bins(save(df.filter(complexity_ok(config)) if only_complex else df, "bin-input"), config.ratios, size)


def with_criteria(df: DataFrame, criteria: dict[str, Column | Callable[[DataFrame], Column]]) -> DataFrame:
    """A column PASS, FAIL or ERROR (null result) for each criterion: a boolean column, or a function of df that gives one."""
    for name, c in criteria.items():
        try:
            value = c(df) if callable(c) else c
            df = df.withColumn(name, F.when(value.isNull(), "ERROR").when(value.cast("boolean"), "PASS").otherwise("FAIL"))
        except ImportError:
            raise
        except Exception:  # a criterion that cannot be built is in error for every row
            df = df.withColumn(name, F.lit("ERROR"))
    return df


def report(df: DataFrame) -> DataFrame:
    """path and report: one formatted line an image."""
    line = F.format_string(
        "%s [%s] boxes=%d area=%.4f objects=%d classes=%d dispersion=%.4f similarity=%.4f",
        F.regexp_extract("path", r"([^/]*)$", 1), rule_bin(), "num_boxes", "text_area_ratio", "num_objects", "unique_classes", "dispersion", "similarity",
    )
    return df.select("path", line.alias("report"))
