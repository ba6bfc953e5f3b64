"""Features of images from detections, texts and embeddings; unavailable scorers and errors give the stated defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X


def with_text_features(df: DataFrame, boxes: str = "boxes") -> DataFrame:
    """num_boxes and text_area_ratio; null boxes (an error): 0 and 0.0."""
    return df.withColumns({"num_boxes": F.coalesce(F.size(boxes), F.lit(0)).cast("int"), "text_area_ratio": G.text_area_ratio(F.col(boxes), F.col("width"), F.col("height"))})


def object_features(images: DataFrame, detections: DataFrame, key: str, width: str = "width", height: str = "height") -> DataFrame:
    """images with num_objects, unique_classes and dispersion of their detections (key, cls, cx, cy); without any: 0, 0, 0.0."""
    found = detections.groupBy(key).agg(
        F.count("*").alias("num_objects"), F.countDistinct("cls").alias("unique_classes"), (F.max("cx") - F.min("cx")).alias("__dx"), (F.max("cy") - F.min("cy")).alias("__dy")
    )
    return (
        images.join(found, key, "left")
        .withColumn("dispersion", F.coalesce(F.col("__dx") * F.col("__dy") / (F.lit(1.0) * F.col(width) * F.col(height)), F.lit(0.0)))
        .withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("num_objects", "unique_classes")})
        .drop("__dx", "__dy")
    )


def area_classes(detections: DataFrame, key: str, area: str = "area") -> DataFrame:
    """Per key: num_objects and unique_classes, the non-empty bins of an equal-width histogram of the areas (min(10, n) bins)."""
    bounds = detections.groupBy(key).agg(F.count("*").alias("num_objects"), F.min(area).alias("__low"), F.max(area).alias("__high"))
    k = F.least(F.lit(10), F.col("num_objects"))
    return (
        detections.join(bounds, key)
        .groupBy(key)
        .agg(F.first("num_objects").alias("num_objects"), F.countDistinct(G.histogram_bin(F.col(area), F.col("__low"), F.col("__high"), k)).alias("unique_classes"))
    )


def text_content(lines: Column) -> Column:
    """The texts of an array, stripped, blank ones left out, joined by a blank."""
    return F.array_join(F.filter(F.transform(lines, X.strip), lambda s: s != ""), " ")


def text_content_unified(text: Column) -> Column:
    """Recognised text without its coordinate tags, lines stripped and joined."""
    return text_content(F.split(G.strip_coordinates(text), "\n"))


def caption_unified(text: Column) -> Column:
    return F.coalesce(X.strip(G.strip_coordinates(text)), F.lit(""))


def class_names(classes: Column, names: dict[int, str]) -> Column:
    """Sorted distinct names of class numbers; unknown ones are class_<i>."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv]) if names else F.create_map().cast("map<int,string>")
    return F.sort_array(F.array_distinct(F.transform(classes, lambda c: F.coalesce(F.try_element_at(known, c), F.concat(F.lit("class_"), c.cast("string"))))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; a zero or null vector gives 0."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return F.coalesce(dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0)), F.lit(0.0))


def caption_similarity(image: Column, caption: Column, text: Column, available: bool = True) -> Column:
    """Cosine of image and caption embeddings; an empty caption 0.0; no model at all 1.0 (for a caption that isn't empty)."""
    return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(cosine(image, caption) if available else F.lit(1.0))
