"""Box arithmetic over arrays of structs or grouped child rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = r"\[(\d+),(\d+),(\d+),(\d+)\]"
LABEL = r"(?U)(\w+(?:\s+\w+)*)\[\d+,\d+,\d+,\d+\]"


def text_area_ratio(boxes: Column, width: Column, height: Column) -> Column:
    """Sum of |w| * |h| over the image's area; overlaps count twice, so it may exceed 1. No box or no area: 0."""
    covered = F.aggregate(F.coalesce(boxes, F.array()), F.lit(0.0), lambda s, b: s + F.abs(b["x2"] - b["x1"]) * F.abs(b["y2"] - b["y1"]))
    area = width * height
    return F.when(area > 0, covered / area).otherwise(0.0)


def polygon_box(points: Column) -> Column:
    """The bounds of an array<struct<x,y>>."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"), F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2"))


def grounded_boxes(text: Column, width: Column, height: Column) -> Column:
    """Boxes "[x1,y1,x2,y2]" (no blanks) of grounded text, scaled from thousandths; the whole-image box [0,0,999,999] is left out."""

    def box(s: Column) -> Column:
        parts = [F.regexp_extract(s, BOX, i).cast("double") for i in range(1, 5)]
        sides = [width, height, width, height]
        return F.struct(*[(p * side / 1000).alias(n) for p, side, n in zip(parts, sides, ("x1", "y1", "x2", "y2"), strict=True)])

    found = F.regexp_extract_all(text, F.lit(BOX), F.lit(0))
    return F.transform(F.filter(found, lambda s: s != "[0,0,999,999]"), box)


def strip_coordinates(text: Column) -> Column:
    return F.regexp_replace(text, BOX, "")


def grounded_labels(text: Column) -> Column:
    """The distinct labels before grounded boxes, sorted."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(text, F.lit(LABEL), F.lit(1))))


def dispersion(cx: Column, cy: Column, width: Column | float, height: Column | float) -> Column:
    """Aggregate: area spanned by the centres over the image's area; no row: 0."""
    return F.coalesce((F.max(cx) - F.min(cx)) * (F.max(cy) - F.min(cy)) / (F.lit(1.0) * width * height), F.lit(0.0))


def dispersion_std(cx: Column, cy: Column, diagonal: Column | float) -> Column:
    """Aggregate: mean of the centres' population deviations over the diagonal; one box or none: 0."""
    return F.when(F.count("*") <= 1, 0.0).otherwise((F.stddev_pop(cx) + F.stddev_pop(cy)) / 2 / diagonal)


def histogram_bin(x: Column, low: Column, high: Column, bins: Column) -> Column:
    """The equal-width bin (from 0) of x in [low, high]; the top value is in the last bin, equal bounds make one bin."""
    return F.when(high == low, F.lit(0)).otherwise(F.least(F.floor((x - low) / (high - low) * bins), bins - 1)).cast("long")
