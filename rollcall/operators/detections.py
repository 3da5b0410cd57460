"""The best face of an image out of all detections of all attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.boxes import bbox_area


def best_detection(df: DataFrame, policy: str = "largest_area", image: str = "image") -> DataFrame:
    """One row for each image: of its first attempt with a face, the largest box (of equals the first face), or the first face.

    Adds area and faces, the number of faces of that attempt. One scan, two aggregations that narrow it down; no join and no window.
    """
    area = F.coalesce(bbox_area(F.col("bbox")), F.lit(0.0))
    choice = F.struct(*([area.alias("b")] if policy == "largest_area" else []), (-F.col("face_idx")).alias("c"))
    kept = [c for c in df.columns if c not in (image, "attempt")]
    each = df.withColumn("area", area).groupBy(image, "attempt").agg(F.max_by(F.struct(*kept, "area"), choice).alias("_best"), F.count("*").alias("faces"))
    first = each.groupBy(image).agg(F.min_by(F.struct("attempt", "_best", "faces"), "attempt").alias("_first"))
    return first.select(image, "_first.attempt", "_first._best.*", "_first.faces")


def without_detection(images: DataFrame, detections: DataFrame, image: str = "image") -> DataFrame:
    """Images in which no attempt found a face."""
    return images.join(detections.select(image).distinct(), image, "left_anti")
