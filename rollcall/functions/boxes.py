"""Face boxes: area, and the way back from padded coordinates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bbox_area(bbox: Column) -> Column:
    return (bbox[2] - bbox[0]) * (bbox[3] - bbox[1])


def unpad_detections(df: DataFrame) -> DataFrame:
    """bbox and kps in coordinates of the image itself. Needs height, width and ratio (0, 0.25 or 0.5 of padding)."""
    px, py = (F.floor(F.col(c) * F.col("ratio")).cast("double") for c in ("width", "height"))
    box = F.col("bbox")
    moved = F.array(box[0] - px, box[1] - py, box[2] - px, box[3] - py)
    points = F.transform("kps", lambda p: F.array(p[0] - px, p[1] - py))
    return df.withColumn("bbox", moved).withColumn("kps", points)
