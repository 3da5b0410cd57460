"""Outcome of a source image and verdict of a candidate. Values equal to a threshold pass."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import usable_norm

# Outcomes of a source image, verdicts of a candidate.
OUTCOMES = ["success", "no_face", "low_conf", "blurry", "error"]
VERDICTS = ["accepted", "no_face", "invalid_embedding", "low_similarity", "blur", "no_face+blur", "invalid_embedding+blur", "low_similarity+blur", "unreadable_image"]


def classify_preprocess(confidence: Column, blur: Column, conf_threshold: float = 0.85, blur_threshold: float = 80.0, error: Column | None = None) -> Column:
    """The first rule that applies: error, no face (null confidence), low confidence, blurry; else success."""
    out = F.when(confidence.isNull(), "no_face").when(confidence < conf_threshold, "low_conf").when(blur < blur_threshold, "blurry").otherwise("success")
    return out if error is None else F.when(error.isNotNull(), "error").otherwise(out)


def classify_candidate(has_face: Column, norm: Column, similarity: Column, blur: Column, min_similarity: float = 0.45, blur_threshold: float = 80.0, readable: Column | None = None, reject_nan: bool = False) -> Column:
    """All reasons joined by +, the identity reason first; 'accepted' without any; 'unreadable_image' stands alone.

    A NaN norm is an invalid embedding. A NaN similarity isn't below the threshold, unless ``reject_nan``.
    """
    low = similarity < min_similarity
    if reject_nan:
        low = low | F.isnan(similarity)
    identity = F.when(~has_face, "no_face").when(~usable_norm(norm), "invalid_embedding").when(low, "low_similarity")
    reasons = F.coalesce(F.nullif(F.concat_ws("+", identity, F.when(blur < blur_threshold, "blur")), F.lit("")), F.lit("accepted"))
    return reasons if readable is None else F.when(readable, reasons).otherwise("unreadable_image")


def drop_unknown(df: DataFrame) -> DataFrame:
    """Rows with a known age group; to be applied after the split is assigned."""
    return df.where(F.col("age_group") != -1)


def split_valid(df: DataFrame, readable: Column, has_face: Column) -> DataFrame:
    """Adds saved: the image could be read and a face was found. Count both sides with count_if."""
    return df.withColumn("saved", F.coalesce(readable & has_face, F.lit(False)))
