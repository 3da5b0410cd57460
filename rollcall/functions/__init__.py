"""Column functions: paths, attributes, vectors, boxes, verdicts, image sharpness."""

from .attributes import AGE_LABELS, age_group, age_group_label, cast_attributes, with_attr_defaults
from .boxes import bbox_area, unpad_detections
from .classify import classify_candidate, classify_preprocess, drop_unknown, split_valid
from .imaging import laplacian_variance
from .paths import canonical_path, round_metrics, with_output_paths, with_path_parts
from .vectors import cosine, l2_norm, l2_norm_batch, l2_normalize

__all__ = [
    "AGE_LABELS", "age_group", "age_group_label", "bbox_area", "canonical_path", "cast_attributes", "classify_candidate", "classify_preprocess",
    "cosine", "drop_unknown", "l2_norm", "l2_norm_batch", "l2_normalize", "laplacian_variance", "round_metrics", "split_valid", "unpad_detections",
    "with_attr_defaults", "with_output_paths", "with_path_parts",
]
