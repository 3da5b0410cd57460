"""Schemas of the tables that jobs read and write."""

from pyspark.sql import types as T

_STRING, _INT, _LONG, _DOUBLE, _SHORT, _BYTE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.ShortType(), T.ByteType()
_VECTOR = T.ArrayType(T.FloatType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


FILES = _struct(path=_STRING, modificationTime=T.TimestampType(), length=_LONG)
PROCESSED = _struct(original_path=_STRING, processed_path=_STRING, filename=_STRING, confidence=_DOUBLE, blur_score=_DOUBLE)
CANDIDATES = _struct(
    identity_id=_INT, trial=_INT, seed_path=_STRING, style_path=_STRING, generation_seed=_LONG, candidate_path=_STRING,
    arcface_similarity=_DOUBLE, laplacian_variance=_DOUBLE, detected_age=_INT, detected_gender=_INT, rejection_reason=_STRING,
)
MANIFEST = T.StructType([*CANDIDATES.fields, T.StructField("image_path", _STRING), T.StructField("cluster_id", _INT)])
ATTRIBUTES = _struct(image_path=_STRING, embedding=_VECTOR, age=_SHORT, gender=_BYTE, age_group=_BYTE)
CHUNKS = _struct(chunk_id=_LONG, source_images=_LONG, saved_embeddings=_LONG, failed=_LONG, chunk_start=_LONG, chunk_end=_LONG)
DATASET = _struct(image_path=_STRING, cluster_id=_INT, age_group=_BYTE, split=_STRING, forget_step=_INT)
DETECTIONS = _struct(image=_STRING, attempt=_INT, face_idx=_INT, bbox=T.ArrayType(_DOUBLE), kps=T.ArrayType(T.ArrayType(_DOUBLE)))
SCORES = _struct(embedding=_VECTOR, age=_INT, gender=_INT, confidence=_DOUBLE, error=_STRING)
