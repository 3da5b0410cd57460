"""Batch scoring of images by any model: one load in each task, one call for images of a shape, failures kept apart row by row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.imaging import sharpness_of
from ..schemas import SCORES
from ..storage import ship

#: A scorer takes a decoded BGR image and returns embedding, age, gender, confidence; None: no face.
#: One marked by ``batched`` takes a stack (images, height, width, channels) and returns a list of these.
Scorer = Callable[[np.ndarray], dict | None | list[dict | None]]

#: Bytes of pixels in one call of a scorer; a larger image is a call of its own.
CALL_BYTES = 64 << 20
_FIELDS = {"embedding": pa.list_(pa.float32()), "age": pa.int32(), "gender": pa.int32(), "confidence": pa.float64()}


def batched(scorer: Callable[[np.ndarray], list[dict | None]]) -> Scorer:
    """Mark a scorer that takes stacks of images of one shape."""
    scorer.batched = True
    return scorer


def stacks(shapes: list[tuple[int, int, int]], most: int) -> Iterator[tuple[tuple[int, int, int], list[int]]]:
    """(shape, rows): rows of each shape in runs of at most ``most`` bytes, rows with an empty shape left out."""
    groups: dict[tuple, list[int]] = {}
    for row, shape in enumerate(shapes):
        if shape:
            groups.setdefault(shape, []).append(row)
    for shape, rows in groups.items():
        many = max(1, most // max(1, int(np.prod(shape))))
        for at in range(0, len(rows), many):
            yield shape, rows[at : at + many]


def call(scorer: Scorer, stack: np.ndarray, on_error: str = "flag") -> list[tuple[dict | None, str | None]]:
    """(result, error) of each image of a stack. A call that fails is halved until the images that make it fail are alone."""
    try:
        found = scorer(stack) if getattr(scorer, "batched", False) else [scorer(stack[0])] if len(stack) == 1 else None
        if found is not None:
            if len(found) != len(stack):
                raise ValueError(f"{len(found)} results for {len(stack)} images")
            return [(f, None) for f in found]
    except Exception as e:
        if len(stack) == 1:
            if on_error == "raise":
                raise
            return [(None, f"{type(e).__name__}: {e}")]
    half = len(stack) // 2
    return call(scorer, stack[:half], on_error) + call(scorer, stack[half:], on_error)


def score_images(images: DataFrame, scorer_factory: Callable[[], Scorer], on_error: str = "flag", profile=None, sharp: bool = False, call_bytes: int = CALL_BYTES) -> DataFrame:
    """(path, readable, embedding, age, gender, confidence, error) of every image (path, readable, image).

    With ``sharp`` also laplacian_variance, from the same pass over the pixels; null if it can't be read.

    ``scorer_factory`` is called once in each task. An image without a face has nulls; one that can't be
    read isn't scored; one that the scorer fails on has error set, or ends the job with ``on_error`` 'raise'; the
    others of its call are scored all the same. ``profile`` is a ResourceProfile, say of one GPU for each task.
    """
    ship(images.sparkSession)
    rows = images.selectExpr("path", "readable", "image.height as height", "image.width as width", "image.nChannels as channels", "image.data as data")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCORES.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_factory()
        for b in batches:
            readable, height, width, channels = (b.column(k).to_pylist() for k in range(1, 5))
            shapes = [(h, w, c) if ok else () for ok, h, w, c in zip(readable, height, width, channels, strict=True)]
            results: list[tuple[dict | None, str | None]] = [(None, None)] * b.num_rows
            variance: list[float | None] = [None] * b.num_rows
            for shape, which in stacks(shapes, call_bytes):
                stack = np.stack([np.frombuffer(b.column(5)[k].as_buffer(), np.uint8).reshape(shape) for k in which])
                for k, got in zip(which, call(scorer, stack, on_error), strict=True):
                    results[k] = got
                if sharp:
                    for k, v in zip(which, sharpness_of(stack), strict=True):
                        variance[k] = v
            columns = [pa.array([(f or {}).get(name) for f, _ in results], kind) for name, kind in _FIELDS.items()]
            columns = [b.column(0), b.column(1), *columns, pa.array([e for _, e in results], pa.string())]
            names = ["path", "readable", *_FIELDS, "error"]
            if sharp:
                columns, names = [*columns, pa.array(variance, pa.float64())], [*names, "laplacian_variance"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, f"path string, readable boolean, {fields}{', laplacian_variance double' if sharp else ''}", profile=profile)


def stub_scorer(dim: int = 8) -> Callable[[], Scorer]:
    """A deterministic scorer for tests, of stacks or one image: features of the pixels, no face in a black image."""

    def factory() -> Scorer:
        @batched
        def score(stack: np.ndarray) -> list[dict | None] | dict | None:
            if stack.ndim == 3:
                return score(stack[None])[0]
            flat = stack.reshape(len(stack), -1).astype(np.float32)
            parts = np.stack([p.mean(1) for p in np.array_split(flat, dim, axis=1)], 1)
            mean, top = flat.mean(1), flat.max(1)
            return [{"embedding": parts[k].tolist(), "age": int(mean[k]) % 90, "gender": int(stack.shape[1]) % 2, "confidence": min(1.0, float(top[k]) / 255)} if top[k] else None for k in range(len(stack))]

        return score

    return factory
