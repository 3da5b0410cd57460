"""The plan of candidates, their seed vectors and similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine, l2_norm, l2_normalize, usable_norm
from ..storage import ship


def plan_candidates(seeds: DataFrame, per_identity: int, seed: int = 42) -> DataFrame:
    """One row for each (identity, trial) with the number that seeds its generation; no cross join."""
    grid = seeds.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(per_identity - 1))))
    number = F.lit(seed).cast("long") + F.col("identity_id").cast("long") * per_identity + F.col("trial")
    return grid.withColumn("generation_seed", number)


def style_index(per_identity: int, styles: int | Column) -> Column:
    place = F.col("identity_id").cast("long") * per_identity + F.col("trial")
    return F.pmod(place, F.lit(styles) if isinstance(styles, int) else styles).cast("int")


def attach_style(plan: DataFrame, styles: DataFrame, per_identity: int) -> DataFrame:
    """Adds the style that stands at (identity * per_identity + trial) modulo the number of styles."""
    n = styles.count()
    if not n:
        raise ValueError("no styles")
    return plan.withColumn("style_idx", style_index(per_identity, n)).join(styles, "style_idx")


def seed_vectors(seeds: DataFrame, strict: bool = True, vector: str = "embedding") -> DataFrame:
    """(identity_id, seed_unit); with ``strict`` the job that reads a seed without a usable vector ends with its identity."""
    unit = l2_normalize(F.col(vector))
    if strict:
        unit = F.coalesce(unit, F.raise_error(F.concat(F.lit("seed without a usable embedding: identity "), F.col("identity_id").cast("string"))).cast("array<double>"))
    return seeds.select("identity_id", unit.alias("seed_unit"))


def attach_seed(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """Each candidate with its identity's seed vector."""
    return candidates.join(seeds, "identity_id", "left")


def with_similarity(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Adds norm and arcface_similarity (null without a usable vector)."""
    norm = l2_norm(F.col(vector))
    return df.withColumn("norm", norm).withColumn("arcface_similarity", F.when(usable_norm(norm), cosine(F.col("seed_unit"), F.col(vector))))


def with_similarity_in_blocks(df: DataFrame, vector: str = "embedding", seed: str = "seed_unit") -> DataFrame:
    """The columns of ``with_similarity`` for wide vectors: sums of a whole Arrow batch at a time instead of element by element.

    Vectors of a batch that have the length most have are one matrix; others go one by one. A length other than the seed's is an error.
    """
    ship(df.sparkSession)
    names = [c for c in df.columns if c not in ("norm", "arcface_similarity")]
    others = [c for c in names if c not in (vector, seed)]
    row = F.struct(*others) if others else F.struct(F.lit(0).alias("none"))
    rows = df.select(row.alias("row"), F.col(vector).alias("v"), F.col(seed).alias("s"))

    def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows with a vector, their values as a matrix, whether each value is there) of a list column whose vectors have one length."""
        full = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        flat = column.drop_null().flatten()
        values = pc.fill_null(flat.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
        return full, values.reshape(len(full), -1), flat.is_valid().to_numpy(zero_copy_only=False).reshape(len(full), -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            norm, same = np.zeros(n), np.zeros(n)
            has_norm, has_same = np.zeros(n, bool), np.zeros(n, bool)
            lengths = pc.fill_null(pc.list_value_length(b.column(1)), -1).to_numpy(zero_copy_only=False)
            for size in np.unique(lengths[lengths > 0]):
                here = np.flatnonzero(lengths == size)
                part = b if len(here) == n else b.take(pa.array(here))
                _, v, there = matrix(part.column(1))
                norm[here], has_norm[here] = np.sqrt(np.einsum("ij,ij->i", v, v)), there.all(1)
                seeded, s, there = matrix(part.column(2))
                if len(seeded):
                    at, length = here[seeded], np.sqrt(np.einsum("ij,ij->i", s, s))
                    usable = has_norm[at] & there.all(1) & (norm[at] > 0) & (length > 0)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        same[at] = np.einsum("ij,ij->i", v[seeded], s) / (norm[at] * length)
                    has_same[at] = usable
            has_norm[lengths == 0] = True
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norm, mask=~has_norm), pa.array(same, mask=~has_same)], names=["row", "v", "s", "norm", "arcface_similarity"])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("row", "v", "s"))
    found = rows.mapInArrow(run, f"{kinds}, norm double, arcface_similarity double")
    back = {vector: F.col("v"), seed: F.col("s")}
    return found.select(*(back.get(c, F.col("row")[c]).alias(c) for c in names), "norm", "arcface_similarity")
