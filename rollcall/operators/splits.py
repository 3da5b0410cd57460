"""Splits by entity and the schedule of what is forgotten when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import require_plan
from .sampling import first_by_hash, numpy_order


def distinct_ids(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    return df.select(key).distinct()


def forget_schedule(ranked: DataFrame, n_forget: int, per_step: int = 1) -> DataFrame:
    """Forget steps of the first n_forget ranks, ``per_step`` identities in each."""
    return ranked.where(F.col("hash_rank") < n_forget).withColumn("forget_step", F.floor(F.col("hash_rank") / per_step).cast("int"))


def special_ids(ids: DataFrame, n_forget: int, n_test: int, seed: int = 42, key: str = "cluster_id", per_step: int = 1, order: str = "md5") -> DataFrame:
    """(key, hash_rank, split, forget_step) of the forget and test identities only: n_forget + n_test rows.

    Everything else is retained, so no list of all identities is ordered. ``order`` 'numpy' or 'python'
    shuffles like those libraries, for sets that fit the driver.
    """
    require_plan(identities=ids.count(), n_forget=n_forget, n_test=n_test)
    ranked = first_by_hash(ids, n_forget + n_test, seed, key) if order == "md5" else numpy_order(ids, key, seed, order).where(F.col("hash_rank") < n_forget + n_test)
    out = ranked.withColumn("split", F.when(F.col("hash_rank") < n_forget, "forget").otherwise("test"))
    steps = forget_schedule(ranked, n_forget, per_step).select(key, "forget_step")
    return out.join(steps, key, "left").withColumn("forget_step", F.coalesce("forget_step", F.lit(-1)))


def apply_split(df: DataFrame, special: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Adds split ('retain' for ids that aren't special) and forget_step (-1 where nothing is forgotten)."""
    known = special.select(key, F.col("split").alias("_split"), F.col("forget_step").alias("_step"))
    joined = df.join(known, key, "left")
    return joined.withColumn("split", F.coalesce("_split", F.lit("retain"))).withColumn("forget_step", F.coalesce("_step", F.lit(-1)).cast("int")).drop("_split", "_step")


def assign_splits(ids: DataFrame, n_forget: int, n_test: int, seed: int = 42, key: str = "cluster_id") -> DataFrame:
    """(key, split, forget_step) of every id."""
    return apply_split(ids, special_ids(ids, n_forget, n_test, seed, key), key)
