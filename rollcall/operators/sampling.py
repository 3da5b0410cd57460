"""Deterministic sampling and ranking of entities by a seeded hash, the same in every engine and partitioning."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Up to so many rows are taken by a top-n; beyond that hash prefixes are counted first.
TOP_ROWS = 100_000
#: Distinct ids up to which a shuffle in the order of NumPy is offered.
NUMPY_ROWS = 1_000_000


def hash_order(key: Column, seed: int) -> Column:
    """md5 of 'seed:key' as hex text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def first_by_hash(df: DataFrame, n: int, seed: int, key: str, top_rows: int = TOP_ROWS) -> DataFrame:
    """The n rows that come first by hash of ``key`` (then by key), with hash_rank from 0.

    A small n is one distributed top-n. For a large one, rows are counted by the first four hex digits:
    whole prefixes are taken, and only the prefix on the border is ranked inside.
    """
    order = hash_order(F.col(key), seed)
    if n <= top_rows:
        top = df.withColumn("_order", order).orderBy("_order", key).limit(n)
        return top.withColumn("hash_rank", F.row_number().over(Window.orderBy("_order", key)) - 1).drop("_order")
    marked = df.withColumn("_order", order).withColumn("_prefix", F.substring("_order", 1, 4))
    counts = marked.groupBy("_prefix").count()
    before = counts.select("_prefix", F.coalesce(F.sum("count").over(Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    # 65,536 prefixes at most: a bounded table
    near = marked.join(F.broadcast(before.where(F.col("_before") < n)), "_prefix")
    place = F.row_number().over(Window.partitionBy("_prefix").orderBy("_order", key)) - 1
    return near.withColumn("hash_rank", F.col("_before") + place).where(F.col("hash_rank") < n).drop("_order", "_prefix", "_before")


def sample_cap(df: DataFrame, n: int | None, seed: int = 42, key: str = "path") -> DataFrame:
    """At most n rows, a uniform sample without replacement; 0 or None is no cap."""
    if not n:
        return df
    return first_by_hash(df, n, seed, key).drop("hash_rank")


def split_pools(df: DataFrame, n: int, seed: int = 42, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """(seeds with identity_id, styles with style_idx): the first n by hash, and the next n."""
    if df.limit(2 * n).count() < 2 * n:
        raise ValueError(f"two pools of {n} need {2 * n} rows")
    both = first_by_hash(df, 2 * n, seed, key)
    seeds = both.where(F.col("hash_rank") < n).withColumn("identity_id", F.col("hash_rank").cast("int")).drop("hash_rank")
    styles = both.where(F.col("hash_rank") >= n).withColumn("style_idx", (F.col("hash_rank") - n).cast("int")).drop("hash_rank")
    return seeds, styles


def numpy_order(ids: DataFrame, key: str, seed: int, library: str = "numpy") -> DataFrame:
    """Ids with the rank that NumPy's RandomState (or Python's random) gives by shuffling the sorted list; for small sets only."""
    n = ids.count()
    if n > NUMPY_ROWS:
        raise ValueError(f"{n} ids are too many for an order made on the driver; use hash order")
    listed = [r[0] for r in ids.select(key).orderBy(key).collect()]
    if library == "numpy":
        import numpy as np

        np.random.RandomState(seed).shuffle(listed)
    else:
        random.Random(seed).shuffle(listed)
    kind = ids.schema[key].dataType.simpleString()
    return ids.sparkSession.createDataFrame(list(enumerate(listed)), f"hash_rank int, {key} {kind}")


def inspection_sample(accepted: DataFrame, ids: int = 6, each: int = 9, seed: int = 42) -> DataFrame:
    """Up to ``ids`` identities and of each the first ``each`` accepted rows."""
    chosen = first_by_hash(accepted.select("identity_id").distinct(), ids, seed, "identity_id")
    return accepted.where(F.col("accepted_idx") < each).join(F.broadcast(chosen), "identity_id")
