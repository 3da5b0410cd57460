"""Joins with guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _counted(df: DataFrame, key: str, name: str) -> DataFrame:
    """Adds how many rows have the row's key; the exchange by key serves a join on it too."""
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(key)))


def join_one_to_one(left: DataFrame, right: DataFrame, key: str, complete: bool = False) -> DataFrame:
    """Inner join that ends with an error at a key that repeats, naming its sides, and with ``complete`` at a left key without match.

    The checks are in the join's own plan: keys are counted where the join brings them together, so each side is shuffled once
    and nothing runs before the result is asked for. The join is an outer one inside, to see keys that repeat without a match.
    """
    joined = _counted(left, key, "_left").join(_counted(right, key, "_right"), key, "full_outer")
    many_left, many_right = F.col("_left") > 1, F.col("_right") > 1
    side = F.when(many_left & many_right, "left and the right").when(many_left, "left").otherwise("right")
    stop = lambda text: F.raise_error(text).cast("boolean")
    check = F.when(many_left | many_right, stop(F.concat(F.lit("keys are not unique in the "), side, F.lit(" side: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    if complete:
        check = check.when(F.col("_right").isNull(), stop(F.concat(F.lit("rows have no match: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))))
    return joined.where(check.otherwise(F.col("_left").isNotNull() & F.col("_right").isNotNull())).drop("_left", "_right")


def missing_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` that ``right`` has no match for."""
    return left.join(right.select(key), key, "left_anti")


def require_complete(left: DataFrame, right: DataFrame, key: str) -> None:
    """An error with the number of rows without match; a job of its own. Where the rows are joined anyway, ``join_one_to_one`` checks on the way."""
    n = missing_rows(left, right, key).count()
    if n:
        raise ValueError(f"{n} rows have no match")


def require_plan(chunk_size: int | None = None, candidates: int | None = None, images: int | None = None, sources: int | None = None, identities: int | None = None, n_forget: int | None = None, n_test: int | None = None) -> None:
    """Preconditions of the jobs; each is checked where its numbers are given."""
    if chunk_size is not None and chunk_size <= 0:
        raise ValueError("chunk_size must be positive")
    if candidates is not None and images is not None and candidates < images:
        raise ValueError("candidates per identity must be at least images per identity")
    if sources is not None and identities is not None and sources < 2 * identities:
        raise ValueError("the pool needs two images for each identity")
    if identities is not None and n_forget is not None and n_test is not None and n_forget + n_test >= identities:
        raise ValueError("forget and test identities must leave some to retain")
