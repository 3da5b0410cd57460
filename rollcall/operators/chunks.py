"""Chunks by global position, and what each of them holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import settle
from .joins import require_plan


def with_position(df: DataFrame, *keys: str) -> DataFrame:
    """Adds position: the place of each row in the order of ``keys``, from 0.

    Rows are dealt out by range, counted by part, and numbered inside their part: no task holds them all.
    """
    ranged = settle(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").count()
    before = counts.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) - 1
    return ranged.join(before, "_part").withColumn("position", (F.col("_before") + place).cast("long")).drop("_part", "_before")


def assign_chunks(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """Adds position and chunk_id (from 1)."""
    require_plan(chunk_size=size)
    return with_position(df, *keys).withColumn("chunk_id", (F.floor(F.col("position") / size) + 1).cast("long"))


def chunk_manifest(df: DataFrame, saved: Column) -> DataFrame:
    """One row for each chunk: rows, saved and failed ones, first position and the one after the last."""
    return df.groupBy("chunk_id").agg(
        F.count("*").alias("source_images"),
        F.count_if(saved).alias("saved_embeddings"),
        F.count_if(~saved).alias("failed"),
        F.min("position").alias("chunk_start"),
        (F.max("position") + 1).alias("chunk_end"),
    )
