"""Connected components of an edge table as Spark jobs: no edge or label ever reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, release

#: Edges that a task contracts at a time.
BLOCK = 1 << 16


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n rows the smallest row that the pairs connect it with."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            la, lb = label[a], label[b]
            low = np.minimum(la, lb)
            if np.array_equal(la, lb):
                break
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while not np.array_equal(hop := label[label], label):
                label = hop
    return label


def contracted(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """The edges (v, u), v > u, of a written table with each block of them replaced by stars around the least nodes it connects.

    The components stay as they are. A task works on as many blocks as its partition has, one after the other;
    small partitions are read together, so that blocks are full.
    """

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ends = pa.concat_arrays([*table.column("v").chunks, *table.column("u").chunks])
        nodes = pc.unique(ends)
        nodes = nodes.take(pc.sort_indices(nodes))
        at = pc.index_in(ends, nodes).to_numpy(zero_copy_only=False)
        label = forest(len(nodes), iter([(at[: table.num_rows], at[table.num_rows :])]))
        rows = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(rows)), nodes.take(pa.array(label[rows]))], names=["v", "u"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                if n + part.num_rows > block:
                    yield stars(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield stars(held)

    kind = edges.schema["v"].dataType.simpleString()
    return edges.coalesce(max(1, -(-edges.count() // block))).mapInArrow(run, f"v {kind}, u {kind}")


def are_stars(edges: DataFrame) -> bool:
    """Whether each v has one edge and is no other's u."""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionAll(edges.select(F.col("u").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return seen.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", block: int = BLOCK) -> DataFrame:
    """(node, component) for each node of an edge, component being the smallest node reachable.

    Edges are contracted in blocks within tasks; while the stars of different blocks still meet, a large-star and a
    small-star step (Kiveris et al., 2014) join them, which takes a logarithmic number of rounds. Each round is
    two aggregations to a minimum (partial sums first, so hub nodes don't meet in one task) and two joins; its
    result is written to the shared folder and replaces the one before. Nulls and self loops are ignored;
    no edges give no rows.
    """
    x, y = F.col(a), F.col(b)
    now = materialize(edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("v"), F.least(x, y).alias("u")))
    while True:
        last, now = now, materialize(contracted(now, block))
        release(last)
        if are_stars(now):
            break
        both = now.select(F.col("v").alias("p"), F.col("u").alias("q")).unionAll(now.select(F.col("u").alias("p"), F.col("v").alias("q")))
        least = both.groupBy("p").agg(F.least(F.min("q"), F.col("p")).alias("m"))
        # large star: each larger neighbour points at the least of the neighbourhood
        large = materialize(both.where("q > p").join(least, "p").select(F.col("q").alias("v"), F.col("m").alias("u")).where("v != u"))
        # small star: smaller neighbours and the node itself point at the least of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(low, "v")
        small = joined.select(F.col("u").alias("v"), F.col("m").alias("u")).unionAll(low.select("v", F.col("m").alias("u"))).where("v != u").distinct()
        last, now = now, materialize(small)
        release(last, large)
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).unionAll(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
