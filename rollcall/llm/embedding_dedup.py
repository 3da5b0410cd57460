"""Near-duplicate embeddings by exhaustive tiled comparison in principal axes, with early stops.

Equal vectors form a class first; one row of each class is compared. Unit vectors are rotated into the
principal axes of the whole table (its second moments are summed in Spark), so leading coordinates hold
most of every product. Tiles of at most ``TILE`` classes are cut from the order of the first coordinate, among
equal ones by a number of the class. For a pair of tiles the products of the leading coordinates are accumulated a few dimensions at a time; what
is missing is at most the product of the two suffix norms, and a pair of vectors is dropped as soon as
sum and bound together can't reach the threshold. Two tiles whose first coordinates are further apart
than sqrt(2 - 2 * threshold) never meet. Survivors get their full cosine in double precision.

Tiles are written once, as files in the shared folder; a pair of tiles is a row with two names, so what is shuffled doesn't grow with the
number of pairs. Pairs of vectors are looked at a bounded number at a time, also where all of two tiles are near copies of each other.
Only counts of links and a spanning forest leave a pair of tiles, never all its links.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing: n_links 0 and
a component of their own. Vectors of different lengths don't link. Equal rows are vectors of their own and
link with each other. A null vec_id takes part in links, and component_id is the smallest non-null one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, prepare
from .components import connected_components, forest
from .shared_arrays import arrays_folder, forget, get, put

#: Cosine that links, classes of one tile, dimensions of the first step (each step doubles them).
THRESHOLD, TILE, FIRST_DIMS = 0.95, 4096, 16
#: Tiles that one task cuts from its part of the order.
TILES = 16
#: Numbers that pairs of vectors looked at together hold on each side, pairs of tiles in a task.
PAIR_CELLS, TASK_PAIRS = 1 << 22, 16
#: Rounding allowed for when pairs are dropped early; the last test uses none.
MARGIN = 1e-9


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def unit_rows(vectors: DataFrame, vector: str, key: str) -> DataFrame:
    """(k, cls, v): class of equal vectors (hash of all components) and the components as doubles; both null for vectors that never link."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).alias("k"), F.when(usable, v).alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.column(1).to_pylist()
            names = [None if x is None else hashlib.blake2b(np.asarray(x, np.float64).tobytes(), digest_size=16).digest() for x in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), batch.column(1)], names=["k", "cls", "v"])

    return rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, cls binary, v array<double>")


def principal_axes(units: DataFrame, d: int) -> np.ndarray:
    """Columns: directions of falling second moment. The d * d sums are taken in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d)), pa.array(total.ravel())], names=["cell", "s"])

    cells = units.select("v").mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    moments = np.zeros(d * d)
    for r in cells:
        moments[r["cell"]] = r["s"]
    _, axes = np.linalg.eigh(moments.reshape(d, d))
    return axes[:, ::-1]


def close_blocks(x: np.ndarray, y: np.ndarray, same: bool, threshold: float = THRESHOLD, first: int = FIRST_DIMS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i of x, j of y; i < j if both are the same tile) with cosine at or above the threshold, some at a time. Unit rows, principal axes."""
    d = x.shape[1]
    head, most = min(first, d), max(1, PAIR_CELLS // d)
    x0, y0 = x[:, :head].astype(np.float32), y[:, :head].astype(np.float32)
    tail = [np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", z[:, :head], z[:, :head]))).astype(np.float32) for z in (x, y)]
    # the suffix norms ride along as one more dimension: the product is then partial sum plus bound
    left, right = np.column_stack([x0, tail[0]]), np.column_stack([y0, tail[1]]).T.copy()
    for lo in range(0, len(x), 256):
        maybe = left[lo : lo + 256] @ right >= np.float32(threshold - 1e-5)
        whole = 8 * np.count_nonzero(maybe) > maybe.size
        if whole:  # one product is cheaper than many pairs
            maybe = x[lo : lo + 256] @ y.T >= threshold - MARGIN
        all_i, all_j = np.nonzero(maybe)
        all_i += lo
        if same:
            all_i, all_j = all_i[all_i < all_j], all_j[all_i < all_j]
        for at in range(0, len(all_i), most):
            i, j = all_i[at : at + most], all_j[at : at + most]
            yield (i, j) if whole else _narrowed(x, y, i, j, head, threshold)


def _narrowed(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, head: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that sum and bound don't rule out, twice as many dimensions in each step."""
    d, dims, partial = x.shape[1], head, None
    while len(i) and dims < d:
        to = min(d, 2 * dims)
        if partial is None:
            partial = np.einsum("ij,ij->i", x[i, :dims], y[j, :dims])
        partial = partial + np.einsum("ij,ij->i", x[i, dims:to], y[j, dims:to])
        dims = to
        if dims < d:
            left_norm = np.sqrt(np.maximum(0, np.einsum("ij,ij->i", x[i, dims:], x[i, dims:])))
            right_norm = np.sqrt(np.maximum(0, np.einsum("ij,ij->i", y[j, dims:], y[j, dims:])))
            good = partial + left_norm * right_norm >= threshold - MARGIN
            i, j, partial = i[good], j[good], partial[good]
    return i, j


def close(x: np.ndarray, y: np.ndarray, same: bool, threshold: float = THRESHOLD, first: int = FIRST_DIMS) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``close_blocks`` together."""
    found = [*close_blocks(x, y, same, threshold, first)] or [(np.zeros(0, int), np.zeros(0, int))]
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def _rotated(raw: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors in principal axes."""
    return raw @ axes / np.linalg.norm(raw, axis=1, keepdims=True)


def _pair_links(tiles: list[dict], axes: np.ndarray, threshold: float) -> pa.Table:
    """Links of one pair of tiles, or of one tile: (node, other, n): n links counted for node; other: a link of the forest, or null.

    Tiles lie as they were given (32 bits a component if the column has floats) and are rotated here.
    """
    ids, many = [t["ids"] for t in tiles], [t["many"] for t in tiles]
    raw = [t["raw"].astype(np.float64).reshape(-1, len(axes)) for t in tiles]
    units = [_rotated(x, axes) for x in raw]
    same = len(tiles) == 1
    a, b = 0, len(tiles) - 1
    base = 0 if same else len(ids[a])
    names = ids[a] if same else np.concatenate(ids)
    squares = [np.einsum("ij,ij->i", x, x) for x in raw]
    n = np.zeros(len(names))

    def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i, j in close_blocks(units[a], units[b], same, threshold):
            cosine = np.einsum("ij,ij->i", raw[a][i], raw[b][j]) / np.sqrt(squares[a][i] * squares[b][j])
            i, j = i[cosine >= threshold], j[cosine >= threshold]
            n[:] += np.bincount(i, many[b][j], len(names)) + np.bincount(j + base, many[a][i], len(names))
            yield i, j + base

    label = forest(len(names), links())
    full = np.flatnonzero(n)
    other = [int(names[label[k]]) if label[k] != k else None for k in full]
    return pa.table({"node": pa.array(names[full]), "other": pa.array(other, pa.int64()), "n": pa.array(n[full].astype(np.int64))})


def _links(classes: DataFrame, d: int, kind: type, threshold: float, tile: int) -> DataFrame:
    """(node, other, n) over classes (c, many, v) of vectors with d components that ``kind`` holds exactly."""
    axes = principal_axes(classes, d)
    folder = arrays_folder(classes.sparkSession)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _matrix(batch.column(2), d)
            packed = pa.array([r.tobytes() for r in raw.astype(kind)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_rotated(raw, axes)[:, 0]), packed], names=["c", "many", "lead", "raw"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles of at most ``tile`` rows, in the order in which they come, as files."""
        held: list[pa.RecordBatch] = []

        def emit() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            lead = table["lead"].to_numpy()
            held.clear()
            body = {name: table[x].to_numpy().astype(np.int64) for name, x in (("ids", "c"), ("many", "many"))}
            file = put(folder, body | {"raw": np.frombuffer(b"".join(table["raw"].to_pylist()), kind)})
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (float(lead[0]), float(lead[-1]), file)], names=["low", "high", "file"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, tile - sum(map(len, held)))
                held.append(part)
                at += part.num_rows
                if sum(map(len, held)) == tile:
                    yield emit()
        if held:
            yield emit()

    turned = materialize(classes.select("c", "many", "v").mapInArrow(rotate, "c long, many long, lead double, raw binary"))
    parts = max(1, -(-turned.count() // (tile * TILES)))
    ordered = turned.repartitionByRange(parts, "lead", "c").sortWithinPartitions("lead", "c")
    tiles = ordered.mapInArrow(pack, "low double, high double, file string")
    # tiles are numbered in the order of their first coordinates, by a table of one small row for each
    tiles = materialize(tiles.withColumn("name", F.monotonically_increasing_id()))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + MARGIN
    place = Window.orderBy("low", "high", "name")
    numbered = tiles.withColumn("p", F.row_number().over(place))
    # the last tile that starts within reach of a tile's end: how many starts there are up to that point
    points = numbered.select(F.col("low").alias("x"), F.lit(1).alias("start"), F.lit(None).cast("int").alias("p"), F.lit(None).cast("string").alias("file"))
    points = points.unionAll(numbered.select((F.col("high") + reach).alias("x"), F.lit(0), "p", "file"))
    upto = F.sum("start").over(Window.orderBy("x", F.col("start").desc()).rowsBetween(Window.unboundedPreceding, 0))
    spans = materialize(points.withColumn("last", upto.cast("int")).where("file is not null").select("file", "p", "last"))
    # a tile meets the tiles before it that reach it: from the first whose last is no less than its number
    pairs = spans.select("p", F.col("file").alias("one"), F.explode(F.sequence("p", F.greatest("p", "last"))).alias("q"))
    pairs = materialize(pairs.join(spans.select(F.col("p").alias("q"), F.col("file").alias("two")), "q").select("p", "q", "one", "two"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                names = [one] if one == two else [one, two]
                yield from _pair_links([get(x) for x in names], axes, threshold).to_batches()
                for x in names:
                    forget(x)

    return pairs.repartition(max(1, -(-pairs.count() // TASK_PAIRS))).mapInArrow(compare, "node long, other long, n long")


def embedding_components(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    prepare(vectors.sparkSession)
    rows = materialize(unit_rows(vectors, vector, key))
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("k").alias("owner"), F.count("*").alias("many"), F.first("v").alias("v"))
    classes = materialize(classes.withColumn("c", F.monotonically_increasing_id()))
    kind = np.float32 if vectors.schema[vector].dataType.simpleString() == "array<float>" else np.float64
    links = None
    for r in classes.groupBy(F.size("v").alias("d")).count().collect():
        part = _links(classes.where(F.size("v") == r["d"]), r["d"], kind, threshold, tile)
        links = part if links is None else links.unionAll(part)
    one = F.col("k")
    if links is None:
        return rows.select(one.alias(key), F.lit(0).cast("long").alias("n_links"), one.alias("component_id"), F.lit(True).alias("kept"))
    links = materialize(links)
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    grouped = connected_components(links.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "c")
    named = classes.select("cls", "c", "owner", "many").join(grouped, "c", "left").join(counts.withColumnRenamed("node", "c"), "c", "left").withColumn("component", F.coalesce("component", "c"))
    named = materialize(named)
    low = named.groupBy("component").agg(F.min("owner").alias("least"))
    info = named.join(low, "component").select(F.col("cls").alias("_cls"), "least", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).cast("long").alias("n"))
    joined = rows.select("k", "cls").join(info, F.col("cls") == F.col("_cls"), "left")
    component = F.when(F.col("cls").isNull(), one).otherwise(F.col("least"))
    return joined.select(one.alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(one == component, F.lit(False)).alias("kept"))


#: DuckDB SQL of the query over embeddings: all pairs, then the smallest vec_id reachable.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
    AND list_contains(list_transform(embedding, lambda x: x <> 0), true)),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.a LEFT JOIN n ON e.vec_id = n.a
"""
