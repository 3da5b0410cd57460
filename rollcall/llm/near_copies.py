"""Near copies by SimHash and Jaccard similarity of 5-word shingles: candidates from two indexes, the shingle sets decide.

Words and shingles are those of ``simhash``: A-Z lower-cased, a shorter text is one shingle, a text without
words has none and equals any other such text. Two texts are linked if their sets of shingle hashes (64
bits) have similarity ``SIMILARITY`` or more; groups are the connected components of the links.

Candidates come first from SimHash: the fingerprints of 5-word shingles go through the Gray-order index of
``simhash``, and what it connects at ``DISTANCE`` bits is one bucket. A similarity of 0.8 leaves some 10 of 64 bits
different, more than any index over 64 bits can bridge without comparing nearly everything; such pairs are
found by MinHash besides.

Texts with equal sets are one entry from the start. Each entry has also ``BANDS`` keys of ``ROWS``
MinHash values each; entries that share a key are in one bucket. A pair at similarity s shares none with
probability (1 - s ** ROWS) ** BANDS, at 0.8 that is 7 in 100,000.

All pairs of a bucket count, but a pair whose entries are connected already isn't compared. First each entry
meets the least of its bucket, which settles buckets of real copies in as many comparisons as members.
What isn't connected by that (texts somewhat alike, however many) gets new buckets, those of a prefix filter: an
entry stands under so many of its rarest shingles that any two with the similarity share one. Variants of
one text that differ too much share none, and don't meet again. Buckets that are still open after another
star are ordered, and pairs are compared by growing distance in the order, between unconnected entries
only, until none is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix, prepare, slices, spread_join
from .components import connected_components
from .simhash import DISTANCE, SEED, fingerprint_bits, links, shingle_hashes

#: Words of a shingle, and tenths of similarity from which two texts are copies.
SHINGLE, TENTHS = 5, 8
#: Keys of an entry and MinHash values in each.
BANDS, ROWS = 24, 5
#: Distance in a bucket's order up to which the first ordered round compares; each further round goes this many times as far.
REACH = 16

_rng = np.random.default_rng(11)
_FACTORS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def distinct_hashes(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first hash of each text): the distinct shingle hashes of each of n texts, in order."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(n + 1))


def shingle_sets(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    return distinct_hashes(*shingle_hashes(data, off, shingle, SEED), len(off) - 1)


def entries_of(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, fingerprint, band keys) of each text of a slice (uint64); texts with equal sets have the same entry."""
    n = len(off) - 1
    all_h, doc = shingle_hashes(data, off, shingle, SEED)
    fp = fingerprint_bits(all_h, doc, n)
    h, first = distinct_hashes(all_h, doc, n)
    entry, keys = np.zeros(n, np.uint64), np.zeros((n, BANDS), np.uint64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        at = first[:-1][full]
        entry[full] = mix(np.add.reduceat(mix(h + _PRIME), at))
        value = np.empty(len(h), np.uint64)
        for band in range(BANDS):
            key = np.full(len(full), band + 1, np.uint64)
            for k in range(band * ROWS, band * ROWS + ROWS):
                np.multiply(h, _FACTORS[k], out=value)
                value += _SHIFTS[k]
                key = mix(key * _PRIME + np.minimum.reduceat(value, at))
            keys[full, band] = key
    return entry, fp, keys


def copies(a: bytes, b: bytes) -> bool:
    """Whether two sets, as sorted 64-bit hashes, have the similarity."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 10 * min(len(x), len(y)) < TENTHS * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 10 * shared >= TENTHS * (len(x) + len(y) - shared)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [copies(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = sets.select(F.col("entry").alias("a"), F.col("set").alias("x")), sets.select(F.col("entry").alias("b"), F.col("set").alias("y"))
    both = pairs.join(left, "a").join(right, "b").where(10 * F.least(F.length("x"), F.length("y")) >= TENTHS * F.greatest(F.length("x"), F.length("y")))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def prefix_buckets(sets: DataFrame) -> DataFrame:
    """(bucket, entry, size, pos, short): each entry under its rarest shingles, so many that two sets with the similarity share one of them.

    Such sets share TENTHS / 10 of the longer one, so of that all but this part, and one more, are enough. Of the shorter one (by size
    and entry) they share 2 * TENTHS / (10 + TENTHS), so it needs fewer: those have short set, and a pair counts only
    if its shorter entry has. Rarity is counted over ``sets``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(1)]
            size = np.array([len(x) for x in found], np.int64)
            rows = pa.array(np.repeat(np.arange(len(found)), size))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(np.concatenate([*found, np.zeros(0, np.int64)])), pa.array(np.repeat(size, size))], names=["entry", "bucket", "size"])

    held = materialize(sets.select("entry", "set").mapInArrow(run, "entry long, bucket long, size long"))
    counted = materialize(held.groupBy("bucket").agg(F.count("*").alias("n")))
    place = F.row_number().over(Window.partitionBy("entry").orderBy("n", "bucket"))
    enough = F.col("size") - F.ceil(F.col("size") * TENTHS / 10) + 1
    few = F.col("size") - F.ceil(F.col("size") * 2 * TENTHS / (10 + TENTHS)) + 1
    first = spread_join(held, counted, ["bucket"], "n").withColumn("r", place).where(F.col("r") <= enough)
    first = materialize(first.where("n > 1").select("bucket", "entry", "size", F.col("r").alias("pos"), (F.col("r") <= few).alias("short")))
    shared = first.groupBy("bucket").agg(F.min("entry").alias("x"), F.max("entry").alias("y"), F.max("short").alias("any")).where("x < y and any").select("bucket")
    return materialize(first.join(shared, "bucket"))


def linked(held: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, component) of the entries that links connect; ``held`` has the buckets (bucket, entry) with two entries or more."""

    def star(held: DataFrame) -> DataFrame:
        least = held.groupBy("bucket").agg(F.min("entry").alias("a"))
        pairs = held.join(least, "bucket").where("a < entry").select("a", F.col("entry").alias("b")).distinct()
        return verified(pairs, sets)

    def named(held: DataFrame, found: DataFrame) -> DataFrame:
        return held.join(found, held["entry"] == found["node"], "left").select(*held.columns, F.coalesce("component", "entry").alias("c"))

    def unsettled(rows: DataFrame, size: int) -> DataFrame:
        """Buckets of more than ``size`` entries that aren't all connected."""
        parts = rows.groupBy("bucket").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("n"))
        return materialize(parts.where((F.col("x") < F.col("y")) & (F.col("n") > size)).select("bucket"))

    edges = materialize(star(held))
    found = materialize(connected_components(edges))
    rows = named(held, found)
    left = unsettled(rows, 2)  # buckets of two are settled by the star
    if left.isEmpty():
        return found
    # what MinHash brings together without being copies is told apart by its rarest shingles
    held = prefix_buckets(sets.join(held.join(left, "bucket").select("entry").distinct(), "entry", "left_semi"))
    edges = materialize(edges.unionAll(star(named(held, found).join(unsettled(named(held, found), 1), "bucket").select("bucket", "entry"))))
    low, high = 0, REACH
    while True:
        found = materialize(connected_components(edges))
        rows = named(held, found)
        left = unsettled(rows, max(2, low + 1))
        if left.isEmpty():
            return found
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("size", "entry")).cast("long")
        ranked = materialize(rows.join(left, "bucket").withColumn("r", place))
        right = ranked.select("bucket", F.col("r").alias("s"), F.col("entry").alias("b"), F.col("c").alias("d"), F.col("size").alias("size2"), F.col("pos").alias("pos2"))
        # rows meet in blocks of REACH-bounded width, so that a bucket isn't crossed with itself
        wide = F.lit(high)
        near = ranked.where("short").withColumn("block", F.explode(F.array(F.floor(F.col("r") / wide), F.floor(F.col("r") / wide) + 1)))
        other = right.withColumn("block", F.floor(F.col("s") / wide))
        step = F.col("s") - F.col("r")
        # at the first shingle a pair shares, so much of both is left that the similarity can be reached; other buckets needn't compare it
        most = F.least(F.col("size") - F.col("pos"), F.col("size2") - F.col("pos2")) + 1
        fits = (F.col("size") * 10 >= F.col("size2") * TENTHS) & (most * (10 + TENTHS) >= (F.col("size") + F.col("size2")) * TENTHS)
        pairs = near.join(other, ["bucket", "block"]).where((step > low) & (step <= high) & (F.col("c") != F.col("d")) & fits).select(F.col("entry").alias("a"), "b").distinct()
        edges = materialize(edges.unionAll(verified(pairs, sets)))
        low, high = high, high * REACH


def near_copy_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(key, text_hash, group) of every row; rows of one group are copies of each other, directly or through others."""
    prepare(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    t = F.col(text).cast("string")
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(t).alias("text_hash"), t.alias("t"))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                entry, fp, keys = entries_of(data, off, shingle)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(entry) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(entry.view(np.int64)), pa.array(fp.view(np.int64)), lists], names=["k", "text_hash", "entry", "fp", "keys"])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                h, first = shingle_sets(data, off, shingle)
                found = [h[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], names=["entry", "set"])

    entered = materialize(rows.mapInArrow(enter, f"k {kind}, text_hash long, entry long, fp long, keys array<long>"))
    entries = entered.groupBy("entry").agg(F.min(F.struct(F.col("text_hash").alias("h"), F.col("k"))).alias("one"), F.min("fp").alias("fp"), F.any_value("keys").alias("keys"))
    entries = materialize(entries)
    alike = connected_components(links(entries.select("fp").distinct(), distance)).withColumnRenamed("node", "fp")
    printed = entries.select("entry", "fp").join(alike, "fp", "left").select("entry", F.xxhash64(F.lit("simhash"), F.coalesce("component", "fp")).alias("bucket"))
    held = entries.select("entry", F.explode("keys").alias("bucket")).unionAll(printed)
    shared = held.groupBy("bucket").agg(F.min("entry").alias("x"), F.max("entry").alias("y")).where("x < y").select("bucket")
    held = materialize(held.join(shared, "bucket").select("bucket", "entry"))
    wanted = materialize(entries.join(held.select("entry").distinct(), "entry", "left_semi").select("entry", F.col("one.h").alias("h"), F.col("one.k").alias("_k")))
    sets = rows.join(wanted, (F.col("text_hash") == F.col("h")) & F.col("k").eqNullSafe(F.col("_k"))).select("entry", "t").mapInArrow(collect, "entry long, set binary")
    sets = materialize(sets.groupBy("entry").agg(F.any_value("set").alias("set")))
    found = linked(held, sets)
    return entered.join(found, entered["entry"] == found["node"], "left").select(F.col("k").alias(key), "text_hash", F.coalesce("component", "entry").alias("group"))
