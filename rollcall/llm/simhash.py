"""SimHash near-duplicates: fingerprints of 4-word shingles and a Gray-order hierarchical index over them.

Fingerprints: text with A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of 4 words joined by
single spaces (a shorter text is one shingle, a text without words has fingerprint zero), XXH64 with
seed 42 of each shingle, repeats included; a bit is 1 if more than half of the hashes have it.

Index: two fingerprints at most 4 bits apart agree on at least two of six bit blocks, so the upper
nodes are the patterns shared under each of the 15 masks of two blocks; they are spread over the
cluster. Below a node, distinct fingerprints stand in Gray rank order (neighbours differ in few bits)
and are grouped by eights into a tree whose nodes hold the bits all their members share. A self join
goes down the tree by pairs of nodes and drops a pair as soon as the shared bits alone differ in more
than 4 places. A node with more than ``NODE_LIMIT`` members is first split by five finer masks over its
free bits, again until all nodes are small: four differences leave one of the five untouched, so no
link is lost and no task holds a whole hot group.

Links within a node leave as a spanning forest, which has the same components as all the pairs.
Null text is a text without words. Repeated rows and exact copies share a fingerprint and meet as one
entry of the index. A null doc_id takes part in linking; a component's id is its smallest non-null doc_id.
An empty table gives no rows. Long texts are hashed in stretches. Columns other than key and text aren't read,
so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SLICE_BYTES, SOLID, cuts, long_text, materialize, prepare, slices, spans
from .components import connected_components, forest

#: Words of a shingle, the hash's seed, and bits that linked fingerprints may differ in.
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Fingerprints that one node of the index may hold before it is split.
NODE_LIMIT = 4096
#: Pairs of nodes compared in one NumPy pass.
PAIR_ROWS = 1 << 18
_FAN = 8

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
_LANES = np.array([_P1, _P2, 0, 0], np.uint64) + np.array([_P2, 0, 0, (1 << 64) - int(_P1)], np.uint64)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each data[start:end], all at once: step k of the algorithm runs on the spans long enough for it."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,)).copy()
    size = ends - starts
    s = np.uint64(seed)
    h = np.full(len(starts), s, np.uint64) + _P5
    at = starts.copy()
    rows = np.flatnonzero(size >= 32)
    if len(rows):
        pos, left = at[rows], size[rows] // 32
        acc = [np.full(len(rows), s, np.uint64) + x for x in _LANES]
        live = np.arange(len(rows))
        while len(live):
            for k in range(4):
                acc[k][live] = _round(acc[k][live], eight[pos[live] + 8 * k])
            pos[live] += 32
            left[live] -= 1
            live = live[left[live] > 0]
        long = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
        for k in range(4):
            long = (long ^ _round(np.zeros_like(long), acc[k])) * _P1 + _P4
        h[rows] = long
        at[rows] = pos
    h += size.astype(np.uint64)
    rest = (size % 32).astype(np.int16)
    for k in range(1, 4):
        rows = np.flatnonzero(rest >= 8 * k)
        h[rows] = _turn(h[rows] ^ _round(np.uint64(0), eight[at[rows]]), 27) * _P1 + _P4
        at[rows] += 8
    rows = np.flatnonzero(rest & 4)
    h[rows] = _turn(h[rows] ^ ((eight[at[rows]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[rows] += 4
    for k in range(1, 4):
        rows = np.flatnonzero((rest & 3) >= k)
        h[rows] = _turn(h[rows] ^ (padded[at[rows]].astype(np.uint64) * _P5), 11) * _P1
        at[rows] += 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def overlapping(data: np.ndarray, words: int, most: int = SLICE_BYTES) -> Iterator[np.ndarray]:
    """A long text in stretches that share words - 1 words, so that each run of ``words`` words lies in one; memory follows the stretch."""
    ends = cuts(data, SOLID, most)
    recent, some = np.zeros(0, np.int64), False
    for lo, hi in zip(ends, ends[1:], strict=False):
        starts = np.concatenate([recent, spans(data[lo:hi], np.array([0, hi - lo]), SOLID)[0] + lo])
        if len(starts) >= words or (hi == len(data) and not some):
            yield data[starts[0] if len(starts) else lo : hi]
            some = True
            starts = starts[len(starts) - words + 1 :] if len(starts) >= words else starts
        recent = starts


def shingle_hashes(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number of the text) of each shingle of a slice, in order of the texts (uint64, int)."""
    if long_text(data, off):
        found = [shingle_hashes(part, np.array([0, len(part)]), shingle, seed)[0] for part in overlapping(data, shingle) if len(part) < len(data)]
        if found:
            h = np.concatenate(found)
            return h, np.zeros(len(h), np.int64)
    starts, ends, first = spans(data, off, SOLID)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = SOLID[data]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    flat = np.where(solid, LOWER[data], np.uint8(32))[keep]
    place = np.cumsum(keep)
    starts, ends = place[starts] - 1, place[ends - 1]
    words = np.diff(first)
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    doc = np.repeat(np.arange(len(off) - 1), count)
    head = first[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    tail = np.minimum(head + shingle, first[1:][doc]) - 1
    return xxh64(flat, starts[head], ends[tail], seed), doc


def fingerprint_bits(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """The fingerprint of each of n_docs texts from its shingle hashes (uint64)."""
    count = np.bincount(doc, minlength=n_docs)
    out = np.zeros(n_docs, np.uint64)
    for k in range(8):
        byte = ((h >> np.uint64(8 * k)) & np.uint64(255)).astype(np.int64)
        seen = np.bincount((doc << 8) | byte, minlength=n_docs << 8).reshape(n_docs, 256) @ _BITS
        out |= ((2 * seen > count[:, None]) << np.arange(8)).sum(1).astype(np.uint64) << np.uint64(8 * k)
    return out


def fingerprints_of(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text of a slice (uint64)."""
    return fingerprint_bits(*shingle_hashes(data, off, shingle, seed), len(off) - 1)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(key, fp long, text_hash long) of every row; text_hash tells rows of one key apart."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fingerprints_of(data, off, shingle, seed).view(np.int64)), part.column(1)], names=["k", "fp", "text_hash"])

    kind = docs.schema[key].dataType.simpleString()
    t = F.col(text).cast("string")
    return docs.select(F.col(key).alias("k"), F.xxhash64(t).alias("text_hash"), t.alias("t")).mapInArrow(run, f"k {kind}, fp long, text_hash long").withColumnRenamed("k", key)


def gray_rank(fp):
    """Rank of a 64-bit pattern in Gray order, as a column; ranks compare as unsigned, which halves of the order don't need."""
    for n in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, n))
    return fp


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(bits: list[int], n: int) -> list[int]:
    """The bits dealt into n blocks of about equal size, each as a mask."""
    cut = [len(bits) * k // n for k in range(n + 1)]
    return [sum(1 << b for b in bits[cut[k] : cut[k + 1]]) for k in range(n)]


def root_masks(distance: int = DISTANCE) -> list[int]:
    """Masks of two of distance + 2 blocks: two patterns that far apart agree under one of them at least."""
    return [a | b for a, b in combinations(_blocks(list(range(64)), distance + 2), 2)]


def finer_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """Masks that add one of distance + 1 blocks of the free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | b for b in _blocks(free, distance + 1) if b] if len(free) > distance else [(1 << 64) - 1]


def close_pairs(fp: np.ndarray, group: np.ndarray, distance: int = DISTANCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers in the same group at most ``distance`` bits apart. Rows of a group stand together, in Gray order."""
    levels = []  # from the leaves up: (shared bits, pattern, first child, end of children, group)
    n = len(fp)
    low, high, owner = fp, fp, group
    first = np.arange(n)
    levels.append((np.full(n, ~np.uint64(0)), fp, first, first + 1, owner))
    while True:
        new = np.ones(len(owner), bool)
        new[1:] = owner[1:] != owner[:-1]
        if new.all():
            break
        head = np.flatnonzero(new)
        rank = np.arange(len(owner)) - np.repeat(head, np.diff(np.append(head, len(owner))))
        cut = np.flatnonzero(rank % _FAN == 0)
        low, high, owner = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut), owner[cut]
        shared = ~(low ^ high)
        levels.append((shared, low & shared, cut, np.append(cut[1:], len(rank)), owner))
    top = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, top, top)]
    while stack:
        level, a, b = stack.pop()
        if level == 0:
            yield a, b
            continue
        if len(a) > PAIR_ROWS // (_FAN * _FAN):
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        _, _, start, end, _ = levels[level]
        na, nb = end[a] - start[a], end[b] - start[b]
        size = na * nb
        pair = np.repeat(np.arange(len(a)), size)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        x, y = start[a][pair] + k // nb[pair], start[b][pair] + k % nb[pair]
        shared, pattern = levels[level - 1][:2]
        good = (x < y) if level == 1 else (x <= y)
        x, y = x[good], y[good]
        near = np.bitwise_count((pattern[x] ^ pattern[y]) & shared[x] & shared[y]) <= distance
        stack.append((level - 1, x[near], y[near]))


def links(fps: DataFrame, distance: int = DISTANCE, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(a, b): for distinct fingerprints (column fp), links that connect all those at most ``distance`` bits apart."""
    spark = fps.sparkSession
    prepare(spark)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(mask, key, fp):
            new = np.ones(len(fp), bool)
            new[1:] = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])
            group = np.cumsum(new)
            many = np.bincount(group)[group] > 1
            fp, group = fp[many].view(np.uint64), group[many]
            label = forest(len(fp), close_pairs(fp, group, distance))
            rows = np.flatnonzero(label != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[rows].view(np.int64)), pa.array(fp[label[rows]].view(np.int64))], names=["a", "b"])

        held, n = [], 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n < 1 << 17:
                continue
            mask, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            same = (mask == mask[-1]) & (key == key[-1])  # the last group may go on in the next batch
            cut = int(np.argmax(same))
            if cut:
                yield done(mask[:cut], key[:cut], fp[:cut])
            held, n = [[mask[cut:], key[cut:], fp[cut:]]], len(fp) - cut
        if n:
            yield done(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def under(rows: DataFrame) -> DataFrame:
        sorted_rows = rows.repartition("mask", "key").sortWithinPartitions("mask", "key", gray_rank(F.col("fp")))
        return sorted_rows.select("mask", "key", "fp").mapInArrow(walk, "a long, b long")

    masks = root_masks(distance)
    nodes = fps.select(F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"), "fp")
    found = None
    while True:
        nodes = nodes.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        hot = materialize(nodes.groupBy("mask", "key").count().where(F.col("count") > node_limit).select("mask", "key"))
        if hot.isEmpty() or masks == [(1 << 64) - 1]:
            part = under(nodes)
            return part if found is None else found.unionAll(part)
        part = under(nodes.join(hot, ["mask", "key"], "left_anti"))
        found = part if found is None else found.unionAll(part)
        finer = {m: finer_masks(m, distance) for m in masks}
        table = spark.createDataFrame([(_signed(m), [_signed(x) for x in finer[m]]) for m in masks], "mask long, finer array<long>")
        nodes = nodes.join(hot, ["mask", "key"]).join(F.broadcast(table), "mask").select(F.explode("finer").alias("mask"), "fp")
        nodes = materialize(nodes.distinct())
        masks = sorted({x for v in finer.values() for x in v})


def simhash_components(docs: DataFrame, text: str = "text", key: str = "doc_id", distance: int = DISTANCE, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id, text_hash) of every row."""
    prints = materialize(fingerprints(docs, text, key))
    owners = materialize(prints.groupBy("fp").agg(F.min(key).alias("owner")))
    grouped = connected_components(links(owners.select("fp"), distance, node_limit))
    member = owners.join(grouped.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "owner", F.coalesce("component", "fp").alias("c"))
    member = materialize(member)
    low = member.groupBy("c").agg(F.min("owner").alias("component_id"))
    named = member.join(low, "c").select("fp", "component_id")
    return prints.join(named, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "text_hash")
