"""Quality by importance resampling: ratio of hashed n-gram models of target and raw text, Gumbel top-k.

Features of a text: its runs of letters and digits and its runs of other symbols (white space only
separates), and pairs of neighbouring runs, each hashed into one of ``BUCKETS`` buckets; a run that
follows an equal one counts in a bucket of its own. Two bag models with add-one counts: raw from all
documents, target from labelled documents of good quality. The log weight of a text is the sum of
log(target / raw) over its features; a Gumbel number from a hash of its doc_id is added, and the k texts
with the greatest sums are a sample without replacement in proportion to the weights.

The target model is fitted on at most ``TARGET_ROWS`` labelled documents, those least by hash, outside the
held-out fold (crc32(doc_id as text) % 5 is 0); the raw model on every document. What reaches the driver
is one row for each bucket. Ranks come from range partitions of (sum, doc_id) and a running count over them.

Null or empty text has no features and weight 0 in logs. A null doc_id is never labelled; rows that repeat
get equal weights and ties are broken by doc_id and feature count. No labels at all: every log weight is 0.
An empty table gives no rows. Long texts are read in stretches. Columns other than key and text (of labels: key
and quality) aren't read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cuts, long_text, materialize, mix, prefix_hash, prepare, slices, span_hash
from .language_id import held_out

#: Buckets of n-gram features (one more holds repeats); labelled documents in the target model.
BUCKETS, TARGET_ROWS = 10_000, 20_000
#: Added to the share of good labels when that gives k: a clean document lost costs more than a poor one kept.
SLACK, SEED = 0.02, 42

_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1


def _runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run, first run of each text) of a slice."""
    kind = _KIND[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = kind[1:] != kind[:-1]
    cut[off[:-1][np.diff(off) > 0]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    solid = kind[starts] > 0
    starts, ends = starts[solid], ends[solid]
    return span_hash(prefix_hash(data), starts, ends), np.searchsorted(starts, off)


def features(data: np.ndarray, off: np.ndarray, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of each feature of a slice."""
    n = len(off) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if long_text(data, off):  # in stretches that end where white space begins
        ends = cuts(data, _KIND > 0)
        h = np.concatenate([_runs(data[lo:hi], np.array([0, hi - lo]))[0] for lo, hi in zip(ends, ends[1:], strict=False)])
        first = np.array([0, len(h)])
    else:
        h, first = _runs(data, off)
    text = np.repeat(np.arange(n), np.diff(first))
    pair = np.flatnonzero(text[1:] == text[:-1])
    two = (mix(h[pair] * np.uint64(31) + h[pair + 1]) % np.uint64(buckets)).astype(np.int64)
    two[h[pair] == h[pair + 1]] = buckets
    return np.concatenate([(h % np.uint64(buckets)).astype(np.int64), two]), np.concatenate([text, text[pair]])


def target_ids(labels: DataFrame, key: str, rows: int) -> DataFrame:
    good = labels.where((F.col("quality") == 1) & F.col(key).isNotNull() & ~held_out(F.col(key))).select(key).distinct()
    return good.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(rows)


def log_ratios(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", buckets: int = BUCKETS, rows: int = TARGET_ROWS) -> np.ndarray:
    """log(target / raw) of each bucket."""
    prepare(docs.sparkSession)
    targets = target_ids(labels, key, rows).select(F.col(key).alias("_k"), F.lit(True).alias("_good"))
    own = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    flagged = own.join(F.broadcast(targets), F.col("k") == F.col("_k"), "left").select(F.coalesce("_good", F.lit(False)).alias("good"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, buckets + 1), np.int64)
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                bucket, owner = features(data, off, buckets)
                good = part.column(0).to_numpy(zero_copy_only=False).astype(bool)[owner]
                seen[0] += np.bincount(bucket, minlength=buckets + 1)
                seen[1] += np.bincount(bucket[good], minlength=buckets + 1)
        full = np.flatnonzero(seen[0])
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(seen[0][full]), pa.array(seen[1][full])], names=["bucket", "raw", "target"])

    summed = flagged.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.ones(buckets + 1), np.ones(buckets + 1)
    for r in summed.collect():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if target.sum() == buckets + 1:
        return np.zeros(buckets + 1)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weights(docs: DataFrame, ratio: np.ndarray, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_features, log_weight) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                bucket, owner = features(data, off, len(ratio) - 1)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.bincount(owner, minlength=n)), pa.array(np.bincount(owner, ratio[bucket], n).astype(np.float64))], names=["k", "n_features", "log_weight"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, n_features long, log_weight double").withColumnRenamed("k", key)


def gumbel_top(scored: DataFrame, k: int, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """``scored`` with gumbel_sum and kept (true for the k greatest sums)."""
    spark = scored.sparkSession
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(1 << 48)).cast("double") + 0.5) / float(1 << 48)
    noisy = scored.withColumn("gumbel_sum", F.col("log_weight") - F.ln(-F.ln(u)))
    order = [F.col("gumbel_sum").desc(), F.col(key).asc(), F.col("n_features").asc()]
    ranged = noisy.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").count()
    before = counts.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(before), "_part").withColumn("kept", F.col("_before") + place <= k).drop("_part", "_before")


def resample(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", k: int | None = None) -> DataFrame:
    """(key, n_features, log_weight, gumbel_sum, kept). k: by default the share of good labels plus SLACK, of all rows."""
    ratio = log_ratios(docs, labels, text, key)
    scored = materialize(log_weights(docs, ratio, text, key))
    if k is None:
        share = labels.where(F.col("quality").isNotNull()).agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        k = round(scored.count() * min(1.0, (1.0 if share is None else share) + SLACK))
    return gumbel_top(scored, k, key)
