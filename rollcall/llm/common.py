"""Helpers that the operations of this subpackage share: session settings, shared storage, byte columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_dir, ship

#: Bytes of text that one NumPy pass works on. Single texts may be longer; operations cut those in stretches.
SLICE_BYTES = 1 << 19
#: Keys with more than 1 / HOT_KEYS of all rows are joined by broadcast: there are at most so many.
HOT_KEYS = 1000
#: Spark's setting by which a query's shuffle files are removed when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """What the Python stages need: this package on the workers. Arrow batches hold 64 MB at most by Spark's default."""
    ship(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there.

    A lost executor costs only the tasks of the stage at hand, and what is written can't differ
    between two reads, which a recomputed plan might. Its shuffle files aren't needed from then on and go
    at once, instead of when the driver next collects garbage; the session's setting stays as it was.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def spread_join(rows: DataFrame, small: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``small`` (one row for each key; ``weight``: at least how many rows have it, summing up to about all rows).

    Keys with more than 1 / HOT_KEYS of the rows are few by that, and broadcast; the others are shuffled.
    """
    limit = max(1, small.agg(F.sum(weight)).first()[0] or 0) / HOT_KEYS
    hot = small.where(F.col(weight) > limit)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(small.where(F.col(weight) <= limit), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(rest)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts hold about ``most`` bytes: (rows, bytes, offsets). A longer text is a run of its own."""
    data, off = text_buffer(batch.column(name))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def cuts(data: np.ndarray, inside: np.ndarray, most: int = SLICE_BYTES) -> list[int]:
    """Places that cut a text into stretches of ``most`` bytes or somewhat more, none inside a run of bytes with inside[byte]."""
    out, at = [0], most
    while at + most < len(data):
        free = np.flatnonzero(~inside[data[at : at + most]])
        if len(free):
            out.append(at + int(free[0]))
            at = out[-1]
        at += most
    return [*out, len(data)]


def long_text(data: np.ndarray, off: np.ndarray, most: int = SLICE_BYTES) -> bool:
    """Whether a slice is one text that should be worked on in stretches."""
    return len(off) == 2 and len(data) > 2 * most


def spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text) of the maximal runs of bytes with inside[byte], cut at text borders."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = inside[data]
    before = np.empty(len(word), bool)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty(len(word), bool)
    after[-1] = False
    after[:-1] = word[1:]
    full = off[1:] > off[:-1]
    before[off[:-1][full]] = False
    after[off[1:][full] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ in text that is lower-cased already.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of words [^\x20\x09-\x0D]+.
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE_KEYS = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64; kept between calls."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: entry i covers data[:i]."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_KEYS[data] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], the same wherever the bytes stand."""
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))
