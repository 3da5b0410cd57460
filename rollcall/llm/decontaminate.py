"""Benchmark decontamination: documents whose words hold a whole window of a benchmark item.

A prefix-filtered set join with full containment. A window is 10 consecutive words of an item (a
shorter item is one window). Its words are ordered by rarity, the number of times each occurs in all
documents; since a window must be contained whole, its necessary prefix is the one rarest word. A
document word that is the prefix of some windows proposes each of them at the one place where the
window could stand (positional bound); it must begin and end inside the document (length bound), and
then its words are compared one after the other (exact check).

The benchmark is the stated query set: it is cut into blocks of bounded size, each of which goes to
all tasks, and documents are read once for the word counts and once for each block. Documents are never
shuffled and no candidate leaves its task, so a common passage or a hot source moves no rows.

Words: A-Z lower-cased, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; compared by 64-bit hashes word by word.
Null texts have no words; items without words propose nothing. Windows of items without item_id hit words
like any others (n_hit), but name no item (n_items, items_sha256); an item_id that repeats stands for the
windows of all its rows. Empty tables give no rows (documents) and clean results (benchmark). Long texts are
hashed in stretches. Columns other than key and text aren't read, so no name can clash. Repeated documents get a row each. The clean result is
n_hit 0, n_items 0, the SHA-256 of the empty string, contaminated false.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, cuts, long_text, materialize, prefix_hash, prepare, slices, span_hash, spans

#: Words of a window, and the windows (or words of the benchmark) that one block holds at most, about.
WINDOW, BLOCK = 10, 100_000
#: Candidates verified in one NumPy pass.
CANDIDATES = 1 << 18


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text) of a slice; a long text goes in stretches."""
    if long_text(data, off):
        ends = cuts(LOWER[data], ALNUM)
        if len(ends) > 2:
            h = np.concatenate([word_hashes(data[lo:hi], np.array([0, hi - lo]))[0] for lo, hi in zip(ends, ends[1:], strict=False)])
            return h, np.array([0, len(h)])
    low = LOWER[data]
    starts, ends, first = spans(low, off, ALNUM)
    return span_hash(prefix_hash(low), starts, ends), first


def item_windows(items: DataFrame, text: str = "text", key: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(item string, words array<long>), one row for each window of each item."""
    prepare(items.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                words, first = word_hashes(data, off)
                words = words.view(np.int64)
                names = part.column(0).to_pylist()
                out = [(names[k], words[i : min(i + window, b)]) for k, (a, b) in enumerate(zip(first, first[1:], strict=False)) if b > a for i in range(a, max(a + 1, b - window + 1))]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.list_(pa.int64()))], names=["item", "words"])

    rows = items.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "item string, words array<long>").distinct()


class Lookup:
    """Sorted 64-bit keys; a table of their low bits turns most strangers away before the search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Place of each value among the keys, -1 if it is none."""
        out = np.full(len(h), -1, np.int32)
        rows = np.flatnonzero(self.bits[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if len(rows) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
            good = self.keys[at] == h[rows]
            out[rows[good]] = at[good]
        return out


class Block:
    """Windows of one block, filed under their rarest word."""

    def __init__(self, rows: list[tuple[str, list[int]]], count: dict[int, int]):
        texts: dict[tuple, list[str]] = {}
        for item, words in rows:
            texts.setdefault(tuple(words), []).append(item)
        self.words = Lookup(np.array(sorted({w for t in texts for w in t}), np.int64).view(np.uint64))
        filed = []
        for t, items in texts.items():
            at = min(range(len(t)), key=lambda k: (count.get(t[k], 0), t[k], k))
            filed.append((t, at, items))
        flat = self.words.ids(np.array([w for t, _, _ in filed for w in t], np.int64).view(np.uint64))
        self.size = np.array([len(t) for t, _, _ in filed], np.int64)
        begin = np.cumsum(self.size) - self.size
        self.at = np.array([a for _, a, _ in filed], np.int64)
        token = flat[begin + self.at] if len(filed) else np.zeros(0, np.int32)
        order = np.argsort(token, kind="stable")
        self.size, self.at, token = self.size[order], self.at[order], token[order]
        longest = int(self.size.max(initial=0))
        self.grid = np.full((longest, len(filed)), -2, np.int32)
        for j in range(longest):
            rows_j = np.flatnonzero(self.size > j)
            self.grid[j, rows_j] = flat[begin[order][rows_j] + j]
        self.items = [filed[k][2] for k in order]
        self.first = np.searchsorted(token, np.arange(len(self.words.keys)))
        self.many = np.searchsorted(token, np.arange(len(self.words.keys)), "right") - self.first

    def hits(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, window) of each occurrence of a window in a slice."""
        ids = self.words.ids(words)
        pos = np.flatnonzero(ids >= 0)
        many = self.many[ids[pos]]
        pos, many = pos[many > 0], many[many > 0]
        found = []
        ends = np.cumsum(many)
        lo = 0
        while lo < len(pos):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CANDIDATES, "right")))
            p, m = pos[lo:hi], many[lo:hi]
            row = np.repeat(p, m)
            win = np.repeat(self.first[ids[p]], m) + np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
            doc = np.repeat(np.searchsorted(first, p, "right") - 1, m)
            start = row - self.at[win]
            good = (start >= first[doc]) & (start + self.size[win] <= first[doc + 1])
            doc, start, win = doc[good], start[good], win[good]
            for j in range(len(self.grid)):
                good = (self.size[win] <= j) | (ids[np.minimum(start + j, len(ids) - 1)] == self.grid[j][win])
                if not good.all():
                    doc, start, win = doc[good], start[good], win[good]
            found.append((doc, start, win))
            lo = hi
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def word_counts(docs: DataFrame, words: DataFrame, text: str, block: int) -> DataFrame:
    """(word, n): how often each of ``words`` (column word, hashes) occurs in all documents."""
    spark = docs.sparkSession
    parts = -(-words.count() // block)
    out = None
    for b in range(parts):
        keys = [r[0] for r in words.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == b).collect()]
        known = spark.sparkContext.broadcast(np.array(keys, np.int64))

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            look = Lookup(known.value.view(np.uint64))
            total = np.zeros(len(look.keys), np.int64)
            for batch in batches:
                for _, data, off in slices(batch, "t"):
                    ids = look.ids(word_hashes(data, off)[0])
                    total += np.bincount(ids[ids >= 0], minlength=len(total))
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(look.keys[seen].view(np.int64)), pa.array(total[seen])], names=["word", "n"])

        part = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(run, "word long, n long")
        out = part if out is None else out.unionAll(part)
    return out.groupBy("word").agg(F.sum("n").alias("n"))


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans, items) of every document.

    hit_spans: first and end word of each maximal run of hit words, one after the other; items: the item_ids, sorted.
    """
    spark = docs.sparkSession
    prepare(spark)
    windows = materialize(item_windows(items, window=window))
    n = windows.count()
    words = materialize(windows.select(F.explode("words").alias("word")).distinct())
    counted = materialize(word_counts(docs, words, text, block)) if n else None
    parts = max(1, -(-n // block))
    kind = docs.schema[key].dataType.simpleString()
    now = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<long>)").alias("hit_spans"), F.expr("cast(array() as array<string>)").alias("items"))
    for b in range(parts):
        mine = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == b)
        rows = [(r["item"], r["words"]) for r in mine.collect()] if n else []
        count = {}
        if rows:
            own = mine.select(F.explode("words").alias("word")).distinct().join(counted, "word")
            count = {r["word"]: r["n"] for r in own.collect()}
        shipped = spark.sparkContext.broadcast(Block(rows, count))
        last = b == parts - 1

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped, last=last) -> Iterator[pa.RecordBatch]:
            block = shipped.value
            for batch in batches:
                for part, data, off in slices(batch, "t"):
                    hashes, first = word_hashes(data, off)
                    doc, start, win = block.hits(hashes, first)
                    old = part.column(3).to_pylist()
                    names = [set(x) for x in part.column(4).to_pylist()]
                    step = np.zeros(len(hashes) + 1, np.int64)
                    np.add.at(step, start, 1)
                    np.add.at(step, start + block.size[win], -1)
                    for k in np.flatnonzero([len(x) for x in old]):
                        pairs = np.array(old[k]).reshape(-1, 2) + first[k]
                        np.add.at(step, pairs[:, 0], 1)
                        np.add.at(step, pairs[:, 1], -1)
                    hit = np.cumsum(step)[:-1] > 0
                    for d, w in np.unique(np.stack([doc, win], 1), axis=0):
                        names[d].update(x for x in block.items[w] if x is not None)
                    begin, end, run_first = _runs(hit, first)
                    spans_of = [np.stack([begin[a:z], end[a:z]], 1).ravel() - first[k] for k, (a, z) in enumerate(zip(run_first, run_first[1:], strict=False))]
                    sorted_names = [sorted(x) for x in names]
                    cols = [part.column(0), *([] if last else [part.column(1)]), pa.array(np.diff(first)), pa.array(spans_of, pa.list_(pa.int64())), pa.array(sorted_names, pa.list_(pa.string()))]
                    labels = ["k", *([] if last else ["t"]), "n_words", "hit_spans", "items"]
                    if last:
                        total = np.concatenate([[0], np.cumsum(hit)])
                        cols += [pa.array(total[first[1:]] - total[first[:-1]]), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in sorted_names])]
                        labels += ["n_hit", "items_sha256"]
                    yield pa.RecordBatch.from_arrays(cols, names=labels)

        now = now.mapInArrow(run, f"k {kind}, {'' if last else 't string, '}n_words long, hit_spans array<long>, items array<string>{', n_hit long, items_sha256 string' if last else ''}")
    return now.select(F.col("k").alias(key), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "hit_spans", "items")


def _runs(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of hit words, cut at document borders: (first word, end, first run of each document)."""
    return spans(hit.astype(np.uint8), first, np.arange(256) > 0)


def _sql() -> str:
    """DuckDB SQL of the query over documents and benchmark: windows of each length against runs of words of that length."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    runs = " UNION ALL ".join(f"SELECT rid, p, {n} AS n, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS s FROM words WHERE {n} IN (SELECT n FROM windows)" for n in range(1, WINDOW + 1))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
words AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS p FROM docs),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS head FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, array_to_string(list_slice(w, head, head + {WINDOW - 1}), ' ') AS s, least(len(w), {WINDOW}) AS n FROM starts),
runs AS ({runs}),
found AS (SELECT r.rid, r.p, r.n, x.item FROM runs r JOIN windows x ON r.n = x.n AND r.s = x.s),
hits AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM found) GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found WHERE item IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (rid) LEFT JOIN names USING (rid)"""


LEAK_SQL = _sql()
