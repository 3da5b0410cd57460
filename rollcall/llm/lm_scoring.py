"""Language-model scores of whole texts: an interpolated modified Kneser-Ney n-gram model, counted from the corpus.

Tokens are runs of solid characters (white space: ASCII's), A-Z lower-cased, then one end. Words are told apart by 64-bit hashes; sorted, they
give each word a number. An n-gram is (number of its first n - 1 tokens as an n-gram of the level below, last word), and
its place in the sorted table of its level is its number in turn, so higher levels hold no hashes at all. The level of
two words has a context for the beginning of a text.

Counting, level by level: a task turns its batch of training texts into sorted different n-grams with counts, packed by range of
context; Spark brings each range together; a task merges it and writes sorted arrays to the shared folder. From the different
n-grams come the counts of different left neighbours that the level below goes by; an n-gram at the beginning of a text has
none there and keeps its count. Discounts follow from how many n-grams have count 1 to 4 (Chen and Goodman); where these
don't give numbers in order, they are 0.5, 1 and 1.5. The words' level is mixed with an even share for each of the distinct tokens and
one unknown. What the driver keeps is a row for each file and these few numbers.

Scoring maps the arrays into memory; of a pass of texts each different n-gram is looked up once.

Null texts are empty and have one token, the end. A null key is none of the held-out ones. Repeated rows count as often as they
occur; an empty table gives no rows. Without any training text each token has probability 1 (no token is known, and one unknown
takes all). Long texts are hashed in stretches. Only key and text are read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SOLID, cuts, long_text, materialize, prefix_hash, prepare, slices, span_hash, spans
from .shared_arrays import Shards, arrays_folder, get, put

#: Words of an n-gram; bytes of text that one NumPy pass works on; the model's held-out fold is crc32(key as text) % FOLDS = 0.
ORDER, PASS_BYTES, FOLDS = 2, 1 << 20, 10
#: Bytes of training text for each range of hashes or contexts; a range is merged by one task and is a file.
RANGE_BYTES = 8 << 20
#: Added to each count of the base model.
ADDED = 0.1
_END = np.int64(0x5851F42D4C957F2D)
_NO_WORD = np.int64(0xFFFFFFFF)


def token_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, first token of each text and their number) of a pass of texts."""
    low = LOWER[data]
    if long_text(data, off):
        edge = cuts(low, SOLID)
        found = []
        for lo, hi in zip(edge, edge[1:], strict=False):
            s, e, _ = spans(low[lo:hi], np.array([0, hi - lo]), SOLID)
            found.append(span_hash(prefix_hash(low[lo:hi]), s, e))
        words = np.concatenate(found)
        first = np.array([0, len(words)])
    else:
        s, e, first = spans(low, off, SOLID)
        words = span_hash(prefix_hash(low), s, e) if len(s) else np.zeros(0, np.uint64)
    n = len(off) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    out = np.empty(len(words) + n, np.int64)
    out[np.arange(len(words)) + text] = words.view(np.int64)
    out[first[1:] + np.arange(n)] = _END
    return out, first + np.arange(n + 1)


def distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts rows by the keys, the last of them least, places in it where another row begins)."""
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    new[:1] = True
    return order, np.flatnonzero(new)


def gram_key(context: np.ndarray, word: np.ndarray, contexts: int) -> tuple[np.ndarray, ...]:
    """Sort keys of (context, word), of ``contexts`` contexts: one number where both fit."""
    return (context << 32 | word,) if contexts < 1 << 31 else (context, word)


def gram_of(key: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(context, word) of sort keys."""
    return key if len(key) == 2 else (key[0] >> 32, key[0] & 0xFFFFFFFF)


@dataclass
class Level:
    """n-grams of one length. Of each file: number of the first n-gram and how many, least context and how many; paths of keys and of counts.

    ``seen``: how many n-grams have counts 1, 2, 3 or more, and the sum of all.
    """

    first: np.ndarray
    size: np.ndarray
    paths: list[str]
    low: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    contexts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sums: list[str] = field(default_factory=list)
    discounts: tuple[float, float, float] = (0.5, 1.0, 1.5)
    seen: tuple[int, int, int, int] = (0, 0, 0, 0)

    def cut(self, n: np.ndarray) -> np.ndarray:
        """Discount of counts."""
        return np.array([0.0, *self.discounts])[np.minimum(n, 3)]

    def find(self, context: np.ndarray, word: np.ndarray, counted: bool) -> list[np.ndarray]:
        """For each (context, word), -1 for none: number of the n-gram or -1; if ``counted`` also its count, its context's total and mass left."""
        out = [np.full(len(context), -1, np.int64), np.zeros(len(context), np.int64), np.zeros(len(context), np.int64), np.zeros(len(context))]
        rows = np.flatnonzero(context >= 0)
        ctx, w = context[rows], np.where(word[rows] < 0, _NO_WORD, word[rows])
        order, begin = distinct(*gram_key(ctx, w, int(self.low[-1] + self.contexts[-1]) if len(self.low) else 0))
        each = order[begin]
        c, w = ctx[each], w[each]
        got = [np.full(len(c), -1, np.int64), np.zeros(len(c), np.int64), np.zeros(len(c), np.int64), np.zeros(len(c))]
        cuts_ = np.append(np.searchsorted(c, self.low), len(c))
        for s, path in enumerate(self.paths):
            a, b = cuts_[s], cuts_[s + 1]
            if a == b:
                continue
            f, local = get(path), c[a:b] - self.low[s]
            key = local << 32 | w[a:b]
            at = np.minimum(np.searchsorted(f["key"], key), len(f["key"]) - 1)
            hit = np.flatnonzero(f["key"][at] == key)
            got[0][a + hit] = self.first[s] + at[hit]
            if counted:
                g = get(self.sums[s])
                got[1][a + hit] = g["n"][at[hit]]
                here = np.flatnonzero(local < len(g["total"]))
                place = local[here]
                got[2][a + here] = g["total"][place]
                got[3][a + here] = sum(d * g[f"t{j}"][place] for j, d in enumerate(self.discounts, 1))
        back = np.empty(len(ctx), np.int64)
        back[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        for o, g in zip(out, got, strict=True):
            o[rows] = g[back]
        return out


@dataclass
class Model:
    """Words by hash (files with their counts), levels of 2 words and more, and the words' own level in ``levels[0]``."""

    words: Shards
    levels: list[Level]
    tokens: int
    known: int

    def numbers(self, hashes: np.ndarray, counted: bool = False) -> list[np.ndarray]:
        """For each token: number of the word or -1; if ``counted`` also its count and how many different words precede it."""
        order, begin = distinct(hashes)
        keys = hashes[order[begin]]
        got = [np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)]
        cut = np.append(np.searchsorted(keys, self.words.low), len(keys))
        for s, path in enumerate(self.words.paths):
            own = keys[cut[s] : cut[s + 1]]
            if not len(own):
                continue
            f = get(path)
            at = np.minimum(np.searchsorted(f["key"], own), len(f["key"]) - 1)
            hit = np.flatnonzero(f["key"][at] == own)
            got[0][cut[s] + hit] = self.levels[0].first[s] + at[hit]
            if counted:
                got[1][cut[s] + hit] = f["n"][at[hit]]
                got[2][cut[s] + hit] = get(self.levels[0].sums[s])["n"][at[hit]]
        back = np.empty(len(hashes), np.int64)
        back[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        return [g[back] for g in got]

    def before(self, number: np.ndarray, first: np.ndarray, length: int) -> np.ndarray:
        """Context of each token among n-grams of ``length`` words: what its predecessor ends; at a text's beginning that of one word is the beginning itself."""
        out = np.full(len(number), -1, np.int64)
        out[1:] = number[:-1]
        starts = first[:-1][np.diff(first) > 0]
        out[starts] = self.known if length == 1 else -1
        return out

    def log_scores(self, hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
        """For each text: tokens, known tokens, base score and model score (log10)."""
        word, count, left = self.numbers(hashes, True)
        own = self.levels[0]
        even, total = 1.0 / (self.known + 1), own.seen[3]
        mass = sum(d * t for d, t in zip(own.discounts, own.seen, strict=False))
        p = (np.maximum(left - own.cut(left), 0) + mass * even) / total if total else np.full(len(hashes), even)
        number = word
        for k, level in enumerate(self.levels[1:], 1):
            number, n, totals, left_over = level.find(self.before(number, first, k), word, True)
            some = totals > 0
            p[some] = (np.maximum(n - level.cut(n), 0)[some] + left_over[some] * p[some]) / totals[some]
        base = np.log10((count + ADDED) / (self.tokens + ADDED * (self.known + 1)))
        add = lambda x: np.add.reduceat(x, first[:-1]) if len(first) > 1 else np.zeros(0)
        return [np.diff(first), add(count > 0).astype(np.int64), add(base), add(np.log10(p))]


def discounts_of(p: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = p
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        d = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
        if 0 < d[0] <= d[1] <= d[2] and d[0] <= 1 and d[1] <= 2 and d[2] <= 3:
            return d
    return 0.5, 1.0, 1.5


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.col(text).cast("string").alias("t"))


def count_words(docs: DataFrame, folder: str, text: str) -> Model:
    """Count the words of training texts; files of hashes in order, each with what begins alike in its first bits."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    bits = max(4, int(np.ceil(np.log2(max(1, size / RANGE_BYTES)))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = [], []
            for _, data, off in slices(batch, "t", PASS_BYTES):
                h, _ = token_hashes(data, off)
                order, begin = distinct(h)
                keys.append(h[order[begin]])
                counts.append(np.diff(np.append(begin, len(h))))
            if not keys:
                continue
            h, n = np.concatenate(keys), np.concatenate(counts)
            order, begin = distinct(h)
            h, n = h[order[begin]], np.add.reduceat(n[order], begin)
            for at in range(0, len(h), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(h[at : at + (1 << 16)]), pa.array(n[at : at + (1 << 16)])], names=["key", "n"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        key, n = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1))
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        head = key >> np.int64(64 - bits)
        edge = np.flatnonzero(np.diff(head, prepend=head[0] - 1))
        rows = [(int(head[lo]), put(folder, {"key": key[lo:hi], "n": n[lo:hi]}), int(hi - lo), int(n[lo:hi].sum())) for lo, hi in zip(edge, np.append(edge[1:], len(key)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["head", "path", "size", "tokens"])

    counted = _texts(docs, text).mapInArrow(count, "key long, n long").withColumn("head", F.shiftright("key", 64 - bits)).repartition("head")
    each = counted.groupBy("head", "key").agg(F.sum("n").alias("n")).select("key", "n")
    rows = sorted(tuple(r) for r in each.mapInArrow(write, "head long, path string, size long, tokens long").collect())
    first = np.concatenate([[0], np.cumsum([r[2] for r in rows])]).astype(np.int64)
    words = Shards([(r[0] << (64 - bits), r[1]) for r in rows])
    if first[-1] >= int(_NO_WORD):
        raise ValueError("words have numbers of 32 bits")
    return Model(words, [Level(first[:-1], np.array([r[2] for r in rows], np.int64), words.paths)], sum(r[3] for r in rows), int(first[-1]))


def _statistics(n: np.ndarray, context: np.ndarray, contexts: int) -> tuple[dict[str, np.ndarray], list[int]]:
    """(totals and numbers of counts 1, 2, 3 or more of each context; how many n-grams have counts 1, 2, 3, 4, 3 or more, and the sum)."""
    by = {"total": np.bincount(context, n, contexts).astype(np.int64)}
    for j in (1, 2, 3):
        by[f"t{j}"] = np.bincount(context[n >= 3] if j == 3 else context[n == j], minlength=contexts).astype(np.int32)
    return by, [*(int((n == j).sum()) for j in (1, 2, 3, 4)), int((n >= 3).sum()), int(n.sum())]


def count_level(docs: DataFrame, model: Model, folder: str, text: str, top: bool) -> None:
    """Count the n-grams one word longer than the model's longest, and give that level its counts of left neighbours."""
    k = len(model.levels)
    below = model.levels[-1]
    low = below.first  # contexts are the n-grams below, in the same ranges
    contexts = below.size.copy()
    if k == 1 and len(contexts):
        contexts[-1] += 1  # the beginning of a text
    levels, spark, number_of_contexts = list(model.levels), docs.sparkSession, int(contexts.sum())

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for _, data, off in slices(batch, "t", PASS_BYTES):
                h, first = token_hashes(data, off)
                word = model.numbers(h)[0]
                number = word
                for j, level in enumerate(levels[1:], 1):
                    number = level.find(model.before(number, first, j), word, False)[0]
                ctx = model.before(number, first, k)
                rows = np.flatnonzero(ctx >= 0)
                key = gram_key(ctx[rows], word[rows], number_of_contexts)
                order, begin = distinct(*key)
                one = order[begin]
                held.append((*(x[one] for x in key), *((number[rows][one],) if k > 1 else ()), np.diff(np.append(begin, len(order))).astype(np.uint32)))
            if not held:
                continue
            *key, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            suffix = key.pop() if k > 1 else None
            order, begin = distinct(*key)
            one = order[begin]
            n = np.add.reduceat(n[order], begin) if len(order) else n
            ctx, w = gram_of(tuple(x[one] for x in key))
            suffix = suffix[one] if k > 1 else None
            edge = np.append(np.searchsorted(ctx, low), len(ctx))
            full = np.flatnonzero(np.diff(edge))
            cols: list[list] = [[], [], [], [], []]
            for s in full.tolist():
                a, b = edge[s], edge[s + 1]
                for col, x in zip(cols, (s, np.diff(ctx[a:b], prepend=low[s]).astype(np.uint32).tobytes(), w[a:b].astype(np.uint32).tobytes(), n[a:b].astype(np.uint32).tobytes(), suffix[a:b].tobytes() if k > 1 else None), strict=True):
                    col.append(x)
            for at in range(0, len(full), 64):
                yield pa.RecordBatch.from_arrays([pa.array(cols[0][at : at + 64], pa.int32()), *(pa.array(c[at : at + 64], pa.binary()) for c in cols[1:])], names=["shard", "ctx", "w", "n", "suffix"])

    def merge(table: pa.Table) -> pa.Table:
        s = table.column("shard")[0].as_py()
        blobs = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        ctx = np.concatenate([np.cumsum(x.astype(np.int64)) for x in blobs("ctx", np.uint32)])
        w, n = (np.concatenate(blobs(name, np.uint32)).astype(np.int64) for name in ("w", "n"))
        suffix = np.concatenate(blobs("suffix", np.int64)) if k > 1 else w
        key = ctx << 32 | w
        order, begin = distinct(key)
        key, suffix, n = key[order[begin]], suffix[order[begin]], np.add.reduceat(n[order], begin)
        by, seen = _statistics(n, key >> 32, int(contexts[s]))
        sums = put(folder, {"n": n.astype(np.int32) if n.max() < 1 << 31 else n, **by}) if top else put(folder, {"n": n})
        rows = [(s, put(folder, {"key": key}), sums, len(key), *seen, None, None)]
        order, begin = distinct(suffix)
        left, many = suffix[order[begin]], np.diff(np.append(begin, len(order)))
        edge = np.append(np.searchsorted(left, low), len(left))
        for t in np.flatnonzero(np.diff(edge)).tolist():
            a, b = edge[t], edge[t + 1]
            rows.append((t, *[None] * 9, np.diff(left[a:b], prepend=low[t]).astype(np.uint32).tobytes(), many[a:b].astype(np.uint32).tobytes()))
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), _MERGED.values(), strict=True)], names=list(_MERGED))

    packed = _texts(docs, text).mapInArrow(grams, "shard int, ctx binary, w binary, n binary, suffix binary")
    merged = materialize(packed.groupBy("shard").applyInArrow(merge, ", ".join(f"{c} {_NAMES[t]}" for c, t in _MERGED.items())))
    rows = sorted(tuple(r) for r in merged.where("path is not null").select("shard", "path", "sums", "size", *_SEEN).collect())
    size = np.array([r[3] for r in rows], np.int64)
    shards = [r[0] for r in rows]
    new = Level(np.cumsum(size) - size, size, [r[1] for r in rows], low[shards], contexts[shards], [r[2] for r in rows])
    if top:
        _set_seen(new, [r[4:] for r in rows])

    # the level below goes by how many different tokens stand before its n-grams
    def adjust(table: pa.Table) -> pa.Table:
        t = table.column("shard")[0].as_py()
        left = np.zeros(int(below.size[t]), np.int64)
        for ids, n in zip(table.column("ids").to_pylist(), table.column("left").to_pylist(), strict=True):
            if ids:
                left[np.cumsum(np.frombuffer(ids, np.uint32).astype(np.int64))] += np.frombuffer(n, np.uint32)
        if k == 1:
            by, seen = {}, _statistics(left, np.zeros(len(left), np.int64), 1)[1]
        else:
            left = np.where(left == 0, get(below.sums[t])["n"], left)  # at the beginning of texts
            by, seen = _statistics(left, get(below.paths[t])["key"] >> 32, int(below.contexts[t]))
        return pa.table([pa.array([x]) for x in (t, put(folder, {"n": left, **by}), *seen)], names=["shard", "path", *_SEEN])

    every = spark.createDataFrame([(t, None, None) for t in range(len(below.size))], "shard int, ids binary, left binary")
    partial = merged.where("path is null").select("shard", "ids", "left").unionByName(every)
    done = sorted(tuple(r) for r in partial.groupBy("shard").applyInArrow(adjust, f"shard long, path string, {', '.join(f'{c} long' for c in _SEEN)}").collect())
    below.sums = [r[1] for r in done]
    _set_seen(below, [r[2:] for r in done])
    model.levels.append(new)


def _set_seen(level: Level, rows: list[tuple]) -> None:
    c = [sum(x) for x in zip(*rows, strict=True)] or [0] * 6
    level.discounts, level.seen = discounts_of(c[:4]), (c[0], c[1], c[4], c[5])


_SEEN = ["c1", "c2", "c3", "c4", "more", "total"]
_MERGED = {"shard": pa.int32(), "path": pa.string(), "sums": pa.string(), "size": pa.int64(), **dict.fromkeys(_SEEN, pa.int64()), "ids": pa.binary(), "left": pa.binary()}
_NAMES = {pa.int32(): "int", pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}


def held_out(key):
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """The model of n-grams up to ``order`` (2 or more) words, counted over all ``docs``."""
    prepare(docs.sparkSession)
    folder = arrays_folder(docs.sparkSession)
    model = count_words(docs, folder, text)
    for k in range(2, order + 1):
        count_level(docs, model, folder, text, k == order)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t", PASS_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in model.log_scores(*token_hashes(data, off)))], names=["k", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("k", key)


def lm_scores(docs: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; learns from rows that aren't held out."""
    model = train(docs.where(~held_out(F.col(key))), text, order)
    found = score(docs, model, text, key)
    return found.select(key, held_out(F.col(key)).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
