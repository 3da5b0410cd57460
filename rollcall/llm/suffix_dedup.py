"""Exact removal of repeated strings: merged Burrows-Wheeler transforms over content-routed shards.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere (same document included) goes.

Routing. Of each ``LENGTH``-byte string the ``GRAM``-byte piece with the least hash is its anchor (the
rightmost of equals), so two equal strings have equal anchors at the same place in them. The strings of
an anchor are cut in ``PARTS`` by that place; those of one part all hold a core around the anchor, and
anchor, part and core are their route. A context is what the strings of one route at one spot cover.
A route that occurs once proves its strings unique. Of all others the contexts go on: one of each content,
and a second one (of another place) where a content occurs again. Routing decides nothing else.

Merging. Contexts are dealt into buckets by route. What a bucket's contexts hold from the anchor on, and what
they hold before it read backwards, are two sets of strings over symbols of ``SYMBOL`` bytes (named in byte
order, by their bytes). Each set arrives in shards; each shard's transform is built, and transforms are merged
in pairs by interleave refinement: the interleave is stably redistributed by the preceding symbols until
no block splits any more; the round in which a border first appears is the longest common prefix there. So
both sets come out sorted with their LCP values without sorting a suffix again. The string that begins d
bytes before an anchor is repeated if another context is in the same LCP interval of d bytes backwards and of
LENGTH - d bytes forwards: these intervals, and no hash, say what is removed.

Hot routes. A route with more than ``HOT`` different contexts is cut again by the anchor's place in the
string, into quarters with longer cores, until groups are small or the core is the whole string: a
passage that stands in every document neither meets in one task nor is cut off. Places of a content
get its result by a join, in which contents that hold over a thousandth of all places (at most 1,000 of
them) are broadcast, so that no hot one gathers in a task.

Null text is empty: 0 bytes, nothing removed. Rows that repeat (same doc_id, same text) are copies of each
other. Texts shorter than LENGTH keep everything. An empty table gives no rows. Long texts are routed in
stretches of ``SLICE_BYTES``, so the memory of a task grows with a text only as its own bytes do. Columns
other than key and text aren't read, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, materialize, mix, prefix_hash, prepare, slices, span_hash, spread_join

#: Bytes of a string whose repetition counts; bytes of an anchor.
LENGTH, GRAM = 400, 32
#: Parts that an anchor's strings are cut into at first.
PARTS = 2
#: Different contexts of one route that stay together; contexts of one bucket, of one shard.
HOT, BUCKET, SHARD = 2048, 2048, 512
#: Bytes of a symbol of the transforms.
SYMBOL = 32

_RNG = np.random.default_rng(11)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD1342543DE82EF95)
_PLACE = np.uint64((1 << 28) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each data[i:i+gram], put together from pieces of 1, 2, 4, ... bytes."""
    piece, size, scale = _BYTES[data], 1, int(_STEP)
    out, have, out_scale = None, 0, 1
    while True:
        if gram & size:
            if out is None:
                out, have = piece, size
            else:
                n = len(data) - have - size + 1
                out = out[:n] * np.uint64(pow(scale, 1, 1 << 64)) + piece[have : have + n]
                have += size
        if size * 2 > gram:
            break
        n = len(piece) - size
        piece = piece[:n] * np.uint64(scale) + piece[size:]
        scale = scale * scale % (1 << 64)
        size *= 2
    return mix(out[: max(0, len(data) - gram + 1)])


def window_minima(h: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` hashes the place of the least, the rightmost of equals."""
    if len(h) < window:
        return np.zeros(0, np.int64)
    v = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=np.uint64))
    size = 1
    while size * 2 <= window:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    n = len(h) - window + 1
    v = np.minimum(v[:n], v[window - size : window - size + n])
    return (_PLACE - (v & _PLACE)).astype(np.int64)


def routes_of(data: np.ndarray, off: np.ndarray, length: int, gram: int, width: int) -> tuple[np.ndarray, ...]:
    """(text, route, place of anchor, begin and end of context) of each route of a slice, places in the slice."""
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    h = gram_hashes(data, gram)
    least = window_minima(h, length - gram + 1)
    whole = np.zeros(len(data) + 1, np.int64)
    big = np.diff(off) >= length
    np.add.at(whole, off[:-1][big], 1)
    np.add.at(whole, off[1:][big] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(whole)[: len(least)] > 0)
    if not len(start):
        return routes_of(data[:0], off[:1], length, gram, width)
    anchor = least[start]
    part = (anchor - start) // width
    fresh = np.ones(len(start), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)
    cut = np.flatnonzero(fresh)
    begin, anchor, part = start[cut], anchor[cut], part[cut]
    end = start[np.append(cut[1:], len(start)) - 1] + length
    low = part * width
    high = np.minimum(low + width - 1, length - gram)
    core = span_hash(prefix_hash(data), anchor - low, anchor - high + length)
    text = np.searchsorted(off, begin, "right") - 1
    return text, mix(core ^ mix(h[anchor] + part.astype(np.uint64))), anchor, begin, end


def route_table(docs: DataFrame, length: int, gram: int, width: int, most: int = SLICE_BYTES) -> DataFrame:
    """(g, ctx, id, s, a, size): route, hash of its context, row, first byte, place of the anchor in it, bytes."""

    def stretches(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """A slice as it is; a long text by its starts, each stretch with the rest of its last string."""
        if len(off) > 2 or len(data) <= 2 * most:
            yield data, off, 0
            return
        for lo in range(0, len(data) - length + 1, most):
            part = data[lo : lo + most + length - 1]
            yield part, np.array([0, len(part)]), lo

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, whole, all_off in slices(batch, "t"):
                for data, off, shift in stretches(whole, all_off):
                    text, route, place, begin, end = routes_of(data, off, length, gram, width)
                    ctx = mix(span_hash(prefix_hash(data), begin, end) + (place - begin).astype(np.uint64))
                    cols = [pa.array(route.view(np.int64)), pa.array(ctx.view(np.int64)), part.column(0).take(pa.array(text))]
                    cols += [pa.array(x.astype(np.int32)) for x in (begin - off[:-1][text] + shift, place - begin, end - begin)]
                    yield pa.RecordBatch.from_arrays(cols, names=["g", "ctx", "id", "s", "a", "size"])

    return docs.select("id", "t").mapInArrow(run, "g long, ctx long, id long, s int, a int, size int")


class Transform:
    """A BWT over phrase symbols of several strings, with the place each sorted suffix begins at and its LCP."""

    def __init__(self, bwt: np.ndarray, place: np.ndarray, lcp: np.ndarray, strings: int):
        self.bwt, self.place, self.lcp, self.strings = bwt, place, lcp, strings

    @classmethod
    def build(cls, symbols: np.ndarray, first: np.ndarray, base: int) -> Transform:
        """Of one shard. symbols: all strings, each closed by 0; first: where each begins; base: place of symbol 0 overall."""
        n = len(symbols)
        string = np.zeros(n, np.int64)
        string[first] = 1
        string = np.cumsum(string) - 1
        last = np.append(first[1:], n) - 1
        # closing symbols differ and come first, in order of their strings
        rank = symbols.astype(np.int64) + len(first)
        rank[last] = np.arange(len(first))
        step = 1
        while True:
            order = np.argsort(rank, kind="stable")
            new = np.ones(n, bool)
            new[1:] = rank[order][1:] != rank[order][:-1]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(new)
            if new.all():
                break
            after = np.arange(n) + step
            inside = after <= last[string]
            rank = rank * (n + 1) + np.where(inside, rank[np.minimum(after, n - 1)], 0)
            step *= 2
        before = symbols[order - 1]
        before[order == first[string[order]]] = 0
        return cls(before, order + base, np.zeros(n, np.int32), len(first))

    def merge(self, other: Transform, deepest: int = 1 << 30) -> Transform:
        """Interleave refinement of two transforms; other's strings come after this one's.

        Prefixes longer than ``deepest`` symbols count as equal: suffixes are in order up to there, which
        is all that a later merge with the same limit reads.
        """
        n, m = len(self.bwt), len(self.bwt) + len(other.bwt)
        ends = self.strings + other.strings
        side = np.zeros(m, bool)
        side[n:] = True
        closing = np.zeros(ends, bool)
        closing[self.strings :] = True
        lcp = np.full(m, -1, np.int32)
        block = np.zeros(m, np.int64)
        bwt = np.concatenate([self.bwt, other.bwt])
        size = np.bincount(bwt)
        start = np.cumsum(size) - size
        bwt = bwt.astype(np.uint16) if len(size) <= 1 << 16 else bwt
        depth = 0
        while depth <= deepest:
            said = np.empty(m, bwt.dtype)
            said[~side], said[side] = bwt[:n], bwt[n:]
            order = np.argsort(said, kind="stable")
            side, moved = side[order], block[order]
            side[:ends] = closing
            border = np.ones(m, bool)
            border[1:] = moved[1:] != moved[:-1]
            border[start[size > 0]] = True
            border[:ends] = True
            fresh = border & (lcp < 0)
            if not fresh.any():
                break
            lcp[fresh] = depth
            block = np.cumsum(lcp >= 0)
            depth += 1
        place = np.empty(m, np.int64)
        place[~side], place[side] = self.place, other.place
        said = np.empty(m, bwt.dtype)
        said[~side], said[side] = bwt[:n], bwt[n:]
        lcp[lcp < 0] = depth
        return Transform(said.astype(np.int64), place, lcp, ends)


def symbols_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, bytes, first symbol of each string): the strings in symbols of SYMBOL bytes, the last one filled up with zeros.

    Names are ranks in byte order, a shorter symbol before a longer one that differs in zeros only.
    """
    size = np.diff(off)
    count = -(-size // SYMBOL)
    first = np.concatenate([[0], np.cumsum(count)])
    raw = np.zeros((int(first[-1]), SYMBOL), np.uint8)
    raw.reshape(-1)[np.arange(len(data)) + np.repeat(first[:-1] * SYMBOL - off[:-1], size)] = data
    used = np.full(len(raw), SYMBOL)
    used[first[1:][count > 0] - 1] = (size - (count - 1) * SYMBOL)[count > 0]
    words = raw.view(">u8").astype(np.uint64)
    name = np.zeros(len(raw), np.int64)
    for column in [*words.T, used]:
        values, own = np.unique(column, return_inverse=True)
        _, name = np.unique(name * len(values) + own, return_inverse=True)
    return name, raw, first


def sorted_strings(data: np.ndarray, off: np.ndarray, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """(strings in byte order, bytes that each but the first shares with the one before), from merged transforms of shards."""
    n = len(off) - 1
    name, raw, begin = symbols_of(data, off)
    count = np.diff(begin)
    closed = np.cumsum(count + 1)
    first = closed - count - 1
    flat = np.zeros(int(closed[-1]), np.int64)
    flat[np.arange(len(name)) + np.repeat(np.arange(n), count)] = name + 1
    parts = []
    for lo in range(0, n, shard):
        hi = min(n, lo + shard)
        base = int(first[lo])
        parts.append(Transform.build(flat[base : int(closed[hi - 1])], first[lo:hi] - base, base))
    if len(parts) == 1:  # a lone shard still gets its LCP values from refinement, with an empty partner
        parts.append(Transform(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), 0))
    while len(parts) > 1:
        parts = [parts[k].merge(parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    done = parts[0]
    string = np.full(len(flat), -1)
    string[first] = np.arange(n)
    at = np.flatnonzero(string[done.place] >= 0)
    order = string[done.place[at]]
    if n < 2:
        return order, np.zeros(0, np.int64)
    shared = np.minimum.reduceat(done.lcp[1 : at[-1] + 1], at[:-1]).astype(np.int64)
    x, y = order[:-1], order[1:]
    size = np.diff(off)
    least = np.minimum(size[x], size[y])
    # where both go on, the symbols that differ still share bytes
    on = np.flatnonzero(shared < np.minimum(count[x], count[y]))
    differ = raw[begin[x[on]] + shared[on]] != raw[begin[y[on]] + shared[on]]
    more = np.zeros(len(shared), np.int64)
    more[on] = np.where(differ.any(1), differ.argmax(1), SYMBOL)
    return order, np.minimum(shared * SYMBOL + more, least)


def interval_table(order: np.ndarray, shared: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """(strings, depths): number of the LCP interval of each depth that each string lies in."""
    found = np.zeros((len(order), len(depths)), np.int64)
    found[order[1:]] = np.cumsum(shared[:, None] < depths[None, :], axis=0)
    return found


def repeated_starts(data: np.ndarray, off: np.ndarray, anchor: np.ndarray, length: int = LENGTH, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """(context, start in it) of the strings that stand in several contexts. anchor: its place in each context."""
    n, size = len(off) - 1, np.diff(off)
    place = np.arange(len(data)) - np.repeat(off[:-1], size)
    ahead = place >= np.repeat(anchor, size)
    forward = sorted_strings(data[ahead], np.concatenate([[0], np.cumsum(size - anchor)]), shard)
    order, shared = sorted_strings(data[::-1][~ahead[::-1]], np.concatenate([[0], np.cumsum(anchor[::-1])]), shard)
    low, high = np.maximum(0, anchor + length - size), anchor
    depths = np.arange(int(low.min()), int(high.max()) + 1)
    back = interval_table(n - 1 - order, shared, depths)
    ahead = interval_table(*forward, length - depths)
    many = high - low + 1
    context = np.repeat(np.arange(n), many)
    depth = np.arange(len(context)) - np.repeat(np.cumsum(many) - many, many) + low[context]
    column = depth - depths[0]
    key = (column * n + back[context, column]) * n + ahead[context, column]
    order = np.argsort(key, kind="stable")
    equal = key[order][1:] == key[order][:-1]
    same = np.zeros(len(key), bool)
    same[order[1:][equal]] = True
    same[order[:-1][equal]] = True
    return context[same], (anchor[context] - depth)[same]


def _bucket_ranges(table: pa.Table, length: int) -> pa.Table:
    """(g, ctx, n, b, len): the bytes of each content that the contexts of one bucket prove repeated."""
    column = table["bytes"].combine_chunks().cast(pa.large_binary())
    _, offsets, raw = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]]
    context, start = repeated_starts(data, off - off[0], table["a"].to_numpy().astype(np.int64), length)
    n = len(table)
    low, high = np.full(n, 1 << 30), np.full(n, -1)
    np.minimum.at(low, context, start)
    np.maximum.at(high, context, start)
    # strings of one context begin less than a string's length apart, so what they cover has no gap
    full = np.flatnonzero((high >= 0) & (table["c"].to_numpy() == 0))
    rows = table.select(["g", "ctx", "n"]).take(pa.array(full))
    return rows.append_column("b", pa.array(low[full].astype(np.int32))).append_column("len", pa.array((high - low)[full].astype(np.int32) + length))


def _candidates(classes: DataFrame) -> DataFrame:
    """Contents (g, ctx, n, ...) of routes that occur more than once, with kinds: the contents of the route."""
    seen = classes.groupBy("g").agg(F.count("*").alias("kinds"), F.sum("n").alias("total")).where("total > 1").drop("total")
    return spread_join(classes, materialize(seen), ["g"], "kinds")


def _copies(classes: DataFrame, fields: list[str]) -> DataFrame:
    """A row for each content, and a second one (c 1) for contents that occur again: fields x from x and x2."""
    one = F.struct(F.lit(0).alias("c"), *(F.col(x) for x in fields))
    two = F.struct(F.lit(1).alias("c"), *(F.col(f"{x}2").alias(x) for x in fields))
    own = [x for x in classes.columns if x.removesuffix("2") not in fields]
    return classes.select(*own, F.explode(F.when(F.col("n") > 1, F.array(one, two)).otherwise(F.array(one))).alias("x")).select(*own, "x.*")


def repeated_ranges(contexts: DataFrame, width: int, length: int, hot: int, bucket: int) -> DataFrame:
    """(g, ctx, n, b, len): of each content its repeated bytes, if any. contexts: g, ctx, n, kinds, lo, a, size, c, bytes."""
    calm, busy = contexts.where(F.col("kinds") <= hot), contexts.where(F.col("kinds") > hot)
    n_calm, n_busy = calm.count(), busy.count()
    buckets = max(1, -(-n_calm // bucket))
    dealt = calm.select("g", "ctx", "n", "c", "a", "bytes", F.pmod(F.xxhash64("g"), F.lit(buckets)).alias("bucket")).repartition(buckets, "bucket")
    found = dealt.groupBy("bucket").applyInArrow(lambda t: _bucket_ranges(t, length), "g long, ctx long, n long, b int, len int")
    if not n_busy:
        return materialize(found)
    narrow = -(-width // 4)
    high = F.least(F.col("lo") + width - 1, F.lit(length - 1))
    cut = busy.withColumn("l", F.explode(F.sequence("lo", high, F.lit(narrow)))).withColumn("u", F.least(F.col("l") + narrow - 1, high))
    # of the quarter's offsets, those that this context has
    cut = cut.where((F.col("l") <= F.col("a")) & (F.col("u") >= F.col("a") + length - F.col("size")))
    core = F.substring("bytes", F.col("a") - F.col("l") + 1, length - F.col("u") + F.col("l"))
    begin = F.greatest(F.col("a") - F.col("u"), F.lit(0))
    size = F.least(F.col("a") - F.col("l") + length, F.col("size")) - begin
    cropped = cut.select(F.col("g").alias("pg"), F.col("ctx").alias("pctx"), F.col("n").alias("pn"), "c", begin.alias("shift"), F.xxhash64("g", "l", core).alias("g"), F.col("l").alias("lo"), (F.col("a") - begin).alias("a"), size.alias("size"), F.substring("bytes", begin + 1, size).alias("bytes"))
    cropped = materialize(cropped.withColumn("ctx", F.xxhash64("a", "bytes")))
    classes = cropped.groupBy("g", "ctx").agg(F.count("*").alias("n"), *(F.first(x).alias(x) for x in ("lo", "a", "size", "bytes")), F.last("bytes").alias("bytes2"))
    inner = repeated_ranges(materialize(_copies(_candidates(materialize(classes)), ["bytes"])), narrow, length, hot, bucket)
    members = cropped.where("c = 0").select("pg", "pctx", "pn", "shift", "g", "ctx")
    back = spread_join(members, inner, ["g", "ctx"], "n").select(F.col("pg").alias("g"), F.col("pctx").alias("ctx"), F.col("pn").alias("n"), (F.col("b") + F.col("shift")).alias("b"), "len")
    # strings of one context begin less than their length apart: its ranges overlap and make one
    back = back.groupBy("g", "ctx").agg(F.first("n").alias("n"), F.min("b").alias("b"), F.max(F.col("b") + F.col("len")).alias("e"))
    return materialize(found.unionByName(back.select("g", "ctx", "n", "b", (F.col("e") - F.col("b")).alias("len"))))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """(id, s, size): spans of repeated strings, which may overlap. docs: id (unique), t."""
    width = -(-(length - gram + 1) // PARTS)
    routes = materialize(route_table(docs, length, gram, width))
    classes = routes.groupBy("g", "ctx").agg(F.count("*").alias("n"), F.first("a").alias("a"), F.first("size").alias("size"), *(x for c in ("id", "s") for x in (F.first(c).alias(c), F.last(c).alias(f"{c}2"))))
    wanted = _copies(_candidates(materialize(classes)).withColumn("lo", (F.floor(F.col("a") / width) * width).cast("int")), ["id", "s"])
    # texts stream past their contexts, which are cut out on the way
    joined = docs.select("id", F.col("t").cast("binary").alias("t")).join(wanted.hint("merge"), "id")
    contexts = materialize(joined.select("g", "ctx", "n", "kinds", "lo", "a", "size", "c", F.substring("t", F.col("s") + 1, F.col("size")).alias("bytes")))
    found = repeated_ranges(contexts, width, length, hot, bucket)
    return spread_join(routes.select("g", "ctx", "id", "s"), found, ["g", "ctx"], "n").select("id", (F.col("s") + F.col("b")).alias("s"), F.col("len").alias("size"))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, hot: int = HOT, bucket: int = BUCKET) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept binary) of every row."""
    prepare(docs.sparkSession)
    # a number of its own for each row, fixed by the table it is written to
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("id"), F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")))
    spans = repeated_spans(rows, length, gram, hot, bucket)
    lists = materialize(spans.groupBy("id").agg(F.collect_list(F.struct("s", "size")).alias("spans")))
    joined = rows.join(lists.hint("shuffle_hash"), "id", "left").select("k", F.col("t").cast("binary").alias("b"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, spans = batch.column(1), batch.column(2)
            out = []
            for k in range(batch.num_rows):
                b, cut = whole[k].as_py(), spans[k].as_py()
                if not cut:
                    out.append((len(b), 0, 0, b))
                    continue
                kept, at, gone, n = [], 0, 0, 0
                for s, e in sorted((x["s"], x["s"] + x["size"]) for x in cut):
                    if s > at or not n:
                        kept.append(b[at:s])
                        gone += e - s
                        n += 1
                        at = e
                    elif e > at:
                        gone += e - at
                        at = e
                kept.append(b[at:])
                out.append((len(b), gone, n, b"".join(kept)))
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["k", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = rows.schema["k"].dataType.simpleString()
    return joined.mapInArrow(run, f"k {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("k", key)


#: DuckDB SQL of the query over documents: every string of 400 bytes by hash, then runs of repeated ones.
REPEATS_SQL = """
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT rid, b, unnest(range(1, octet_length(b) - 398)) AS i FROM docs WHERE octet_length(b) >= 400),
hashed AS (SELECT rid, i, hash(b[i:i + 399]) AS h FROM starts),
repeated AS (SELECT rid, i FROM hashed WHERE h IN (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1)),
marked AS (SELECT rid, i, CASE WHEN i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 400 THEN 1 ELSE 0 END AS fresh FROM repeated),
numbered AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM marked),
runs AS (SELECT rid, min(i) AS s, max(i) + 400 AS e FROM numbered GROUP BY rid, run),
gaps AS (SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 1) AS a, s AS z FROM runs UNION ALL
         SELECT d.rid, coalesce(max(e), 1), octet_length(any_value(b)) + 1 FROM docs d LEFT JOIN runs r ON d.rid = r.rid GROUP BY d.rid),
kept AS (SELECT g.rid, unhex(string_agg(hex(b[a:z - 1]), '' ORDER BY a, z)) AS k FROM gaps g JOIN docs d ON g.rid = d.rid GROUP BY g.rid),
sizes AS (SELECT rid, sum(e - s) AS n_removed, count(*) AS n_spans FROM runs GROUP BY rid)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(k) AS kept_sha256
FROM docs JOIN kept USING (rid) LEFT JOIN sizes USING (rid)
"""
