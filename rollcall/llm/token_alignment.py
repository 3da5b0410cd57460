"""Alignment of the tokens that two tokenizers give for the same bytes, over a whole corpus.

Tokenizer A is a byte-level BPE file, B a sentencepiece BPE model that adds a space; A encodes space + text. Offsets where tokens of
both end cut a text's bytes into groups; a link is a pair of tokens whose bytes overlap. How many links of the corpus hold a pair
of ids says how well they belong together.

A text is cut at safe places: before a space that follows a solid byte and comes before a solid character. There A's pattern begins a
word, and no entry of B holds a space behind another character, so both encode each side as they do together; and tokens of
both end there. What lies between is a unit. Equal units have equal tokens, groups and links, so the different
units of the corpus are counted first, each is encoded once, and texts are sums over their units.

Texts longer than a chunk become byte ranges spread over tasks. A range knows its first and last safe place: the bytes before
(open prefix), what lies between (closed), the bytes behind (open suffix); without a safe place all of it is open. Two
neighbours compose to one such fragment, whose middle gains suffix + prefix as a closed part. This is
associative, and a tree of rounds over (text, range number div 2) reduces all long texts at once; closed parts leave it as rows.

Units, pair counts and the units' sums are sorted arrays in the shared folder that workers map; a row for
each file is all that the driver sees. Units are told apart by 64-bit hashes once they are encoded.

A text that is null, empty or not restored by its tokens (B knows no U+2581) has none and counts nowhere. Repeated rows are
counted and returned as often as they occur; an empty table gives no rows; a null key is a key like any other. Only key and text are
read, so no name can clash. A text without any safe place is one unit, encoded in one task, as its tokens depend on all of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cuts as stretches
from .common import materialize, prefix_hash, prepare, span_hash
from .shared_arrays import Shards, arrays_folder, get, put

#: Bytes of a range of a long text, of one pass over texts, and units encoded at a time.
CHUNK_BYTES, PASS_BYTES, UNITS = 1 << 16, 1 << 20, 1 << 14
#: Bytes before and behind a space where a text may be cut; lead bytes of white space beyond ASCII are left out.
_BEFORE, _BEHIND = np.ones(256, bool), np.zeros(256, bool)
_BEFORE[[9, 10, 11, 12, 13, 32]] = False
_BEHIND[0x21:0x7F] = _BEHIND[0xC3:0xF5] = True
_BEHIND[[0xE1, 0xE2, 0xE3]] = False
_vocabularies: dict[tuple[str, str], tuple] = {}


def safe_places(data: np.ndarray) -> np.ndarray:
    """Whether a text may be cut before each byte; not at its edges, where a neighbour isn't known."""
    out = np.zeros(len(data), bool)
    if len(data) > 2:
        out[1:-1] = (data[1:-1] == 32) & _BEFORE[data[:-2]] & _BEHIND[data[2:]]
    return out


class Vocabulary:
    """Both tokenizers, and the bytes of their entries; loaded once in a worker."""

    def __init__(self, a: str, b: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        plain = [x for r in ((33, 127), (161, 173), (174, 256)) for x in range(*r)]
        byte = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in set(plain))}
        size = self.a.get_vocab_size(with_added_tokens=True)
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [bytes(byte[c] for c in w) if all(c in byte for c in w) else w.encode() for w in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in w[1:].lstrip("▁") or (w.strip("▁") and not w.startswith("▁") and "▁" in w) for w in pieces):
            raise ValueError("an entry of the second tokenizer goes over a space, so texts can't be cut before spaces")
        self.b_bytes = [bytes([int(w[3:-1], 16)]) if self.b.is_byte(i) else w.replace("▁", " ").encode() for i, w in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(w) for w in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_name, self.b_name = ([str(i) for i in range(len(x))] for x in (self.a_bytes, self.b_bytes))

    def encode(self, units: list[bytes]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """(ids of A, ids of B, whether they restore the unit) of units that begin with a space."""
        texts = [u.decode("utf-8", "replace") for u in units]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        good = np.ones(len(units), bool)
        for ids, entry in ((a, self.a_bytes), (b, self.b_bytes)):
            for k, (x, u) in enumerate(zip(ids, units, strict=True)):
                if b"".join([entry[i] for i in x]) != u:
                    good[k] = False
        return a, b, good


def vocabulary(a: str, b: str) -> Vocabulary:
    if (a, b) not in _vocabularies:
        _vocabularies[a, b] = Vocabulary(a, b)
    return _vocabularies[a, b]


def align(units: list[bytes], v: Vocabulary) -> dict[str, np.ndarray]:
    """For each unit: good, n_a, n_b, n_groups, and in one array after the other its links (id of B << 32 | id of A) and its groups as text."""
    a, b, good = v.encode(units)
    a = [x if g else [] for x, g in zip(a, good, strict=True)]
    b = [x if g else [] for x, g in zip(b, good, strict=True)]
    size = np.where(good, [len(u) for u in units], 0).astype(np.int64)
    n_a, n_b = (np.array([len(x) for x in y], np.int64) for y in (a, b))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(y), np.int64, int(n.sum())) for y, n in ((a, n_a), (b, n_b)))
    total = int(size.sum())
    ends = np.zeros((2, total + 1), bool)
    ends[0, np.cumsum(v.a_size[ids_a])] = True
    ends[1, np.cumsum(v.b_size[ids_b])] = True
    some, both = np.flatnonzero(ends[0] | ends[1]), np.flatnonzero(ends[0] & ends[1])
    # between two neighbouring ends lies a part of just one token of each, and each pair has one such part
    before = np.cumsum(ends, 1)
    at_a, at_b = before[0, some - 1], before[1, some - 1]
    links = ids_b[at_b] << 32 | ids_a[at_a]
    stop = np.cumsum(size)
    cut_a, cut_b = before[0, both].tolist(), before[1, both].tolist()
    groups, names_a, names_b = [], v.a_name, v.b_name
    flat_a, flat_b = ids_a.tolist(), ids_b.tolist()
    i = j = 0
    for p, q in zip(cut_a, cut_b, strict=True):
        groups.append((names_a[flat_a[i]] if p - i == 1 else ",".join([names_a[x] for x in flat_a[i:p]])) + "|" + (names_b[flat_b[j]] if q - j == 1 else ",".join([names_b[x] for x in flat_b[j:q]])))
        i, j = p, q
    last_group = np.searchsorted(both, stop, "right")
    first_group = np.concatenate([[0], last_group[:-1]])
    text = [";".join(groups[x:y]).encode() for x, y in zip(first_group.tolist(), last_group.tolist(), strict=True)]
    return {
        "good": good, "n_a": n_a.astype(np.int32), "n_b": n_b.astype(np.int32), "n_groups": (last_group - first_group).astype(np.int32),
        "link_end": np.searchsorted(some, stop, "right").astype(np.int64), "links": links,
        "text_end": np.cumsum([len(t) for t in text]).astype(np.int64), "text": np.frombuffer(b"".join(text), np.uint8),
    }


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)), off - off[0]


def units_of(column: pa.Array, most: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of parts: (first part, part behind, bytes, starts and hashes of units, first unit of each part and the number of units)."""
    data, off = _bytes(column)
    at = 0
    while at < len(off) - 1:
        to = min(len(off) - 1, max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1))
        own, rel = data[off[at] : off[to]], off[at : to + 1] - off[at]
        place = safe_places(own)
        edge = rel[1:-1][(rel[1:-1] > 0) & (rel[1:-1] < len(own))]
        place[edge - 1] = False  # its neighbour is of another part
        place[edge] = True
        if len(own):
            place[0] = True
        starts = np.flatnonzero(place)
        ends = np.append(starts[1:], len(own)) if len(own) else starts
        if len(own) > 4 * most:  # one long part: its hashes in stretches, the same as in one go
            turn = stretches(own, np.ones(256, bool) ^ (np.arange(256) == 32), most)
            bounds = np.searchsorted(starts, turn[1:-1])
            cut = [0, *(int(starts[b]) for b in bounds if b < len(starts)), len(own)]
            hashes = [span_hash(prefix_hash(own[lo:hi]), starts[(starts >= lo) & (starts < hi)] - lo, ends[(starts >= lo) & (starts < hi)] - lo) for lo, hi in zip(cut, cut[1:], strict=False) if lo < hi]
            h = np.concatenate(hashes)
        else:
            h = span_hash(prefix_hash(own), starts, ends)
        yield at, to, own, np.append(starts, len(own)), h.view(np.int64), np.searchsorted(starts, rel)
        at = to


# ---- long texts: byte ranges, composed by a tree of rounds


def _open_ends(chunks: DataFrame) -> DataFrame:
    """(row, doc, k, pre, mid, suf, cut) of byte ranges (row, doc, k, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pre, mid, suf, cut = [], [], [], []
            for piece in batch.column(3).to_pylist():
                safe = np.flatnonzero(safe_places(np.frombuffer(piece, np.uint8)))
                lo, hi = (int(safe[0]), int(safe[-1])) if len(safe) else (len(piece), len(piece))
                for held, x in zip((pre, mid, suf, cut), (piece[:lo], piece[lo:hi], piece[hi:], bool(len(safe))), strict=True):
                    held.append(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(x, pa.binary()) for x in (pre, mid, suf)), pa.array(cut)], names=["row", "doc", "k", "pre", "mid", "suf", "cut"])

    return chunks.mapInArrow(run, f"row long, doc {chunks.schema['doc'].dataType.simpleString()}, k long, pre binary, mid binary, suf binary, cut boolean")


def compose(now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A round of the tree over (row, doc, k, first, pre, suf, cut): (the same for pairs of neighbours, parts closed between them)."""
    pairs = now.groupBy("row", F.expr("k div 2").alias("k")).agg(F.min(F.struct("k", "doc", "first", "pre", "suf", "cut")).alias("a"), F.max(F.struct("k", "doc", "first", "pre", "suf", "cut")).alias("b"))
    two = F.col("a.k") != F.col("b.k")
    pre = F.when(two & ~F.col("a.cut"), F.concat("a.pre", "b.pre")).otherwise(F.col("a.pre"))
    suf = F.when(two & F.col("a.cut") & ~F.col("b.cut"), F.concat("a.suf", "b.pre")).otherwise(F.col("b.suf"))
    then = pairs.select("row", F.col("a.doc").alias("doc"), "k", F.col("a.first").alias("first"), pre.alias("pre"), suf.alias("suf"), (F.col("a.cut") | F.col("b.cut")).alias("cut"))
    closed = pairs.where(two & F.col("a.cut") & F.col("b.cut")).select("row", F.col("a.doc").alias("doc"), (2 * F.col("b.first")).alias("ord"), F.concat("a.suf", "b.pre").alias("bytes"))
    return then, closed


def long_parts(long: DataFrame, chunk: int) -> DataFrame:
    """(row, doc, ord, bytes): closed parts of texts (doc, bytes), in order of ord; row tells equal rows apart."""
    last = F.expr(f"cast((length(bytes) - 1) div {chunk} as int)")
    ranges = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.cast("long").alias("k"), F.substring(F.col("bytes"), i * chunk + 1, F.lit(chunk)).alias("bytes")))
    numbered = long.select(F.monotonically_increasing_id().alias("row"), "doc", "bytes")
    chunks = numbered.select("row", "doc", F.explode(ranges).alias("c")).select("row", "doc", "c.k", "c.bytes")
    ends = materialize(_open_ends(chunks.repartition("row", "k")))
    found = ends.where("cut").select("row", "doc", (2 * F.col("k") + 1).alias("ord"), F.col("mid").alias("bytes"))
    now = ends.select("row", "doc", "k", F.col("k").alias("first"), "pre", "suf", "cut")
    left = ends.agg(F.max("k")).first()[0] or 0
    while left > 0:
        then, closed = compose(now)
        found = found.unionByName(materialize(closed))
        now, left = materialize(then), left // 2
    # a text begins and ends at safe places
    edges = now.select("row", "doc", F.lit(-1).cast("long").alias("ord"), F.col("pre").alias("bytes")).unionByName(now.where("cut").select("row", "doc", F.lit(1 << 60).alias("ord"), F.col("suf").alias("bytes")))
    return materialize(found.unionByName(edges).where(F.length("bytes") > 0))


# ---- units of the corpus


def count_units(parts: DataFrame) -> DataFrame:
    """(hash, unit, n) of all parts (.., bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: list[tuple] = []
            for _, _, data, starts, h, _ in units_of(batch.column(0)):
                order = np.argsort(h, kind="stable")
                first = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]) != 0) if len(h) else order
                seen.append((h[order[first]], np.diff(np.append(first, len(h))), data, starts[order[first]], starts[order[first] + 1]))
            if not seen:
                continue
            h = np.concatenate([s[0] for s in seen])
            order = np.argsort(h, kind="stable")
            first = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]) != 0) if len(h) else order
            n = np.add.reduceat(np.concatenate([s[1] for s in seen])[order], first) if len(h) else order
            base = np.concatenate([[0], np.cumsum([len(s[0]) for s in seen])])
            which = order[first]
            # bytes of the chosen units, run by run
            run_of = np.searchsorted(base, which, "right") - 1
            by = np.argsort(run_of, kind="stable")
            out_h, out_n = h[which][by], n[by]
            texts: list[np.ndarray] = []
            sizes: list[np.ndarray] = []
            for r, (_, _, data, lo, hi) in enumerate(seen):
                mine = which[by][run_of[by] == r] - base[r]
                size = hi[mine] - lo[mine]
                end = np.cumsum(size)
                texts.append(data[np.repeat(lo[mine] - (end - size), size) + np.arange(int(size.sum()))])
                sizes.append(size)
            body = np.concatenate(texts)
            off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
            for at in range(0, len(out_h), 1 << 16):
                to = min(len(out_h), at + (1 << 16))
                unit = pa.LargeBinaryArray.from_buffers(pa.large_binary(), to - at, [None, pa.py_buffer(off[at : to + 1] - off[at]), pa.py_buffer(body[off[at] : off[to]])]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(out_h[at:to]), unit, pa.array(out_n[at:to])], names=["hash", "unit", "n"])

    return parts.select("bytes").mapInArrow(run, "hash long, unit binary, n long")


def encode_units(counted: DataFrame, folder: str, a: str, b: str) -> list[tuple[int, str, bool]]:
    """Encode each different unit once; (least hash, file, whether all are restored) of files sorted by hash."""
    each = counted.repartitionByRange("hash").groupBy("hash", "unit").agg(F.sum("n").alias("n")).sortWithinPartitions("hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(a, b)
        found: list[dict] = []
        for batch in batches:
            for at in range(0, batch.num_rows, UNITS):
                part = batch.slice(at, UNITS)
                got = align(part.column(1).to_pylist(), v)
                got["key"], got["n"] = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 2))
                found.append(got)
        if found:
            for name, body in (("link_end", "links"), ("text_end", "text")):
                add = 0
                for got in found:
                    got[name] = got[name] + add
                    add += len(got[body])
            both = {k: np.concatenate([g[k] for g in found]) for k in found[0]}
            again = np.concatenate([[False], np.diff(both["key"]) == 0])
            if again.any():
                raise ValueError("two different units have the same 64-bit hash")
            path = put(folder, both)
            yield pa.RecordBatch.from_arrays([pa.array(both["key"][:1]), pa.array([path]), pa.array([bool(both["good"].all())])], names=["low", "path", "good"])

    return [tuple(r) for r in each.mapInArrow(run, "low long, path string, good boolean").collect()]


def _unrestored(units: Shards, parts: DataFrame) -> DataFrame:
    """Places (row null: a whole text of its own) of parts with a unit that isn't restored: (row, hash, n) of each of their units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_pylist()
            out: list[tuple] = []
            for at, to, _, _, h, first in units_of(batch.column(0)):
                keys, inv = np.unique(h, return_inverse=True)
                (good,) = units.values(keys, {"good": bool}, True)
                for p in range(at, to):
                    mine = inv[first[p - at] : first[p - at + 1]]
                    bad = not good[mine].all()
                    if bad or rows[p] is not None:
                        place, n = np.unique(mine, return_counts=True)
                        out += [(rows[p], int(keys[k]), int(m), bad) for k, m in zip(place, n, strict=True)]
            if out:
                row, key, n, bad = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(key), pa.array(n), pa.array(bad)], names=["row", "hash", "n", "bad"])

    found = materialize(parts.select("bytes", "row").mapInArrow(run, "row long, hash long, n long, bad boolean"))
    rows = found.where(F.col("row").isNotNull() & F.col("bad")).select("row").distinct()
    return found.where(F.col("row").isNull()).unionByName(found.join(rows, "row", "left_semi"))


def _sorted_shards(df: DataFrame, folder: str, names: dict[str, type]) -> Shards:
    """Write rows (key, the other names) as files sorted by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            arrays = {n: np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]).astype(kind) for k, (n, kind) in enumerate(names.items())}
            yield pa.RecordBatch.from_arrays([pa.array(arrays["key"][:1]), pa.array([put(folder, arrays)])], names=["low", "path"])

    ordered = df.select(*names).repartitionByRange("key").sortWithinPartitions("key")
    return Shards([tuple(r) for r in ordered.mapInArrow(run, "low long, path string").collect()])


def pair_counts(files: DataFrame, less: Shards | None) -> DataFrame:
    """(key, n, best): links of the corpus for each pair of ids, and whether that is the most of its id of B."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                u = get(path)
                n = u["n"] - less.values(u["key"], {"n": np.int64})[0] if less is not None else u["n"]
                links = np.diff(u["link_end"], prepend=0)
                key, weight = u["links"], np.repeat(n, links)
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.diff(key[order], prepend=-1)) if len(key) else order
                n = np.add.reduceat(weight[order], first) if len(key) else weight
                for at in range(0, len(first), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(key[order[first[at : at + (1 << 16)]]]), pa.array(n[at : at + (1 << 16)])], names=["key", "n"])

    summed = files.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
    b = F.expr("shiftright(key, 32)")  # a window holds the pairs of one id of B, one for each id of A at most
    return summed.select("key", "n", (F.col("n") == F.max("n").over(Window.partitionBy(b))).alias("best"))


def unit_sums(files: DataFrame, pairs: Shards, folder: str) -> Shards:
    """What texts sum up: for each unit its tokens, groups, links, best links, and the counts of its links' pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                u = get(path)
                keys, inv = np.unique(u["links"], return_inverse=True)
                n, best = pairs.values(keys, {"n": np.int64, "best": np.int64})
                start = np.concatenate([[0], u["link_end"][:-1]])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x[inv])])[np.append(start, u["link_end"][-1:])]) for x in (n, best)]
                new = put(folder, {"key": u["key"], "n_links": (u["link_end"] - start).astype(np.int32), "count_sum": sums[0], "n_best": sums[1].astype(np.int32), **{k: np.asarray(u[k]) for k in ("good", "n_a", "n_b", "n_groups", "text_end", "text")}})
                yield pa.RecordBatch.from_arrays([pa.array(u["key"][:1]), pa.array([new])], names=["low", "path"])

    return Shards([tuple(r) for r in files.mapInArrow(run, "low long, path string").collect()])


_SUMS = {"good": bool, "n_a": np.int64, "n_b": np.int64, "n_groups": np.int64, "n_links": np.int64, "n_best": np.int64, "count_sum": np.int64}
_OUT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def _summed(parts: DataFrame, units: Shards, digest: bool) -> DataFrame:
    """``parts`` (keys.., bytes) with the sums of each and its groups: their sha256 if ``digest``, else as text."""
    keys = [c for c in parts.columns if c != "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: list[list[np.ndarray]] = []
            texts: list = []
            for at, to, _, _, h, first in units_of(batch.column(0)):
                order = np.argsort(h, kind="stable")
                new = np.diff(h[order], prepend=~h[order[:1]]) != 0 if len(h) else np.zeros(0, bool)
                inv = np.empty(len(h), np.int64)
                inv[order] = np.cumsum(new) - 1
                own = h[order][new]
                values = [np.zeros(len(own), k) for k in _SUMS.values()]
                words: list[bytes] = [b""] * len(own)
                for arrays, here, there in units.find(own):
                    for o, name in zip(values, _SUMS, strict=True):
                        o[here] = arrays[name][there]
                    hi = arrays["text_end"][there]
                    lo = np.where(there > 0, arrays["text_end"][there - 1], 0)
                    body = arrays["text"]
                    for k, x, y in zip(here.tolist(), lo.tolist(), hi.tolist(), strict=True):
                        words[k] = body[x:y].tobytes()
                bounds = first.tolist()
                run_sums = [np.concatenate([[0], np.cumsum(v[inv])]) for v in values]
                per = [s[first[1:]] - s[first[:-1]] for s in run_sums]
                good = per[0] == np.diff(first)
                sums.append([good, *(np.where(good, x, 0) for x in per[1:])])
                place = inv.tolist()
                for p in range(to - at):
                    text = b";".join([words[k] for k in place[bounds[p] : bounds[p + 1]]]) if good[p] else b""
                    texts.append((hashlib.sha256(text).hexdigest() if text else "") if digest else text.decode())
            flat = [np.concatenate([s[k] for s in sums]) if sums else np.zeros(0) for k in range(len(_SUMS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(flat[0].astype(bool)), *(pa.array(x.astype(np.int64)) for x in flat[1:]), pa.array(texts, pa.string())], names=[*keys, "good", *_OUT, "groups"])

    kinds = ", ".join(f"{c} {parts.schema[c].dataType.simpleString()}" for c in keys)
    return parts.select("bytes", *keys).mapInArrow(run, f"{kinds}, good boolean, {', '.join(f'{c} long' for c in _OUT)}, groups string")


def _digests(pieces: DataFrame) -> DataFrame:
    """(row, groups_sha256) of long texts; the hash needs a text's groups in order, so they pass one task piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, some, done = None, None, False, []
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if row != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state, some = row, hashlib.sha256(), False
                if text:
                    state.update(((";" if some else "") + text).encode())
                    some = True
        if now is not None:
            done.append((now, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in done]), pa.array([h for _, h in done])], names=["row", "groups_sha256"])

    return pieces.repartition("row").sortWithinPartitions("row", "ord").select("row", "groups").mapInArrow(run, "row long, groups_sha256 string")


def token_alignment(docs: DataFrame, a: str, b: str, text: str = "text", key: str = "doc_id", chunk: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; files ``a`` and ``b`` must be on every executor."""
    spark = docs.sparkSession
    prepare(spark)
    folder = arrays_folder(spark)
    # space + text; without text no bytes
    own = docs.select(F.col(key).alias("doc"), F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text).cast("string")).cast("binary")).otherwise(F.lit(b"")).alias("bytes"))
    short = own.where(F.length("bytes") <= chunk)
    long = own.where(F.length("bytes") > chunk)
    parts = long_parts(long, chunk)
    every = short.select(F.lit(None).cast("long").alias("row"), "bytes").unionByName(parts.select("row", "bytes"))
    files = encode_units(count_units(every), folder, a, b)
    units = Shards([f[:2] for f in files])
    less = None
    if not all(f[2] for f in files):
        less = _sorted_shards(_unrestored(units, every).groupBy(F.col("hash").alias("key")).agg(F.sum("n").alias("n")), folder, {"key": np.int64, "n": np.int64})
    paths = spark.createDataFrame([(f[1],) for f in files], "path string").repartition(max(1, len(files)))
    pairs = _sorted_shards(pair_counts(paths, less), folder, {"key": np.int64, "n": np.int64, "best": np.int64})
    sums = unit_sums(paths, pairs, folder)
    done = _summed(short, sums, True).select("doc", *_OUT, F.col("groups").alias("groups_sha256"))
    pieces = materialize(_summed(parts, sums, False))
    each = pieces.groupBy("row").agg(F.first("doc").alias("doc"), F.min("good").alias("good"), *(F.sum(c).alias(c) for c in _OUT)).join(_digests(pieces), "row")
    whole = each.select("doc", *(F.when(F.col("good"), F.col(c)).otherwise(F.lit(0)).cast("long").alias(c) for c in _OUT), F.when(F.col("good"), F.col("groups_sha256")).otherwise("").alias("groups_sha256"))
    return done.unionByName(whole).withColumnRenamed("doc", key)
