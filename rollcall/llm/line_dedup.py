"""Line deduplication by pairwise alignment: shared lines find pairs, patience diff aligns them, common blocks go.

Documents are in doc_id order. A line that can find pairs has ``LINE_CHARS`` characters or more. The first
document that holds it owns it, and every later document that holds it is paired with the owner: pairs
are found through the lines that are rare enough to be shared at all, and there are at most as many as
repeated lines, however many documents share one. (Pairing all holders of a line would grow with the
square of a common line; a star around the first one aligns each repeated line just as well.)

A pair is aligned by patience diff: common head and tail, then the longest increasing run of lines unique on
both sides, and again between those. A block of consecutive aligned lines that has at least one line of
``LINE_CHARS`` is deleted from the later document, short lines in it included. The first document with a
line never loses it, so no text vanishes from the corpus.

That is the first round. An owner may hold a line twice or in another order, and then its pair leaves
the line unaligned though another earlier document would align with it. With ``every`` the result is that
of alignment with every earlier document that shares a passage of ``LINE_CHARS`` characters:

- Passages, not lines, find pairs: from each line the least run of lines, forward and backward,
  that has ``LINE_CHARS`` characters. Blocks go by their total characters. So lines that are short themselves
  count as well. Two documents share a block of that size just if they share a run, and the runs of a block
  cover it, so a document whose runs are all deleted has nothing to gain from further pairs.
- Runs that are left after the first round meet all other earlier holders, ``NEXT`` at first and each
  further round so many times more, until they are deleted or out of holders. Holders whose lines are
  the same up to lines that no document left or no other holder has align alike, and only the first of them is compared: documents that
  share nothing but a rule of dashes, twice in each, are one kind.

A run that many documents hold is one of at most 1,000 with over a thousandth of all places, and joined by
broadcast; an earlier document with over ``PAIRS`` pairs is dealt to several tasks. An empty table gives no rows.
The columns n_lines and n_removed replace any of these names, all other columns stay, whatever their names.

Null texts and null doc_ids are left alone; rows that share doc_id and text count as one document, and
rows that share only a doc_id are not compared with each other. Blank lines find no pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, prefix_hash, prepare, slices, span_hash, spread_join

#: Characters of a line that can find pairs and carry a deletion.
LINE_CHARS = 24
#: Further holders that a run left over meets in the second round; each round after that goes so many times as far.
NEXT = 16
#: Pairs of one earlier document that one task aligns; beyond that its lines go to several tasks.
PAIRS = 1000


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i in a, j in b) with a[i] == b[j], increasing in both."""
    out = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and in_b.get(x) == 1}
        tails, ends, back = [], [], {}
        for j in range(b0, b1):
            i = at.get(b[j])
            if i is None:
                continue
            k = bisect_left(tails, i)
            back[(i, j)] = ends[k - 1] if k else None
            if k == len(tails):
                tails.append(i)
                ends.append((i, j))
            else:
                tails[k], ends[k] = i, (i, j)
        if not ends:
            continue
        chain, x = [], ends[-1]
        while x is not None:
            chain.append(x)
            x = back[x]
        chain.reverse()
        out += chain
        for (i, j), (p, q) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)], strict=True):
            stack.append((i + 1, p, j + 1, q))
    return sorted(out)


def aligned_blocks(owner: list[int], later: list[int], size: int = 1, least: int = 1) -> list[int]:
    """Places in ``later`` of the blocks to delete: those whose lines' lowest bits under the mask ``size`` sum to ``least``."""
    out, block, last = [], [], None
    for i, j in [*patience(owner, later), (-9, -9)]:
        if last != (i - 1, j - 1):
            if sum(later[x] & size for x in block) >= least:
                out += block
            block = []
        block.append(j)
        last = (i, j)
    return out


def line_hashes(text: Column, least: int) -> Column:
    """64-bit hash of each line; odd if the line has ``least`` characters."""
    return F.transform(F.split(text, "\n"), lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2)).bitwiseOR((F.length(F.trim(x)) >= least).cast("long")))


def with_lines(pairs: DataFrame, rows: DataFrame, key: str, lines: str) -> DataFrame:
    """``pairs`` with the array ``lines`` of the document ``key``; a document of many pairs goes to several tasks."""
    many = pairs.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > PAIRS)
    dealt = F.pmod(F.xxhash64(*[c for c in pairs.columns if c != key]), F.ceil(F.col("_n") / PAIRS)).cast("int")
    left = pairs.join(many, key, "left").withColumn("_deal", F.coalesce(dealt, F.lit(0))).drop("_n")
    right = rows.select(key, lines).join(many, key, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), F.coalesce(F.ceil(F.col("_n") / PAIRS).cast("int") - 1, F.lit(0))))).drop("_n")
    return left.join(right, [key, "_deal"]).drop("_deal")


def deletions(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LINE_CHARS) -> DataFrame:
    """(k, h, places): for later documents, by doc_id and hash of the text, the numbers of the lines to delete."""
    prepare(docs.sparkSession)
    t = F.col(text).cast("string")
    rows = docs.where(t.isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(t).alias("h"), line_hashes(t, least).alias("lines"))
    rows = materialize(rows)
    held = rows.select("k", "h", F.explode(F.array_distinct("lines")).alias("line")).where("line % 2 != 0")
    owners = materialize(held.groupBy("line").agg(F.min("k").alias("owner"), F.max("k").alias("last"), F.count("*").alias("n")).where("owner < last").drop("last"))
    pairs = spread_join(held, owners, ["line"], "n").where("owner < k").select("k", "h", "owner").distinct()
    once = rows.dropDuplicates(["k", "h"])
    both = with_lines(pairs.join(once.withColumnRenamed("lines", "later"), ["k", "h"]), once.select(F.col("k").alias("owner"), F.col("lines").alias("first")), "owner", "first").select("k", "h", "first", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [aligned_blocks(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["k", "h", "places"])

    kind = docs.schema[key].dataType.simpleString()
    cut = both.mapInArrow(run, f"k {kind}, h long, places array<long>").where(F.size("places") > 0)
    return cut.groupBy("k", "h").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def runs_of(data: np.ndarray, off: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line codes, first line of each text, run hashes, their first lines, their last lines, first run of each text) of a slice.

    A code has min(characters, least) in its lowest bits. Line numbers of runs count from the start of their text.
    """
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.sort(np.concatenate([off[:-1], breaks + 1])), np.sort(np.concatenate([breaks, off[1:]]))
    first = np.searchsorted(breaks, off) + np.arange(len(off))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    solid = np.flatnonzero((data != 32) & (data != 10))
    head, tail = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    chars = np.zeros(len(starts), np.int64)
    some = np.flatnonzero(tail > head)
    count = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars[some] = count[solid[tail[some] - 1] + 1] - count[solid[head[some]]]
    prefix = prefix_hash(data)
    codes = (span_hash(prefix, starts, ends) << np.uint64(least.bit_length())) | np.minimum(chars, least).astype(np.uint64)
    after = np.cumsum(chars)
    before = after - chars
    every = np.arange(len(starts))
    forward, backward = np.searchsorted(after, before + least), np.searchsorted(before, after - least, "right") - 1
    forward_ok, backward_ok = forward < len(starts), backward >= 0
    lo, hi = np.concatenate([every[forward_ok], backward[backward_ok]]), np.concatenate([forward[forward_ok], every[backward_ok]])
    same = doc[lo] == doc[hi]
    both = np.unique(np.stack([lo[same], hi[same]], 1), axis=0) if same.any() else np.zeros((0, 2), np.int64)
    lo, hi = both[:, 0], both[:, 1]
    return codes.view(np.int64), first, span_hash(prefix, starts[lo], ends[hi]).view(np.int64), lo - first[doc[lo]], hi - first[doc[hi]], np.searchsorted(doc[lo], np.arange(len(off)))


def every_deletion(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LINE_CHARS) -> DataFrame:
    """Like ``deletions``, for alignment with every earlier document that shares a run."""
    prepare(docs.sparkSession)
    t = F.col(text).cast("string")
    kind = docs.schema[key].dataType.simpleString()
    mask = (1 << least.bit_length()) - 1

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, off in slices(batch, "t"):
                codes, first, hashes, lo, hi, first_run = runs_of(data, off, least)
                lists = lambda x, at: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists(codes, first), lists(hashes, first_run), lists(lo, first_run), lists(hi, first_run)], names=["k", "h", "lines", "runs", "lo", "hi"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [aligned_blocks(a, b, mask, least) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["k", "h", "places"])

    def uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lines, runs, lo, hi, places in zip(*(batch.column(i).to_pylist() for i in range(2, 7)), strict=True):
                gone = np.zeros(len(lines) + 1, np.int64)
                gone[np.array(places or [], np.int64) + 1] = 1
                gone, lo, hi = np.cumsum(gone), np.array(lo, np.int64), np.array(hi, np.int64)
                out.append(sorted(set(np.array(runs, np.int64)[gone[hi + 1] - gone[lo] <= hi - lo].tolist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["k", "h", "runs"])

    def joined(found: DataFrame) -> DataFrame:
        return found.mapInArrow(align, f"k {kind}, h long, places array<long>").where(F.size("places") > 0)

    def merged(cut: DataFrame) -> DataFrame:
        return cut.groupBy("k", "h").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))

    rows = docs.where(t.isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.xxhash64(t).alias("h"), t.alias("t"))
    rows = materialize(rows.mapInArrow(enter, f"k {kind}, h long, lines array<long>, runs array<long>, lo array<long>, hi array<long>"))
    held = rows.select("k", "h", F.explode(F.array_distinct("runs")).alias("run"))
    owners = materialize(held.groupBy("run").agg(F.min("k").alias("owner"), F.max("k").alias("last"), F.count("*").alias("n")).where("owner < last").drop("last"))
    held = materialize(spread_join(held, owners, ["run"], "n").drop("n"))
    once = rows.dropDuplicates(["k", "h"])
    pairs = held.where("owner < k").select("k", "h", "owner").distinct()
    pairs = materialize(pairs)
    both = with_lines(pairs, once.select(F.col("k").alias("owner"), F.col("lines").alias("first")), "owner", "first").join(once.select("k", "h", F.col("lines").alias("later")), ["k", "h"])
    cut = materialize(merged(joined(both.select("k", "h", "first", "later"))))

    def left_over(among: DataFrame, cut: DataFrame) -> DataFrame:
        """(k, h, run) of ``among`` whose lines aren't all deleted yet."""
        whole = once.join(among.select("k", "h").distinct(), ["k", "h"]).join(cut, ["k", "h"], "left").select("k", "h", "lines", "runs", "lo", "hi", "places")
        still = whole.mapInArrow(uncovered, f"k {kind}, h long, runs array<long>").select("k", "h", F.explode("runs").alias("run"))
        return materialize(still.join(among, ["k", "h", "run"], "left_semi"))

    left = left_over(held.where("owner < k").select("k", "h", "run").distinct(), cut)
    if left.isEmpty():
        return cut
    # holders of runs left, reduced to the lines that documents left and another holder have; -1 (no line's code) stands for any others between them
    later = materialize(once.join(left.select("k", "h").distinct(), ["k", "h"]).select("k", "h", F.col("lines").alias("later")))
    holders = materialize(held.join(left.select("run").distinct(), "run").select("k", "h", "run").distinct())
    wide = once.join(holders.select("k", "h").distinct(), ["k", "h"]).select("k", "h", F.size("lines").alias("n"), F.posexplode("lines").alias("at", "line"))
    # both sides of a pair are holders, so a line that one holder alone has aligns with nothing
    shared = wide.groupBy("line").agg(F.min(F.struct("k", "h")).alias("x"), F.max(F.struct("k", "h")).alias("y")).where("x < y").select("line")
    known = materialize(later.select(F.explode("later").alias("line")).distinct().join(shared, "line"))
    kept = wide.join(known, "line").groupBy("k", "h", "n").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("x"))
    kept = materialize(kept)
    before = lambda i: F.when(i > 0, F.try_element_at("x", i.cast("int"))["at"]).otherwise(F.lit(-1))
    tokens = F.flatten(F.transform("x", lambda y, i: F.when(y["at"] - before(i) > 1, F.array(F.lit(-1).cast("long"), y["line"])).otherwise(F.array(y["line"]))))
    tokens = F.when(F.element_at("x", -1)["at"] < F.col("n") - 1, F.concat(tokens, F.array(F.lit(-1).cast("long")))).otherwise(tokens)
    alike = materialize(kept.select("k", "h", tokens.alias("first")).withColumn("kind", F.sha2(F.to_json("first"), 256)))
    kinds = materialize(alike.groupBy("kind").agg(F.min("k").alias("since"), F.any_value("first").alias("first")))
    listed = holders.join(alike.select("k", "h", "kind"), ["k", "h"]).select("run", "kind").distinct().join(kinds.select("kind", "since"), "kind")
    listed = materialize(listed.withColumn("r", F.row_number().over(Window.partitionBy("run").orderBy("since", "kind"))))
    most = listed.agg(F.max("r")).first()[0]
    low, high = 0, NEXT
    while low < most and not left.isEmpty():
        pairs = left.join(listed.where((F.col("r") > low) & (F.col("r") <= high)), "run").where("since < k").select("k", "h", "kind").distinct()
        both = pairs.join(later, ["k", "h"]).join(kinds.select("kind", "first"), "kind").select("k", "h", "first", "later")
        cut = materialize(merged(cut.unionAll(joined(both))))
        left = left_over(left, cut)
        low, high = high, high * NEXT
    return cut


def dedupe_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = LINE_CHARS, every: bool = False) -> DataFrame:
    """``docs`` with the blocks deleted from the text, and n_lines, n_removed (long). ``every``: not only pairs with the first owner of a line."""
    cut = materialize(deletions(docs, text, key, least)) if not every else every_deletion(docs, text, key, least)
    t = F.col(text).cast("string")
    rows = docs.select(F.struct(*(F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed", text))).alias("row"), F.col(key).alias("own"), F.xxhash64(t).alias("hash"), t.alias("t"))
    joined = rows.join(cut.hint("shuffle_hash"), (F.col("own") == F.col("k")) & (F.col("hash") == F.col("h")), "left")
    lines = F.split("t", "\n")
    kept = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), F.col("places"))
    parts = joined.withColumn("lines", lines).withColumn("kept", F.when(F.col("places").isNotNull(), kept))
    left = F.array_join(F.transform("kept", lambda i: F.get(F.col("lines"), i.cast("int"))), "\n")
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    return parts.select(
        *(F.when(F.col("places").isNotNull(), left).otherwise(F.col("t")).alias(c) if c == text else F.col("row")[c].alias(c) for c in names),
        F.when(F.col("t").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
    )
