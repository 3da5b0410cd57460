"""Conversation structure repair: the cheapest edits that give roles the form (s?(ua)+)?, and the least audit of them.

Rows of a conversation stand in the order of turn (nulls first), then role and text. Each is kept (cost 0), gets
role user or assistant (Rerole, 3) or is deleted (4; blank and duplicate rows must be); rows with role user or
assistant and empty text can be inserted anywhere (3). A truncated row that stays adds 3. An audit is the edits'
initials in order; of the cheapest edits, those with the least audit are made.

Nodes are (rows done, roles so far: none, s, ..u, ..a). A cost-to-go for each comes from the end (the cost DP); arcs that
lie on a cheapest way are the optimal arcs. Prefix doubling ranks the nodes: first by the first letter of the least
audit from there, then by 2, 4, 8, ... letters, a node's rank by 2k letters being that of (its rank by k, the rank by
k of the node k letters on). Of a node's optimal arcs the one with the least (letter, rank) is taken, and the audit is read
off through the doubled pointers, halves of it at a time.

Conversations of any length: a range sort by conversation and turn cuts the table into partitions, and a partition's
rows into fragments of one conversation with bounded rows and bytes, so a conversation with a third of all rows lies
in many tasks. A fragment's effect on costs is a 4 x 4 matrix of minima and sums; these fold from the
end of a conversation to give each fragment the costs behind it, and each fragment then ranks its own
nodes. Letters of a node's arcs differ, so ranks behind a fragment's end never decide within it.

Nulls: a null role or text is one space; a null turn comes first and doesn't count for gaps; rows of a null conversation
are one conversation. Rows that repeat are duplicates but for the first. A conversation all of whose rows are marked
absent keeps its line in the report, with zeros and an empty audit. An empty table gives none. Columns
other than the five named aren't read, so no name can clash. A conversation that isn't a whole number is told by its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare

#: Rows and bytes of text in a fragment, at most (one row more may pass the bytes).
FRAGMENT_ROWS, FRAGMENT_BYTES = 4096, 1 << 22
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FAR = 1 << 40

#: Roles so far: 0 none, 1 s, 2 ends in u, 3 ends in a. Where a user or assistant row leads; it is user but after u.
_ON = np.array([2, 2, 3, 2])
#: Where keeping a row of initial s, u, a or another leads; -1: not allowed.
_KEEP = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
#: Costs behind the last row: nothing more after none or a, else rows are inserted.
_ACCEPT = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
_LETTERS = np.array(["", "D", "I", "K", "R"])
_WHITE = r"[^\x20\x09-\x0D]"


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``rows`` damaged by crc32(conv:turn) % 20: 0 absent, 1 no text, 2 without [.!?], 3 twice, 4 role user; and ``present``."""
    name = F.concat_ws(":", F.coalesce(F.col(conv).cast("string"), F.lit(" ")), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    k = F.crc32(name.cast("binary")) % 20
    own = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), k.alias("k"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    changed = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return own.select("conv", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), (F.col("k") != 0).alias("present"), copies).drop("copy")


def fragments(rows: DataFrame, most_rows: int = FRAGMENT_ROWS, most_bytes: int = FRAGMENT_BYTES) -> DataFrame:
    """(conv, part, seq, kinds, roles, texts, turns) from rows (conv, turn, role, text, present), by part and seq in order.

    kinds has a byte for each row: its initial (0 s, 1 u, 2 a, 3 other), 4 if blank, 8 if truncated.
    """
    prepare(rows.sparkSession)
    # the id tells equal rows apart only so that a great many of them need not be in one partition
    own = rows.select("conv", "turn", "role", "text", "present", F.monotonically_increasing_id().alias("id"))
    order = ["conv", "turn", "role", "text", "id"]
    first, last = F.substring("role", 1, 1), F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    kind = kind + F.when(last == "", 4).when(~last.isin(".", "!", "?"), 8).otherwise(0)
    ranged = own.repartitionByRange(*order).sortWithinPartitions(*order)
    ready = ranged.select("conv", "turn", "role", "text", F.when(F.col("present"), kind).otherwise(F.lit(-1)).cast("int").alias("kind"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held = None

        def out(table: pa.Table) -> tuple:
            here = table.filter(pc.greater_equal(table.column("kind"), 0))
            return table.column("conv")[0].as_py(), bytes(here.column("kind").to_numpy().astype(np.uint8)), here.column("role").to_pylist(), here.column("text").to_pylist(), here.column("turn").to_pylist()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            conv = table.column("conv").combine_chunks()
            n = len(conv)
            other = pc.fill_null(pc.not_equal(conv[1:], conv[:-1]), True).to_numpy(zero_copy_only=False)
            both = pc.and_(pc.is_null(conv[1:]), pc.is_null(conv[:-1])).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(other & ~both) + 1, [n]])
            size = np.concatenate([[0], np.cumsum(pc.binary_length(table.column("text").combine_chunks().cast(pa.large_string())).to_numpy(zero_copy_only=False))])
            cuts = [0]
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                while hi - lo > most_rows or size[hi] - size[lo] > most_bytes:
                    lo = min(hi, lo + most_rows, max(lo + 1, int(np.searchsorted(size, size[lo] + most_bytes, "right")) - 1))
                    cuts.append(int(lo))
                    if lo == hi:
                        break
                if lo < hi:
                    cuts.append(int(hi))
            whole = cuts[:-1] if cuts[-1] == n else cuts  # the last may go on in the next batch
            found = [out(table.slice(a, b - a)) for a, b in zip(whole, whole[1:], strict=False)]
            held = table.slice(whole[-1])
            if found:
                yield _packed(found, part, seq, kind_of)
                seq += len(found)
        if held is not None and held.num_rows:
            yield _packed([out(held)], part, seq, kind_of)

    whole_numbers = rows.schema["conv"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    kind_of, name = (pa.int64(), "long") if whole_numbers else (pa.string(), "string")
    ready = ready.withColumn("conv", F.col("conv").cast(name))
    return ready.mapInArrow(pack, f"conv {name}, part int, seq int, kinds binary, roles array<string>, texts array<string>, turns array<long>")


def _packed(found: list[tuple], part: int, seq: int, conv: pa.DataType) -> pa.RecordBatch:
    c, kinds, roles, texts, turns = zip(*found, strict=True)
    n = len(found)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, conv), pa.array([part] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int32()), pa.array(kinds, pa.binary()), pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())), pa.array(turns, pa.list_(pa.int64()))],
        names=["conv", "part", "seq", "kinds", "roles", "texts", "turns"],
    )


@dataclass
class Graph:
    """Nodes of a batch of fragments: base[f] + 4 * rows done + roles so far. Costs behind each, and its arcs' targets and costs by letter."""

    base: np.ndarray
    togo: np.ndarray
    target: np.ndarray
    optimal: np.ndarray


def costs(kinds: list[np.ndarray], must: list[np.ndarray], behind: np.ndarray, last: np.ndarray) -> Graph:
    """The cost DP of fragments with rows of ``kinds``; ``must``: rows to delete; ``behind``: costs behind the fragment's end by state."""
    n = np.array([len(k) for k in kinds], np.int64)
    base = np.concatenate([[0], np.cumsum(4 * (n + 1))])
    togo = np.full(base[-1], FAR, np.int64)
    end = base[1:] - 4
    togo[end[:, None] + np.arange(4)] = behind
    kind = np.concatenate([*kinds, np.zeros(0, np.uint8)]).astype(np.int64)
    gone = np.concatenate([*must, np.zeros(0, bool)])
    extra = np.where(kind & 8, TRUNCATED, 0)
    row0 = np.concatenate([[0], np.cumsum(n)])
    order = np.argsort(-n, kind="stable")
    for back in range(1, int(n.max(initial=0)) + 1):
        f = order[: int(np.searchsorted(-n[order], -back, "right"))]
        row, node = row0[f + 1] - back, end[f] - 4 * back
        nxt = togo[node[:, None] + 4 + np.arange(4)]
        to = _KEEP[kind[row] & 3]
        stay = np.where(to >= 0, np.take_along_axis(nxt, np.maximum(to, 0), 1), FAR)
        stay = np.minimum(stay, nxt[:, _ON] + REROLE) + extra[row, None]
        v = np.minimum(np.where(gone[row, None], FAR, stay), nxt + DELETE)
        w = v.copy()  # rows may be inserted before this one
        w[:, 2] = np.minimum(v[:, 2], INSERT + v[:, 3])
        w[:, [0, 1, 3]] = np.minimum(v[:, [0, 1, 3]], INSERT + w[:, 2:3])
        togo[node[:, None] + np.arange(4)] = np.minimum(w, FAR)
    # arcs of all nodes, in the order of their letters: D, I, K, R
    total = len(togo)
    node, state = np.arange(total), np.arange(total) % 4
    rows = np.repeat(row0[:-1], 4 * (n + 1)) + (node - np.repeat(base[:-1], 4 * (n + 1))) // 4
    at_end = node >= np.repeat(end, 4 * (n + 1))
    rows = np.where(at_end, 0, rows)
    if len(kind) == 0:
        kind, gone, extra = np.zeros(1, np.int64), np.ones(1, bool), np.zeros(1, np.int64)
    keep = _KEEP[kind[rows] & 3, state]
    below = np.minimum(node - state + 4, total - 4)
    target = np.stack([below + state, node - state + _ON[state], below + np.maximum(keep, 0), below + _ON[state]])
    cost = np.stack([np.full(total, DELETE), np.full(total, INSERT), extra[rows], REROLE + extra[rows]])
    fits = np.stack([~at_end, ~at_end | (np.repeat(last, 4 * (n + 1)) & ((state == 1) | (state == 2))), ~at_end & ~gone[rows] & (keep >= 0), ~at_end & ~gone[rows]])
    return Graph(base, togo, target, fits & (togo < FAR) & (cost + togo[target] == togo))


def rank_paths(g: Graph) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(letter of each node's arc on its least audit, pointers 1, 2, 4, ... letters on, letters to the end), by prefix doubling."""
    total = len(g.togo)
    any_arc = g.optimal.any(0)
    letter = np.where(any_arc, g.optimal.argmax(0) + 1, 0)
    on = np.where(any_arc, g.target[np.maximum(letter - 1, 0), np.arange(total)], np.arange(total))
    rank, pointers, far = letter.astype(np.int64), [on], any_arc.astype(np.int64)
    while any_arc[pointers[-1]].any():
        p = pointers[-1]
        key = rank * (total + 5) + rank[p]
        order = np.argsort(key, kind="stable")
        rank = np.empty(total, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)]) if total else 0
        far = far + far[p]
        pointers.append(p[p])
    # of the optimal arcs, the least by (letter, rank of the target)
    choice = np.where(g.optimal, (np.arange(4)[:, None] + 1) * (total + 5) + rank[g.target], np.iinfo(np.int64).max).argmin(0) + 1
    return np.where(any_arc, choice, 0), pointers, far


def read_paths(start: np.ndarray, pointers: list[np.ndarray], far: np.ndarray) -> list[np.ndarray]:
    """Nodes of the least path from each start, without the last: pointers fill in half of what is missing at a time."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(start)
    length = far[start]
    size = np.ceil(np.log2(np.maximum(length, 1))).astype(int)
    for s in np.unique(size):
        which = np.flatnonzero(size == s)
        path = start[which][:, None]
        for k in range(s - 1, -1, -1):
            path = np.stack([path, pointers[k][path]], 2).reshape(len(which), -1)
        for f, p in zip(which, path, strict=True):
            out[f] = p[: length[f]]
    return out


def _codes(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(k, np.uint8) for k in batch.column(batch.schema.get_field_index("kinds")).to_pylist()]


def _firsts(roles: list, texts: list, firsts: list | None) -> np.ndarray:
    """Whether each row of a fragment has a role and text not seen before; ``firsts``: its places that have, if known."""
    new = np.zeros(len(roles), bool)
    if firsts is not None:
        new[firsts] = True
        return new
    seen = set()
    for k, both in enumerate(zip(roles, texts, strict=True)):
        if both not in seen:
            seen.add(both)
            new[k] = True
    return new


def _faults(batch: pa.RecordBatch) -> tuple[list, list, list, list, list]:
    """(kinds, rows to delete, duplicates, roles, texts) of each fragment."""
    col = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
    kinds, roles, texts = _codes(batch), col("roles"), col("texts")
    firsts = col("firsts") if "firsts" in batch.schema.names else [None] * len(kinds)
    double = [~_firsts(r, t, f) & (k & 4 == 0) for r, t, f, k in zip(roles, texts, firsts, kinds, strict=True)]
    return kinds, [(k & 4 > 0) | d for k, d in zip(kinds, double, strict=True)], double, roles, texts


_BEHIND = "last boolean, behind array<long>"


def _matrices(found: DataFrame) -> DataFrame:
    """(conv, part, seq, matrix): costs of getting from each state before the fragment to each after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, must, *_ = _faults(batch)
            flat = np.zeros((len(kinds), 4, 4), np.int64)
            for q in range(4):
                g = costs(kinds, must, np.where(np.arange(4) == q, 0, FAR)[None, :].repeat(len(kinds), 0), np.zeros(len(kinds), bool))
                flat[:, :, q] = g.togo[g.base[:-1, None] + np.arange(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(flat.reshape(len(kinds), 16).tolist(), pa.list_(pa.int64()))], names=["conv", "part", "seq", "matrix"])

    kind = found.schema["conv"].dataType.simpleString()
    return found.mapInArrow(run, f"conv {kind}, part int, seq int, matrix array<long>")


def _fold_costs(matrices: DataFrame) -> DataFrame:
    """(conv, part, seq, last, behind): a conversation's fragments from its end. One row for each fragment is in a task, 16 numbers."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
        m = np.array(table.column("matrix").to_pylist(), np.int64).reshape(-1, 4, 4)
        behind = np.zeros((len(m), 4), np.int64)
        behind[-1] = _ACCEPT
        for f in range(len(m) - 1, 0, -1):
            behind[f - 1] = np.minimum((m[f] + behind[f]).min(1), FAR)
        last = np.arange(len(m)) == len(m) - 1
        return pa.table([table.column("conv"), table.column("part"), table.column("seq"), pa.array(last), pa.array(behind.tolist(), pa.list_(pa.int64()))], names=["conv", "part", "seq", "last", "behind"])

    kind = matrices.schema["conv"].dataType.simpleString()
    return matrices.groupBy("conv").applyInArrow(run, f"conv {kind}, part int, seq int, {_BEHIND}")


def _exits(found: DataFrame) -> DataFrame:
    """(conv, part, seq, exits): the state after the fragment for each before it, on the least audit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, must, *_ = _faults(batch)
            col = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: B023, E731
            g = costs(kinds, must, np.array(col("behind"), np.int64).reshape(-1, 4), np.array(col("last"), bool))
            _, pointers, _ = rank_paths(g)
            ends = pointers[-1][g.base[:-1, None] + np.arange(4)] % 4
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(ends.tolist(), pa.list_(pa.int32()))], names=["conv", "part", "seq", "exits"])

    kind = found.schema["conv"].dataType.simpleString()
    return found.mapInArrow(run, f"conv {kind}, part int, seq int, exits array<int>")


def _fold_states(exits: DataFrame) -> DataFrame:
    """(conv, part, seq, entry): the state before each fragment, from the conversation's start."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("seq", "ascending")])
        state, entry = 0, []
        for x in table.column("exits").to_pylist():
            entry.append(state)
            state = x[state]
        return pa.table([table.column("conv"), table.column("part"), table.column("seq"), pa.array(entry, pa.int32())], names=["conv", "part", "seq", "entry"])

    kind = exits.schema["conv"].dataType.simpleString()
    return exits.groupBy("conv").applyInArrow(run, f"conv {kind}, part int, seq int, entry int")


_STATS = "n long, blank long, duplicate long, truncated long, illegal long, first int, last_kind int, low long, high long, turns long, cost long"


def _repaired(found: DataFrame, known: bool) -> DataFrame:
    """(conv, part, seq, counts and edges of the fragment, audit, repaired rows); ``known``: with columns entry, last and behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, must, double, roles, texts = _faults(batch)
            m = len(kinds)
            col = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()  # noqa: B023, E731
            behind = np.array(col("behind"), np.int64).reshape(-1, 4) if known else np.tile(_ACCEPT, (m, 1))
            g = costs(kinds, must, behind, np.array(col("last"), bool) if known else np.ones(m, bool))
            choice, pointers, far = rank_paths(g)
            start = g.base[:-1] + (np.array(col("entry"), np.int64) if known else 0)
            paths = read_paths(start, pointers, far)
            stats, audits, rows = [], [], []
            for f, path in enumerate(paths):
                arc = choice[path]
                audits.append("".join(_LETTERS[arc]))
                place, new = (path - g.base[f]) // 4, g.target[arc - 1, path] % 4
                out = []
                for a, i, q in zip(arc.tolist(), place.tolist(), new.tolist(), strict=True):
                    if a > 1:
                        out.append({"role": roles[f][i] if a == 3 else "user" if q == 2 else "assistant", "text": "" if a == 2 else texts[f][i]})
                rows.append(out)
                k = kinds[f] & 3
                good = ((k[:-1] == 0) & (k[1:] == 1)) | ((k[:-1] == 1) & (k[1:] == 2)) | ((k[:-1] == 2) & (k[1:] == 1))
                turns = sorted(t for t in batch.column(6)[f].as_py() if t is not None)
                cut = (kinds[f] & 8 > 0) & ~double[f]
                stats.append((len(k), int((kinds[f] & 4 > 0).sum()), int(double[f].sum()), int(cut.sum()), int((~good).sum()), int(k[0]) if len(k) else None, int(k[-1]) if len(k) else None, turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), int(g.togo[start[f]])))
            cols = [pa.array(x, pa.int32() if j in (5, 6) else pa.int64()) for j, x in enumerate(zip(*stats, strict=True))]
            names = [x.split()[0] for x in _STATS.split(", ")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols, pa.array(audits, pa.string()), pa.array(rows, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))], names=["conv", "part", "seq", *names, "audit", "repaired"])

    kind = found.schema["conv"].dataType.simpleString()
    return found.mapInArrow(run, f"conv {kind}, part int, seq int, {_STATS}, audit string, repaired array<struct<role:string,text:string>>")


def _merged(pieces: DataFrame) -> DataFrame:
    """The report of conversations of several fragments; their counts and audits meet, not their texts."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("part", "ascending"), ("seq", "ascending")]).to_pylist()
        out = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
        before, high = None, None
        for r in rows:
            if r["n"]:
                out["illegal"] += before is not None and (before, r["first"]) not in ((0, 1), (1, 2), (2, 1))
                before = r["last_kind"]
            if r["low"] is not None:
                out["turns"] -= r["low"] == high
                high = r["high"]
        low = next((r["low"] for r in rows if r["low"] is not None), None)
        gaps = 0 if low is None else high - low + 1 - out.pop("turns")
        out |= {"conv": rows[0]["conv"], "gaps": gaps, "cost": rows[0]["cost"], "audit": "".join(r["audit"] for r in rows)}
        names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        return pa.table([pa.array([out[k]], table.schema.field("conv").type if k == "conv" else pa.string() if k == "audit" else pa.int64()) for k in names], names=names)

    kind = pieces.schema["conv"].dataType.simpleString()
    return pieces.drop("repaired").groupBy("conv").applyInArrow(run, f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


@dataclass
class Repair:
    """Two tables of repaired pieces (conv, part, seq, counts, audit, repaired rows in order): of conversations that are one piece, and of longer ones."""

    whole: DataFrame
    split: DataFrame | None

    def rows(self) -> DataFrame:
        """(conv, part, seq, place, role, text): the repaired rows, in this order."""
        both = self.whole if self.split is None else self.whole.unionByName(self.split)
        return both.select("conv", "part", "seq", F.posexplode("repaired").alias("place", "row")).select("conv", "part", "seq", "place", "row.role", "row.text")

    def report(self) -> DataFrame:
        """One row for each conversation: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
        counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        line = F.concat_ws("\n", F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])))
        done = self.whole.select("conv", gaps, *counts, F.sha2(line.cast("binary"), 256).alias("repaired_sha256"))
        if self.split is None:
            return done
        digests = stream_digests(self.split)
        longer = _merged(self.split).alias("m").join(digests.alias("d"), F.col("m.conv").eqNullSafe(F.col("d.conv"))).select("m.*", "d.repaired_sha256")
        return done.unionByName(longer)


def stream_digests(pieces: DataFrame) -> DataFrame:
    """(conv, repaired_sha256). The hash needs a conversation's text in order, so it goes through one task, piece by piece, and isn't held there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun, open_ = None, None, False, False
        done: list[tuple] = []
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for k in range(batch.num_rows):
                conv = batch.column(0)[k].as_py()
                if not open_ or conv != now:
                    if open_:
                        done.append((now, state.hexdigest()))
                    now, state, begun, open_ = conv, hashlib.sha256(), False, True
                for r in batch.column(1)[k].as_py():
                    state.update((("\n" if begun else "") + f"{r['role']}:{r['text']}").encode())
                    begun = True
        if open_:
            done.append((now, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([h for _, h in done])], names=["conv", "repaired_sha256"])

    kind = pieces.schema["conv"].dataType.simpleString()
    ordered = pieces.repartition("conv").sortWithinPartitions("conv", "part", "seq").select("conv", "repaired")
    return ordered.mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def repair(rows: DataFrame, most_rows: int = FRAGMENT_ROWS, most_bytes: int = FRAGMENT_BYTES) -> Repair:
    """Repair rows (conv, turn, role, text, present); rows not present only make sure that their conversation is reported."""
    found = materialize(fragments(rows, most_rows, most_bytes))
    several = materialize(found.groupBy("conv").count().where("count > 1").select(F.col("conv").alias("_conv")))
    if several.isEmpty():
        return Repair(materialize(_repaired(found, False)), None)
    same = F.col("conv").eqNullSafe(F.col("_conv"))
    one = _repaired(found.join(several, same, "left_anti"), False)
    many = materialize(found.join(several, same, "left_semi"))
    # which rows of these have a role and text that stands nowhere before, in all fragments of the conversation
    each = many.select("conv", "part", "seq", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "both"))
    first = each.groupBy("conv", "both").agg(F.min(F.struct("part", "seq", "place")).alias("at"))
    firsts = first.groupBy(F.col("conv").alias("_c"), F.col("at.part").alias("_p"), F.col("at.seq").alias("_s")).agg(F.collect_list("at.place").alias("firsts"))
    key = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p")) & (F.col("seq") == F.col("_s"))
    many = materialize(many.join(firsts, key, "left").drop("_c", "_p", "_s").withColumn("firsts", F.coalesce("firsts", F.array().cast("array<int>"))))

    def with_(left: DataFrame, more: DataFrame) -> DataFrame:
        more = more.withColumnsRenamed({"conv": "_c", "part": "_p", "seq": "_s"})
        return left.join(more, key).drop("_c", "_p", "_s")

    many = materialize(with_(many, _fold_costs(_matrices(many))))
    many = with_(many, _fold_states(_exits(many)))
    return Repair(materialize(one), materialize(_repaired(many, True)))


def repair_damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The report on ``rows`` after ``damage``, under the name of the conversation's column."""
    return repair(damage(rows, conv, turn, role, text)).report().withColumnRenamed("conv", conv)


def _sql() -> str:
    """The report on damaged rows in SQL: costs and audits of all four states row by row from the end, as a recursion over places."""
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = "list_reduce(list_concat([xor(acc, b)], range(8)), lambda c, j: " + bit + ")"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(length(name)), lambda p: ascii(substr(name, p + 1, 1))::BIGINT)), lambda acc, b: {step}), 4294967295)"
    state = lambda c, a, t: f"{{'c': {c}, 'a': {a}, 't': {t}}}"
    then = lambda s, cost, letter, line: state(f"{s}.c + {cost}", f"'{letter}' || {s}.a", f"{s}.t" if line is None else f"list_concat([{line}], {s}.t)")
    best = lambda *ways: f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"

    def row(q: int) -> str:
        keep = {0: "CASE first WHEN 's' THEN 1 WHEN 'u' THEN 2 END", 1: "CASE first WHEN 'u' THEN 2 END", 2: "CASE first WHEN 'a' THEN 3 END", 3: "CASE first WHEN 'u' THEN 2 END"}[q]
        on, role = (3, "assistant") if q == 2 else (2, "user")
        kept = " ".join(f"WHEN {to} THEN {then(f's{to}', 'extra', 'K', line)}" for to in (1, 2, 3) for line in ["role || ':' || text"])
        return best(then(f"s{q}", DELETE, "D", None), f"CASE WHEN NOT must THEN CASE {keep} {kept} END END", f"CASE WHEN NOT must THEN {then(f's{on}', f'{REROLE} + extra', 'R', f"'{role}:' || text")} END")

    insert = lambda s, role: then(s, INSERT, "I", f"'{role}:'")
    none = "[]::VARCHAR[]"
    solid = "right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1)"
    return f"""WITH RECURSIVE named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
kinds AS (SELECT *, {crc} % 20 AS k FROM named),
damaged AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i, substr(role, 1, 1) AS first, {solid} AS last FROM damaged),
faults AS (SELECT *, lag(first) OVER (PARTITION BY conv_id ORDER BY i) || first AS pair, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
ready AS (SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra FROM faults),
counts AS (SELECT o.conv_id, count(r.i) AS n, coalesce(max(r.turn) - min(r.turn) + 1 - count(DISTINCT r.turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ready r ON r.conv_id IS NOT DISTINCT FROM o.conv_id GROUP BY o.conv_id),
costs AS (SELECT conv_id, n AS i, {state("0::BIGINT", "''", none)} AS s0, {state(f"{2 * INSERT}::BIGINT", "'II'", "['user:', 'assistant:']")} AS s1, {state(f"{INSERT}::BIGINT", "'I'", "['assistant:']")} AS s2, {state("0::BIGINT", "''", none)} AS s3 FROM counts
UNION ALL SELECT conv_id, i, {best("v0", insert("w2", "user"))}, {best("v1", insert("w2", "user"))}, w2, {best("v3", insert("w2", "user"))}
FROM (SELECT *, {best("v2", insert("v3", "assistant"))} AS w2 FROM (SELECT c.conv_id, r.i, {", ".join(f"{row(q)} AS v{q}" for q in range(4))} FROM costs c JOIN ready r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.i - 1)))
SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, s0.c AS cost, s0.a AS audit, sha256(array_to_string(s0.t, chr(10))) AS repaired_sha256 FROM counts n JOIN costs c ON n.conv_id IS NOT DISTINCT FROM c.conv_id AND c.i = 0"""


REPAIR_SQL = _sql()
