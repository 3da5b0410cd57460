"""Repair against a search that tries all edits of a conversation, and its odd cases."""

import hashlib
import os
import random
import re
import zlib
from functools import lru_cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, note string"


def damaged(rows):
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            yield from [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)


def plain(rows):
    """The report on one conversation's rows after damage."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    fault, seen = [], set()
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))

    def after(initials):  # the initials so far, as much of them as matters
        return None if not re.fullmatch(r"s?(ua)*u?", initials) else "" if not initials else "s" if initials == "s" else "u" if initials[-1] == "u" else "a"

    @lru_cache(None)
    def best(i, state, inserted=0):
        """(cost, audit, repaired rows) from row i on."""
        long = {"": "", "s": "s", "u": "u", "a": "ua"}[state]
        out = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def put(cost, letter, initial, lines, then):
            state2 = after(long + initial) if initial is not None else state
            if state2 is not None:
                rest = best(then, state2, inserted + 1 if letter == "I" else 0)
                if rest:
                    out.append((cost + rest[0], letter + rest[1], lines + rest[2]))

        if inserted < 3:
            for role in ("user", "assistant"):
                put(3, "I", role[0], (f"{role}:",), i)
        if i < len(rows):
            _, _, role, text = rows[i]
            put(4, "D", None, (), i + 1)
            if fault[i] not in ("blank", "duplicate"):
                more = 3 if fault[i] == "truncated" else 0
                if role[:1] in ("s", "u", "a"):
                    put(more, "K", role[0], (f"{role}:{text}",), i + 1)
                for new in ("user", "assistant"):
                    put(3 + more, "R", new[0], (f"{new}:{text}",), i + 1)
        return min(out, default=None)

    cost, audit, lines = best(0, "")
    count = [fault.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    convs = {r[0]: [] for r in rows}
    for r in damaged(rows):
        convs[r[0]].append(r)
    return {c: plain(x) for c, x in convs.items()}


def report(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def made(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uncle"]
    texts = ["Yes.", "No!", "and so", "  ", "", None, "Why?\n", "...", "é.", "Long text. More", "fin. \x0b"]
    return [(c if c else None, rng.choice([None, k, k, k, k // 2]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"own {k}.") for c in range(convs) for k in range(rng.randint(0, most))]


@pytest.mark.parametrize("most_rows", [4096, 3, 1])
def test_against_all_edits(spark, most_rows):
    rows = made(most_rows, 40, 9)
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    got = R.repair(R.damage(df), most_rows=most_rows).report().withColumnRenamed("conv", "conv_id")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert report(got) == expected(rows)


def test_one_long_conversation_in_many_fragments(spark):
    rows = made(7, 2, 150)[:150] + [(9, k // 3, ["user", "assistant"][k % 2], f"{k % 40}.") for k in range(120)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    done = R.repair(R.damage(df), most_rows=8, most_bytes=60)
    assert done.split is not None
    assert report(done.report().withColumnRenamed("conv", "conv_id")) == expected(rows)
    lines = done.rows().where("conv = 9").orderBy("part", "seq", "place").collect()
    text = "\n".join(f"{r['role']}:{r['text']}" for r in lines)
    assert hashlib.sha256(text.encode()).hexdigest() == expected(rows)[9][-1]


def test_sql_against_all_edits():
    rows = made(11, 60, 8) + made(12, 3, 40)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert {r[0]: r[1:] for r in con.execute(R.REPAIR_SQL).fetchall()} == expected(rows)


def test_doubled_pointers_order_nodes_like_their_audits():
    rng = np.random.default_rng(3)
    kinds = [rng.choice([0, 1, 2, 3, 9, 10, 5], n).astype(np.uint8) for n in (0, 1, 5, 12)]
    g = R.costs(kinds, [k & 4 > 0 for k in kinds], np.tile(R._ACCEPT, (4, 1)), np.ones(4, bool))
    choice, pointers, far = R.rank_paths(g)

    def audit(v):
        return "" if choice[v] == 0 else R._LETTERS[choice[v]] + audit(g.target[choice[v] - 1, v])

    nodes = np.flatnonzero(g.togo < R.FAR)
    for v, path in zip(nodes, R.read_paths(nodes, pointers, far), strict=True):
        assert "".join(R._LETTERS[choice[path]]) == audit(v) and len(audit(v)) == far[v]


def test_empty_all_dropped_and_clashing_names(spark):
    assert R.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.", "x")], SCHEMA).withColumns({"conv": F.lit(1), "present": F.lit(False), "kind": F.lit("k")})
    assert [tuple(r) for r in R.repair_damaged(df).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_equal_rows_and_long_texts(spark):
    rows = [(1, 0, "user", "Same.")] * 300 + [(1, 1, "assistant", "word " * 60_000 + "."), (1, 2, "user", None), (2, None, None, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = report(R.repair(R.damage(df), most_rows=50).report().withColumnRenamed("conv", "conv_id"))
    want = expected(rows[299:])
    assert got[2] == want[2] and got[1][-1] == want[1][-1] and got[1][2] >= 299


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables are not there")
def test_given_table(spark):
    from rollcall.llm.queries import op11_repair

    path = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{path}/conversations.parquet'").fetchall()
    assert report(op11_repair(spark, path)) == expected(rows)
