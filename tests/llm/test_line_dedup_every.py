import numpy as np
import pytest

from rollcall.llm import line_dedup
from rollcall.llm.line_dedup import dedupe_lines


def plain_patience(a, b, a0=0, b0=0):
    """Patience diff as it is told: equal heads and tails, then the longest rising chain of lines that stand once on both sides, and between those."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[len(a) - 1 - tail] == b[len(b) - 1 - tail]:
        tail += 1
    out = [(a0 + k, b0 + k) for k in range(head)] + [(a0 + len(a) - 1 - k, b0 + len(b) - 1 - k) for k in range(tail)]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    once = [(x.index(v), j) for j, v in enumerate(y) if x.count(v) == 1 and y.count(v) == 1]
    best = []  # (length, chain): of equally long chains the one that ends first in a, built on the same choice
    for k, (i, j) in enumerate(once):
        before = [c for c in best if c[-1][0] < i]
        longest = max(map(len, before), default=0)
        base = min((c for c in before if len(c) == longest), key=lambda c: c[-1][0], default=[])
        best.append([*base, (i, j)])
    if not best:
        return sorted(out)
    chain = min((c for c in best if len(c) == max(map(len, best))), key=lambda c: c[-1][0])
    for (i, j), (p, q) in zip([(-1, -1), *chain], [*chain, (len(x), len(y))], strict=True):
        out += plain_patience(x[i + 1 : p], y[j + 1 : q], a0 + head + i + 1, b0 + head + j + 1)
    return sorted(out + [(a0 + head + i, b0 + head + j) for i, j in chain])


def brute(docs: dict, least: int = 24) -> dict:
    """Every later document against every earlier one."""
    lines = {k: t.split("\n") for k, t in docs.items()}
    out = {}
    for k in docs:
        gone = set()
        for o in (o for o in docs if o < k):
            block, last = [], None
            for i, j in [*plain_patience(lines[o], lines[k]), (-9, -9)]:
                if last != (i - 1, j - 1):
                    gone |= set(block) if sum(len(lines[k][x].strip(" ")) for x in block) >= least else set()
                    block = []
                block.append(j)
                last = (i, j)
        out[k] = "\n".join(x for i, x in enumerate(lines[k]) if i not in gone)
    return out


@pytest.mark.parametrize("reach", [16, 2])
def test_equals_all_holder_pairs(spark, monkeypatch, reach):
    monkeypatch.setattr(line_dedup, "NEXT", reach)
    monkeypatch.setattr(line_dedup, "PAIRS", reach)
    rng = np.random.default_rng(3)
    pool = [f"line number {k} that many share, more or less" for k in range(12)] + ["short", "", "tiny", " 短い行です ", "ten chars.", "eleven char"]
    docs = {k: "\n".join(rng.choice(pool, int(rng.integers(1, 12)))) + (f"\nown line of document number {k}" if k % 3 else "") for k in range(90)}
    got = dedupe_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), every=True).collect()
    assert {r["doc_id"]: r["text"] for r in got} == brute(docs)


def test_owner_that_holds_a_line_twice(spark):
    line = "a line that is long enough to find a pair"
    rows = [(1, f"a\n{line}\nb\n{line}\nc")] + [(k, f"own {k}\n{line}\nend {k}") for k in range(2, 6)]
    got = {r["doc_id"]: r["n_removed"] for r in dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"), every=True).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1, 5: 1}


def test_passage_of_short_lines(spark):
    verse = "roses are red\nviolets blue\n花は紅、柳は緑"
    rows = [(k, f"own {k}\n{verse}\nend {k}") for k in range(4)] + [(9, "own\nroses are red\nend")]
    got = {r["doc_id"]: r["text"] for r in dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"), every=True).collect()}
    assert got == {0: rows[0][1], **{k: f"own {k}\nend {k}" for k in range(1, 4)}, 9: rows[4][1]}


def test_query_and_defined_results(spark):
    line = "a line that is long enough to find a pair"
    rows = [(1, line), (1, line), (None, line), (2, None), (3, ""), (6, "new\n" + line + "\nshort")]
    got = dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"), every=True).collect()
    assert sorted((str(r["doc_id"]), str(r["text"]), r["n_removed"]) for r in got) == [("1", line, 0), ("1", line, 0), ("2", "None", 0), ("3", "", 0), ("6", "new\nshort", 1), ("None", line, 0)]
    assert dedupe_lines(spark.createDataFrame([], "doc_id long, text string"), every=True).count() == 0


def test_later_holders_meet_without_the_first(spark):
    line, block = "a line that is long enough to find a pair", ["s1", "s2", "a line that is long enough to find a pair", "s3", "s4"]
    rows = [(1, line), (2, "\n".join(block)), (3, "own\n" + "\n".join(block))]
    got = {r["doc_id"]: r["text"] for r in dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string"), every=True).collect()}
    assert got == {1: line, 2: "s1\ns2\ns3\ns4", 3: "own"}


def test_names_that_clash_and_a_long_text(spark):
    line = "a line that is long enough to find a pair"
    long = "\n".join(f"line {k} of a text with very many lines" for k in range(60_000))
    rows = [(1, line, 1, 2, 3, 4), (2, line + "\nown", 1, 2, 3, 4), (3, long, 1, 2, 3, 4), (4, long + "\nlast", 1, 2, 3, 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, k long, h long, places long, n_lines long")
    got = {r["doc_id"]: r for r in dedupe_lines(table, every=True).collect()}
    assert [got[k]["n_removed"] for k in (1, 2, 3, 4)] == [0, 1, 0, 60_000] and got[4]["text"] == "last" and got[4]["n_lines"] == 60_001
    assert all((r["k"], r["h"], r["places"]) == (1, 2, 3) for r in got.values())


def test_rules_of_dashes_in_every_document(spark):
    dash = "-" * 30
    docs = {k: f"own line number {k} with enough text\n{dash}\nanother own line {k} with enough text\n{dash}\nthe last line of {k}" for k in range(30)}
    docs |= {40: f"{dash}\nown beginning of document 40, long enough\n{dash}\nthe last line of 3", 41: f"x\n{dash}\nshared by 41 and 42, and long enough\n{dash}\ny", 42: f"z\n{dash}\nshared by 41 and 42, and long enough\n{dash}\nw"}
    got = dedupe_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), every=True).collect()
    want = brute(docs)
    assert {r["doc_id"]: r["text"] for r in got} == want and want[42] != docs[42] and want[5] == docs[5]
