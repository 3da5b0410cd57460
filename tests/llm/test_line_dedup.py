import numpy as np

from rollcall.llm.line_dedup import aligned_blocks, dedupe_lines, patience


def test_patience_alignment():
    a, b = list("abcdefg"), list("xbcyefgz")
    assert patience(a, b) == [(1, 1), (2, 2), (4, 4), (5, 5), (6, 6)]
    assert patience([], b) == [] and patience(list("aa"), list("aa")) == [(0, 0), (1, 1)]
    rng = np.random.default_rng(1)
    for _ in range(200):
        x, y = rng.integers(0, 6, 12).tolist(), rng.integers(0, 6, 12).tolist()
        got = patience(x, y)
        assert all(x[i] == y[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))


def brute(docs: dict[int, str], least: int) -> dict[int, str]:
    """Every later document against the first owner of each of its lines."""
    code = lambda x: hash(x) & ~1 | (len(x.strip(" ")) >= least)
    lines = {k: t.split("\n") for k, t in docs.items()}
    owner = {}
    for k in sorted(docs):
        for x in lines[k]:
            owner.setdefault(x, k)
    out = {}
    for k in docs:
        gone = set()
        for o in {owner[x] for x in lines[k] if len(x.strip(" ")) >= least} - {k}:
            gone |= set(aligned_blocks([code(x) for x in lines[o]], [code(x) for x in lines[k]]))
        out[k] = "\n".join(x for i, x in enumerate(lines[k]) if i not in gone)
    return out


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    pool = [f"line number {k} that many share, more or less" for k in range(30)] + ["short", "", "tiny"]
    docs = {k: "\n".join(rng.choice(pool, int(rng.integers(1, 12)))) + f"\nown line of document number {k}" for k in range(60)}
    docs[70] = docs[3]
    table = spark.createDataFrame([(k, t, 1, "p") for k, t in docs.items()], "doc_id long, text string, k int, places string")
    got = dedupe_lines(table).collect()
    assert {r["doc_id"]: r["text"] for r in got} == brute(docs, 24)
    assert next(r for r in got if r["doc_id"] == 70)["text"] == ""
    assert all(r["places"] == "p" for r in got)
    # the first document with a line keeps it
    first = {}
    for k in sorted(docs):
        for x in docs[k].split("\n"):
            if len(x) >= 24:
                first.setdefault(x, k)
    kept = {r["doc_id"]: r["text"].split("\n") for r in got}
    assert all(x in kept[k] for x, k in first.items())


def test_defined_results(spark):
    line = "a line that is long enough to find a pair"
    rows = [(1, line), (1, line), (None, line), (2, None), (3, ""), (4, "short"), (5, "short"), (6, "new\n" + line + "\nshort")]
    got = dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["text"], r["n_lines"], r["n_removed"]) for r in got if r["doc_id"] not in (2,)) == [
        ("1", line, 1, 0), ("1", line, 1, 0), ("3", "", 1, 0), ("4", "short", 1, 0), ("5", "short", 1, 0), ("6", "new\nshort", 3, 1), ("None", line, 1, 0),
    ]
    assert [(r["text"], r["n_lines"]) for r in got if r["doc_id"] == 2] == [(None, 0)]
    assert dedupe_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
