import hashlib
import re

import numpy as np
import pytest

from rollcall.llm.decontaminate import contamination


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = {}
    for k, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, body in items:
            v = words(body)
            if not v:
                continue
            for s in range(max(1, len(v) - 9)):
                win = v[s : s + 10]
                for p in range(len(w) - len(win) + 1):
                    if w[p : p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        found |= set() if item is None else {str(item)}
        out[k] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block", [100_000, 7])
def test_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    some = lambda n: [str(rng.choice(["the", "of", "Ab", "ab", "x1", "né", "zz", "q"])) for _ in range(n)]
    items = [(k, " ".join(some(int(rng.integers(1, 16))))) for k in range(12)] + [(100, "Alpha, beta-gamma delta."), (9, ""), (11, None), (None, "the of"), (100, "solo"), (2, "one two three four five six seven eight nine ten eleven twelve")]
    docs = [(k, " ".join(some(int(rng.integers(0, 60))))) for k in range(25)]
    docs += [(50, "ALPHA beta; gamma/delta"), (51, None), (52, ""), (53, "x one two three four five six seven eight nine TEN! eleven twelve y"), (54, "two three four five six seven eight nine ten eleven"), (55, "one two three four five six seven eight nine")]
    got = contamination(spark.createDataFrame([(k, t, 0, "x") for k, t in docs], "doc_id long, text string, n_hit int, items string"), spark.createDataFrame(items, "item_id long, text string"), block=block)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got.collect()} == brute(docs, items)


def test_spans_and_names(spark):
    docs = spark.createDataFrame([(1, "a b c x a b c")], "doc_id long, text string")
    row = contamination(docs, spark.createDataFrame([(5, "a b c"), (10, "b")], "item_id long, text string")).first()
    assert row["hit_spans"] == [0, 3, 4, 7] and row["items"] == ["10", "5"]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    row = contamination(docs, items).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)
    assert contamination(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
