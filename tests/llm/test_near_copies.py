import re

import numpy as np
import pytest

from rollcall.llm import near_copies as N


def brute_set(text: str | None) -> frozenset:
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    return frozenset(b" ".join(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([b" ".join(words)] if words else [])


def brute_groups(texts: list) -> list[int]:
    sets = [brute_set(t) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return label


def texts() -> list:
    """Copies of several texts with so many changed words that similarities lie on both sides of 0.8."""
    rng = np.random.default_rng(6)
    word = lambda: "".join(rng.choice(list("abcdEFé"), rng.integers(2, 9)))
    out = [None, "", "one", "One", "one two\tthree", " \n"]
    for n in (12, 60, 150, 400):
        base = [word() for _ in range(n)]
        for _ in range(30):
            words = list(base)
            for _ in range(int(rng.integers(0, max(2, n // 22)))):
                words[int(rng.integers(n))] = word()
            out.append(" ".join(words))
    chain = [word() for _ in range(200)]
    for k in range(40):  # each is a copy of the next one only, all in few buckets
        out.append(" ".join(chain[k * 3 : k * 3 + 80]))
    return out


@pytest.mark.parametrize("reach", [16, 2])
def test_groups_equal_brute_force(spark, monkeypatch, reach):
    monkeypatch.setattr(N, "REACH", reach)
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["group"] for r in N.near_copy_groups(docs).collect()}
    want = brute_groups(rows)
    least = {}
    for k in range(len(rows)):
        least.setdefault(got[k], k)
    assert [least[got[k]] for k in range(len(rows))] == want
    assert 1 < len(set(want)) < len(rows)


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (7, "other words than those"), (None, "")], "doc_id long, text string")
    got = N.near_copy_groups(docs)
    assert got.count() == 5 and got.select("group").distinct().count() == 3
    assert N.near_copy_groups(docs.limit(0)).count() == 0


def test_stage_drops_copies_at_the_threshold(spark):
    """Changed words spread over a text: 5-word similarity above 0.8, SimHash more than 4 bits apart."""
    stage = pytest.importorskip("corpus_pipeline").near_copy_stage
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(2, 9)))
    rows = []
    for k in range(20):
        words = [word() for _ in range(150)]
        rows.append((k, " ".join(words)))
        for at in (40, 80, 120):
            words[at] = word()
        rows.append((100 + k, " ".join(words)))
    rows += [(3, "another text under an id that is there already")]
    kept = stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted([*range(20), 3])
