"""The suffix merge against sorted suffixes, and removal against brute force."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from rollcall.llm.suffix_dedup import Transform, remove_repeats, sorted_strings


def brute(texts: list[str | None], length: int) -> list[tuple]:
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_merged_transform_is_the_sorted_one():
    rng = np.random.default_rng(3)
    for _ in range(40):
        strings = [rng.integers(1, 4, rng.integers(0, 15)) for _ in range(rng.integers(1, 12))]
        flat = np.concatenate([np.append(s, 0) for s in strings])
        first = np.cumsum([0] + [len(s) + 1 for s in strings])
        step = int(rng.integers(1, 5))
        parts = []
        for lo in range(0, len(strings), step):
            hi = min(len(strings), lo + step)
            parts.append(Transform.build(flat[first[lo] : first[hi]], first[lo:hi] - first[lo], first[lo]))
        parts.append(Transform(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), 0))
        while len(parts) > 1:
            parts = [parts[k].merge(parts[k + 1]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        owner = np.searchsorted(first, np.arange(len(flat)), "right") - 1

        def suffix(i, owner=owner, first=first, flat=flat):
            return [(int(x), 0) if x else (0, int(owner[i])) for x in flat[i : first[owner[i] + 1]]]

        want = sorted(range(len(flat)), key=suffix)
        assert list(parts[0].place) == want
        for r in range(1, len(want)):
            a, b = suffix(want[r - 1]), suffix(want[r])
            shared = next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert parts[0].lcp[r] == shared


def corpus() -> list[str | None]:
    rng = np.random.default_rng(5)

    def words(n):
        return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 8))) for _ in range(n))

    base = words(120)
    passage = words(25)
    out: list[str | None] = [base, base, base[:300] + "#" + base[301:], None, "", "short", "ab" * 200, "x" * 90, words(80)]
    out += [words(int(rng.integers(0, 30))) + " " + passage + " " + words(int(rng.integers(0, 30))) for _ in range(25)]
    out += [passage[:70], base[50:200], words(10) + passage[5:] + words(3), "the end " * 30]
    for _ in range(8):
        chars = list(base)
        chars[int(rng.integers(len(chars)))] = "Z"
        out.append("".join(chars))
    return out


@pytest.mark.parametrize(("hot", "bucket"), [(512, 2048), (3, 8)])
def test_removal_equals_brute_force(spark, hot, bucket):
    texts = corpus()
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, g string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in remove_repeats(docs, length=100, gram=16, hot=hot, bucket=bucket).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, 100)


def test_repeated_rows_and_null_ids(spark):
    texts = ["word " * 30, "other text that is long enough to matter, " * 2, "word " * 30]
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (None, texts[1]), (2, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in remove_repeats(docs, length=50, gram=16).collect())
    assert got == [("1", 150, 150), ("1", 150, 150), ("2", 4, 0), ("None", 84, 84), ("None", 84, 84)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeats(docs).count() == 0


def test_sorted_strings_equal_python_order():
    rng = np.random.default_rng(4)
    strings = [b"", b"a", b"a\0", b"a" * 70, b"a" * 70, b"a" * 64, b"a" * 64 + b"\0"]
    strings += [bytes(rng.integers(0, 3, int(rng.integers(0, 90)), dtype=np.uint8)) for _ in range(60)]
    strings += [s[:k] + b"x" for s in strings for k in (31, 32, 33, 60) if len(s) > k]
    off = np.cumsum([0] + [len(s) for s in strings])
    order, shared = sorted_strings(np.frombuffer(b"".join(strings), np.uint8), off, shard=16)
    assert [strings[k] for k in order] == sorted(strings)
    for r in range(1, len(order)):
        assert shared[r - 1] == len(os.path.commonprefix([strings[order[r - 1]], strings[order[r]]]))


def test_text_over_20_mb(spark):
    rng = np.random.default_rng(6)
    raw = rng.choice(np.frombuffer(b"abcdefghijklmnop ", np.uint8), 21_000_000)
    passage = rng.choice(np.frombuffer(b"qrstuvwxyz ", np.uint8), 700)
    for at in (5_000, (1 << 19) - 300, 20_000_000):  # the second lies across the border of two stretches
        raw[at : at + 700] = passage
    text = raw.tobytes().decode()
    rows = [(1, text), (2, "1" + passage.tobytes().decode() + "2"), (3, "3" + passage.tobytes().decode()[:399] + "4"), (4, "short")]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).drop("kept").collect()}
    assert got == {1: (21_000_000, 2_100, 3), 2: (702, 700, 1), 3: (401, 0, 0), 4: (5, 0, 0)}
