import re

import numpy as np
import pytest
import xxhash

from rollcall.llm import simhash as S


def brute_print(text: str | None) -> int:
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    shingles = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], ids: list[int]) -> list[int]:
    label = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for a, x in zip(ids, prints, strict=True):
            for b, y in zip(ids, prints, strict=True):
                if (x ^ y).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return [label[i] for i in ids]


def texts() -> list[str | None]:
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdEFé"), rng.integers(1, 12)))
    base = " ".join(word() for _ in range(150))
    out: list[str | None] = [base, base, base + " tail", base.replace("a", "A"), None, "", "one", "one two\tthree", " a  b\n c\x0bd e ", "long " + "x" * 100 + " y z"]
    for _ in range(20):
        words = base.split(" ")
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(len(words)))] = word()
        out.append(" ".join(words))
    out += [" ".join(word() for _ in range(int(rng.integers(1, 40)))) for _ in range(20)]
    return out


@pytest.mark.parametrize("limit", [4096, 3])
def test_components_equal_brute_force(spark, limit):
    rows = texts()
    docs = spark.createDataFrame([(100 - k, t, "s", 1) for k, t in enumerate(rows)], "doc_id long, text string, fp string, c int")
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in S.simhash_components(docs, node_limit=limit).collect()}
    prints = [brute_print(t) for t in rows]
    ids = [100 - k for k in range(len(rows))]
    assert [got[i][0] for i in ids] == prints
    assert [got[i][1] for i in ids] == brute_components(prints, ids)


def test_hashes_equal_the_library():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    starts = rng.integers(0, 4800, 400)
    ends = starts + rng.integers(0, 200, 400)
    want = [xxhash.xxh64_intdigest(data[a:z].tobytes(), seed=42) for a, z in zip(starts, ends, strict=True)]
    assert S.xxh64(data, starts, ends).tolist() == want


def test_tree_finds_all_close_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fp = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) for _ in range(12))]))
    group = np.sort(rng.integers(0, 4, len(fp)))
    found = {(int(a), int(b)) for x, y in S.close_pairs(fp, group) for a, b in zip(x, y, strict=True)}
    want = {(a, b) for a in range(len(fp)) for b in range(a + 1, len(fp)) if group[a] == group[b] and (int(fp[a]) ^ int(fp[b])).bit_count() <= 4}
    assert found == want


def test_masks_leave_no_pair_out():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(x & m == 0 for m in S.root_masks())
        root = next(m for m in S.root_masks() if x & m == 0)
        assert any(x & m == 0 for m in S.finer_masks(root))


def test_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in S.simhash_components(docs).collect() if r["fingerprint"] != "0" * 16)
    assert got == [("7", 7), ("7", 7), ("None", 7)]
    assert S.simhash_components(docs.limit(0)).count() == 0


def test_long_texts_in_stretches_hash_alike():
    import numpy as np

    from rollcall.llm import simhash as S
    from rollcall.llm.common import cuts
    from rollcall.llm.decontaminate import word_hashes
    from rollcall.llm.quality import features

    rng = np.random.default_rng(2)
    raw = " ".join("".join(rng.choice(list("abcé.,XY"), int(rng.integers(1, 9)))) for _ in range(30_000)).encode() + b"   " + b"z" * 3000 + b" end"
    data = np.frombuffer(raw, np.uint8)
    one, two = np.array([0, len(data)]), np.array([0, len(data), len(data)])  # two texts are never cut
    for most in (50, 700, 4096):
        parts = [S.shingle_hashes(p, np.array([0, len(p)]), 4)[0] for p in S.overlapping(data, 4, most)]
        assert np.array_equal(np.concatenate(parts), S.shingle_hashes(data, one, 4)[0])
        ends = cuts(data, S.SOLID, most)
        assert ends[0] == 0 and ends[-1] == len(data) and len(ends) > 3 and all(data[c] == 32 for c in ends[1:-1])
    long = np.tile(data, 20)
    one, two = np.array([0, len(long)]), np.array([0, len(long), len(long)])
    assert np.array_equal(S.fingerprints_of(long, one), S.fingerprints_of(long, two)[:1])
    assert np.array_equal(word_hashes(long, one)[0], word_hashes(long, two)[0])
    assert np.array_equal(np.sort(features(long, one)[0]), np.sort(features(long, two)[0]))
