import zlib

import numpy as np

from rollcall.llm import quality as Q


def tables(spark):
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for k in range(300):
        good = k % 3 > 0
        words = rng.choice(["the", "tion", "of", "and", "erth", "hend"], int(rng.integers(5, 60)))
        docs.append((k, " ".join(words) if good else " ".join(f"{w}###" for w in words), 1.0))
        if k % 2:
            labels.append((k, int(good), 0))
    return spark.createDataFrame(docs, "doc_id long, text string, log_weight double"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def plain(docs, labels):
    def feats(text):
        import re

        runs = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\x20\x09-\x0D]+", text or "")
        return runs, list(zip(runs, runs[1:], strict=False))

    return {r[0]: feats(r[1]) for r in docs}


def test_held_out_ranking_and_selection(spark):
    docs, labels = tables(spark)
    rows = Q.resample(docs, labels).collect()
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    out = [r for r in rows if r["doc_id"] in quality and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    good = [r["log_weight"] for r in out if quality[r["doc_id"]]]
    poor = [r["log_weight"] for r in out if not quality[r["doc_id"]]]
    assert np.mean([g > p for g in good for p in poor]) > 0.97
    share = np.mean(list(quality.values())) + Q.SLACK
    assert sum(r["kept"] for r in rows) == round(300 * share)
    edge = min(r["gumbel_sum"] for r in rows if r["kept"])
    assert all(r["kept"] == (r["gumbel_sum"] >= edge) for r in rows)
    few = Q.resample(docs.repartition(7), labels, k=17).where("kept").collect()
    best = sorted(rows, key=lambda r: -r["gumbel_sum"])[:17]
    assert {r["doc_id"] for r in few} == {r["doc_id"] for r in best}


def test_features_count_runs_and_pairs():
    texts = ["a b,, b b", "", "né x!"]
    raw = [t.encode() for t in texts]
    bucket, owner = Q.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(b) for b in raw]))
    want = plain(list(enumerate(texts)), None)
    assert np.bincount(owner, minlength=3).tolist() == [len(want[k][0]) + len(want[k][1]) for k in range(3)]
    assert (bucket == Q.BUCKETS).sum() == 1  # "b b" is a repeat


def test_defined_results(spark):
    docs, labels = tables(spark)
    odd = spark.createDataFrame([(None, "the of"), (1, None), (2, ""), (3, "x " * 100_000), (3, "x " * 100_000)], "doc_id long, text string")
    rows = Q.resample(odd, labels.limit(0)).collect()
    assert len(rows) == 5 and all(r["log_weight"] == 0.0 for r in rows)
    assert sorted(r["n_features"] for r in rows) == [0, 0, 3, 199_999, 199_999]
    assert Q.resample(docs.limit(0), labels).count() == 0


def test_log_weights_equal_a_plain_model(spark):
    import math
    from collections import Counter

    docs, labels = tables(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    named: dict = {}

    def bucket(*runs):
        """Of one run or of a pair, found from a text that holds nothing else."""
        if runs not in named:
            raw = " ".join(runs).encode()
            named[runs] = int(Q.features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0][-1])
        return named[runs]

    feats = {}
    for k, (runs, pairs) in plain(list(texts.items()), None).items():
        feats[k] = [bucket(x) for x in runs] + [bucket(*p) for p in pairs]
    raw, target = Counter(), Counter()
    for k, f in feats.items():
        raw.update(f)
        target.update(f if k in good else [])
    n_raw, n_target = sum(raw.values()) + Q.BUCKETS + 1, sum(target.values()) + Q.BUCKETS + 1
    for r in Q.resample(docs, labels).collect():
        want = sum(math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in feats[r["doc_id"]])
        assert abs(r["log_weight"] - want) < 1e-9 * max(1, abs(want)) and r["n_features"] == len(feats[r["doc_id"]])
