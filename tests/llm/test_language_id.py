import zlib

import numpy as np
from pyspark.sql import functions as F

from rollcall.llm import language_id as L


def sample(spark, n=240):
    rng = np.random.default_rng(1)
    words = {"aa": ["the", "tion", "of", "and"], "bb": ["ción", "que", "los", "por"], "cc": ["und", "der", "schön", "ung"]}
    rows = []
    for k in range(n):
        lang = sorted(words)[k % 3]
        rows.append((k, " ".join(rng.choice(words[lang], int(rng.integers(3, 80)))), lang, "s"))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_gradient_is_right():
    rng = np.random.default_rng(0)
    net = L.BiGRU(["a", "b", "c"], hidden=4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.integers(97, 102, (7, 5))
    real = np.ones((7, 5))
    real[5:, 2] = 0
    label = np.array([0, 1, 2, 1, 0])
    _, g = net.gradient(x, real, label)
    for name in net.w:
        flat = net.w[name].reshape(-1)
        picks = [97, 98, 300] if name == "table" else range(min(6, flat.size))
        for k in picks:
            old = flat[k]
            flat[k] = old + 1e-3
            up = net.gradient(x, real, label)[0]
            flat[k] = old - 1e-3
            down = net.gradient(x, real, label)[0]
            flat[k] = old
            assert abs((up - down) / 2e-3 - g[name].reshape(-1)[k]) < 2e-3


def test_labelling_equals_a_plain_loop():
    net = L.BiGRU(["a", "b"], hidden=3, seed=4)
    texts = [b"abcdefgh" * 5, b"", b"x", b"hello world!"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    got = net.label(data, off, window=16)

    def plain(t):
        total = np.zeros(2)
        for lo in range(0, len(t), 16):
            part = t[lo : lo + 16]
            states = []
            for d, seq in enumerate((part, part[::-1])):
                h, out = np.zeros(3), []
                for byte in seq:
                    a, u = net.w["table"][d][:, byte], net.w["recur"][d] @ h
                    z, r = np.clip(a[:3] + u[:3] + 0.5, 0, 1), np.clip(a[3:6] + u[3:6] + 0.5, 0, 1)
                    h = h + z * (np.clip(a[6:] + r * u[6:], -1, 1) - h)
                    out.append(h)
                states.append(out if d == 0 else out[::-1])
            for f, b in zip(*states, strict=True):
                s = net.w["out"][0] @ f + net.w["out"][1] @ b + net.w["bias"]
                total += np.exp(s) / np.exp(s).sum()
        return total / max(1, len(t))

    assert np.allclose(got, [plain(t) for t in texts], atol=1e-5)


def test_held_out_accuracy(spark):
    rows, docs = sample(spark)
    found = L.identify(docs, L.train(docs, epochs=20), score_name="p").withColumn("held_out", L.held_out(F.col("doc_id"))).collect()
    assert [r["held_out"] for r in found] == [zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in found]
    out = [r for r in found if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.95
    assert all(0 <= r["p"] <= 1 and r["score"] == "s" for r in found)


def test_defined_results(spark):
    _, docs = sample(spark, 60)
    net = L.train(docs, epochs=2)
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 !?", "x"), (None, "the of", None), (5, "the " * 50_000, "q"), (5, "the " * 50_000, "q")], "doc_id long, text string, lang_pred string")
    found = L.identify(odd, net).collect()
    rows = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in found}
    twice = [r for r in found if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0]["lang_pred"] == twice[1]["lang_pred"] and abs(twice[0]["score"] - twice[1]["score"]) < 1e-6
    assert [rows[k] for k in ((1, None), (2, ""), (3, "12 !?"))] == [("und", 0.0)] * 3
    assert rows[(None, "the of")][0] in net.classes
    assert L.train(docs.limit(0)) is None
    assert L.train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert L.identify(odd, None).where("lang_pred <> 'und'").count() == 0
    assert L.identify(odd.limit(0), net).count() == 0
    assert L.identify(odd, net, keep=["doc_id"]).columns == ["doc_id", "lang_pred", "score"]


def test_training_rows_are_the_least_by_hash_and_whole(spark, monkeypatch):
    _, docs = sample(spark, 600)
    monkeypatch.setattr(L, "LONGEST", 300)
    only_long = spark.createDataFrame([(9001, "le la " * 100, "dd", "s"), (9003, "les " * 200, "dd", "s")], docs.schema)
    docs = docs.unionAll(only_long)
    few = L.training_rows(docs, "text", "lang", "doc_id", 5)
    assert [r[0] for r in sorted(few)][:15] == ["aa"] * 5 + ["bb"] * 5 + ["cc"] * 5
    h = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"))
    own = docs.where(~L.held_out(F.col("doc_id"))).select("lang", "text", h.alias("h")).collect()
    for lang in ("aa", "bb", "cc", "dd"):
        best = sorted((r["h"], r["text"].encode()) for r in own if r["lang"] == lang and (lang == "dd" or len(r["text"].encode()) <= 300))[:5]
        assert [(x, t) for name, x, t in few if name == lang] == best
    assert sorted(L.training_rows(docs.unionAll(docs), "text", "lang", "doc_id", 5)) == sorted(few)


def test_every_byte_of_a_chosen_text_is_learned_from(spark, monkeypatch):
    _, docs = sample(spark, 60)
    seen = []
    monkeypatch.setattr(L.BiGRU, "fit", lambda self, x, size, label, epochs: seen.extend(bytes(r[:n]) for r, n in zip(x, size, strict=True)))
    L.train(docs)
    texts = [t for _, _, t in L.training_rows(docs, "text", "lang", "doc_id", L.PER_LANGUAGE)]
    assert sorted(seen) == sorted(t[k : k + L.STRETCH] for t in texts for k in range(0, len(t), L.STRETCH)) and sum(map(len, seen)) == sum(map(len, texts))


def test_long_texts_are_labelled_in_stretches(monkeypatch):
    net = L.BiGRU(["a", "b"], hidden=3, seed=4)
    data = np.random.default_rng(1).integers(97, 123, 5000).astype(np.uint8)
    off = np.array([0, 3000, 3100, 5000])
    whole = net.label(data, off)
    monkeypatch.setattr(L, "WINDOWS", 3)
    assert np.allclose(net.label(data, off), whole, atol=1e-5)
