"""The model against one of plain dictionaries, its sums, and odd cases."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from rollcall.llm import lm_scoring as L


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


class Plain:
    """Probabilities straight from the definition; () begins a text."""

    def __init__(self, texts, order):
        self.order = order
        self.words = Counter(w for t in texts for w in tokens(t))
        grams = [Counter() for _ in range(order)]
        for t in texts:
            line = [(), *tokens(t)]
            for i in range(1, len(line)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        grams[k - 1][tuple(line[i - k + 1 : i + 1])] += 1
        self.counts = [grams[-1]]
        for k in range(order - 1, 0, -1):
            left = defaultdict(set)
            for g in grams[k]:
                left[g[1:]].add(g[0])
            self.counts.insert(0, {g: len(left[g]) if g in left else n for g, n in grams[k - 1].items() if g != ((),)})
        self.discounts = []
        self.by = []
        for c in self.counts:
            n = [sum(x == j for x in c.values()) for j in (1, 2, 3, 4)]
            d = (0.5, 1.0, 1.5)
            if all(n[:3]):
                y = n[0] / (n[0] + 2 * n[1])
                e = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2])
                d = e if 0 < e[0] <= e[1] <= e[2] and e[0] <= 1 and e[1] <= 2 and e[2] <= 3 else d
            self.discounts.append(d)
            by = defaultdict(list)
            for g, x in c.items():
                by[g[:-1]].append(x)
            cut = lambda x, d=d: d[min(x, 3) - 1]
            self.by.append({h: (sum(x), sum(map(cut, x))) for h, x in by.items()})

    def p(self, history, word):
        """history: the tokens before, longest first to be used."""
        if len(history) == 0:
            lower = 1 / (len(self.words) + 1)
        else:
            lower = self.p(history[1:], word)
        k = len(history)
        d, context = self.discounts[k], self.by[k].get(tuple(history))
        if not context:
            return lower
        n = self.counts[k].get((*history, word), 0)
        return (n - (d[min(n, 3) - 1] if n else 0) + context[1] * lower) / context[0]

    def score(self, text):
        line = [(), *tokens(text)]
        return sum(math.log10(self.p(line[max(0, i - self.order + 1) : i], line[i])) for i in range(1, len(line)))

    def base(self, text):
        n = sum(self.words.values())
        return sum(math.log10((self.words[w] + 0.1) / (n + 0.1 * (len(self.words) + 1))) for w in tokens(text))


def made(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["É.", "The", "the", "x y"]
    return [(k, " ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=rng.randint(0, 12)))) for k in range(n)] + [(n, None), (n, ""), (None, "the w1  w2\n"), (n + 1, "the w1"), (n + 1, "the w1")]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_against_dictionaries(spark, order):
    rows = made(order, 120)
    model = Plain([t for d, t in rows if not out(d)], order)
    df = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    got = L.lm_scores(df, order=order).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), out(d), len(tokens(t)), sum(w in model.words for w in tokens(t)), sum(model.words.values()), round(model.base(t), 6), round(model.score(t), 6)) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got) == want


def test_probabilities_sum_to_one(spark):
    rows = [(k, t) for k, t in made(9, 60) if k is not None and not out(k)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string"))
    words = sorted({w for _, t in rows for w in tokens(t) if w})
    for before in ("w0", "the w1", "neverseen"):
        one = spark.createDataFrame([(k, f"{before} {w}") for k, w in enumerate([*words, "unknown"])] + [(-1, before)], "doc_id long, text string")
        plain = Plain([t for _, t in rows], 2)
        got = {r["doc_id"]: r["score"] for r in L.score(one, model).collect()}
        history = [(), *tokens(before)[:-1]]
        start = sum(math.log10(plain.p(history[max(0, i - 1) : i], history[i])) for i in range(1, len(history)))
        total = 10 ** (got[-1] - start)
        for k, w in enumerate([*words, "unknown"]):
            total += 10 ** (got[k] - start - math.log10(plain.p([w], None)))
        assert total == pytest.approx(1)


def test_no_training_text_and_empty_table(spark):
    held = next(k for k in range(1000) if out(k))
    df = spark.createDataFrame([(held, "some words")], "doc_id long, text string")
    assert [tuple(r) for r in L.lm_scores(df).collect()] == [(held, True, 3, 0, 0, 0.0, 0.0)]
    assert L.lm_scores(df.where("false")).count() == 0


def test_long_text(spark):
    rows = [(1, "one two three " * 120_000), (2, "one two"), (3, "z" * 300_000)]
    rows = [(k if not out(k) else k + 50, t) for k, t in rows]
    model = Plain([t for _, t in rows], 2)
    got = {r["doc_id"]: r for r in L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        assert got[k]["score"] == pytest.approx(model.score(t)) and got[k]["n_tokens"] == len(tokens(t))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables are not there")
def test_given_table(spark):
    from rollcall.llm.queries import op13_lm_score

    path = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet'").fetchall()
    model = Plain([t for d, t in rows if not out(d)], L.ORDER)
    got = op13_lm_score(spark, path).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(model.score(texts[r["doc_id"]])) and r["base_score"] == pytest.approx(model.base(texts[r["doc_id"]]))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
