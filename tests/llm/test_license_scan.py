import re

import numpy as np

from pyspark.sql import functions as F

from rollcall.llm import license_scan as S


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    w = plain_words(text)
    places = [(i, label) for phrase, label in S.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    padded = " " + " ".join(w) + " "
    found = []
    for label, p, s, _, pattern in S.RULES:
        for m in re.finditer(f"(?<= ){pattern}(?= )", padded):
            b = padded[: m.start()].count(" ") - 1
            found.append((b, b + m.group().count(" ") + 1, p, s, label))
    kept = []
    for i, (b, e, p, s, label) in enumerate(found):
        covered = any(
            x <= b and z >= e and (q > p or (q == p and (z - x > e - b or ((x, z) == (b, e) and j < i))))
            for j, (x, z, q, _, _) in enumerate(found)
        )
        if not covered:
            kept.append((label, s))
    base = sorted({label for _, label in places})
    starts = [i for i, _ in places]
    labels = sorted(set(base) | {label for label, _ in kept})
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), max((s for _, s in kept), default=0.0))


def test_rules_are_hundreds_and_gated():
    assert len({pattern for *_, pattern in S.RULES}) > 200
    for *_, key, pattern in S.RULES:
        assert any(g in pattern for g in S.GATES), pattern
        assert re.compile(pattern) and key == key.lower()


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    pieces = ["MIT License", "licensed under the", "Apache License, Version 2.0", "GNU General Public License v3", "GNU Lesser General Public License version 2.1", "all rights reserved", "Copyright (c) 2020", "permission is hereby granted, free of charge, to any person obtaining a copy of this software", "word", "née", "x-y", "released under the BSD 3-Clause license", "SPDX-License-Identifier: MIT", "mit", "license", "Public Domain", "placed in the public domain", "creative commons attribution 4.0 international license", "without warranty of any kind", "All Rights Reserved. Copyright 1999", "version 2 of the GNU General Public License", "licensed under the GNU GPL v3"]
    texts = [None, "", "...", "MIT LICENSE mit license", "submit license", "the apache license/general public license"] + [" ".join(rng.choice(pieces, int(rng.integers(1, 12)))) for _ in range(60)]
    docs = spark.createDataFrame([(k, t, 0, "w") for k, t in enumerate(texts)], "doc_id long, text string, score int, words string")
    got = S.scan_licenses(docs).orderBy("doc_id").collect()
    assert [tuple(r)[1:8] for r in got] == [brute(t) for t in texts]


def test_blocks_see_what_crosses_their_borders(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 7)
    rng = np.random.default_rng(5)
    pieces = ["released under the mit license", "gnu general public license version 2", "apache license", "all rights reserved", "word", "two words", "licensed under the apache license version 2 0"]
    texts = [" ".join(rng.choice(pieces, int(rng.integers(1, 40)))) for _ in range(25)]
    got = S.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r)[1:8] for r in got] == [brute(t) for t in texts]


def test_a_hundred_thousand_notices(spark):
    text = "Licensed under the MIT license. " * 100_000
    r = S.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("labels", "n_base", "last_word", F.size("detections").alias("n")).first()
    assert (r["labels"], r["n_base"], r["last_word"], r["n"]) == ("mit", 100_000, 499_998, 100_000)


def test_long_text_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "some words " * 50_000 + "under the MIT license"), (1, "a"), (1, "a")], "doc_id long, text string")
    rows = S.scan_licenses(docs).collect()
    assert len(rows) == 3
    long = next(r for r in rows if r["doc_id"] is None)
    assert long["n_words"] == 100_004 and long["first_word"] == 100_002 and long["labels"] == "mit"
    assert S.scan_licenses(docs.limit(0)).count() == 0
