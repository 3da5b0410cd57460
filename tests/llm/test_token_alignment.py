"""Alignment against both libraries on whole texts, pair by pair, and its odd cases."""

import hashlib
import os
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import token_alignment as T

P = pytest.importorskip("public_tokenizers")
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def whole(text):
    """((id, first byte, byte behind) of A's tokens, of B's tokens), or None without tokens."""
    v = T.vocabulary(*PATHS)
    if not text:
        return None
    out = []
    for ids, entry in ((v.a.encode(" " + text, add_special_tokens=False).ids, v.a_bytes), (v.b.encode(text), v.b_bytes)):
        if b"".join(entry[i] for i in ids) != (" " + text).encode():
            return None
        at, tokens = 0, []
        for i in ids:
            tokens.append((i, at, at + len(entry[i])))
            at += len(entry[i])
        out.append(tokens)
    return out


def plain(texts):
    both = [whole(t) for t in texts]
    links = [[(x[0], y[0]) for x in ab[0] for y in ab[1] if x[1] < y[2] and y[1] < x[2]] if ab else [] for ab in both]
    count = Counter(p for own in links for p in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for ab, own in zip(both, links, strict=True):
        if not ab:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        ends = sorted({x[2] for x in ab[0]} & {y[2] for y in ab[1]})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(x[0]) for x in side if lo < x[2] <= hi) for side in ab))
            lo = hi
        out.append((len(ab[0]), len(ab[1]), len(groups), len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


PARTS = ["word", "word", " and", " ", " the", "  ", "\n", "\n\n", "\t", "é", " été", "12", " 3,4", "'s", "!?", "<|endoftext|>", " <s>", "<0x0A>", "▁", " ▁x", "中文", "　", " ", " …", "\x00", "x" * 40, "🙂", " 🙂", "ß", "\r\n", "ẞ", " ", "ﬁ"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=40))
def test_units_encode_like_the_whole(parts):
    text = "".join(parts)
    data = (" " + text).encode()
    import numpy as np

    cut = [0, *np.flatnonzero(T.safe_places(np.frombuffer(data, np.uint8))), len(data)]
    v = T.vocabulary(*PATHS)
    a, b, good = v.encode([data[x:y] for x, y in zip(cut, cut[1:], strict=False)])
    want = whole(text)
    assert bool(good.all()) == (want is not None)
    if want:
        assert [i for x in a for i in x] == [t[0] for t in want[0]]
        assert [i for x in b for i in x] == [t[0] for t in want[1]]


def table(spark, texts):
    return spark.createDataFrame([(k, t, 1, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_a int, bytes string")


TEXTS = ["The word is the word.", "", None, "a▁b and the word", " lead", "trail ", "  ", "The word is the word.", "é été\n\nnew lines 中文 字", "no<|endoftext|>yes <s>", "x" * 700, "long text of many words, " * 60, "and the word", "ab  cd   ef " * 30 + "▁ end", "\x00 \x01", "z " * 200]


@pytest.mark.parametrize("chunk", [1 << 16, 64, 7])
def test_against_whole_texts(spark, chunk):
    got = T.token_alignment(table(spark, TEXTS).repartition(3), *PATHS, chunk=chunk)
    rows = {r["doc_id"]: tuple(r)[1:] for r in got.collect()}
    assert [rows[k] for k in range(len(TEXTS))] == plain(TEXTS)


def test_ranges_compose_alike_in_any_grouping(spark):
    text = (" " + "some words, and " * 20 + "y" * 90 + " rest of it").encode()
    pieces = [text[k : k + 11] for k in range(0, len(text), 11)]
    df = spark.createDataFrame([(0, 5, k, bytearray(p)) for k, p in enumerate(pieces)], "row long, doc long, k long, bytes binary")
    ends = T._open_ends(df).collect()

    def fold(x, y):
        if x["cut"] and y["cut"]:
            return {"pre": x["pre"], "parts": x["parts"] + [bytes(x["suf"]) + bytes(y["pre"])] + y["parts"], "suf": y["suf"], "cut": True}
        if x["cut"]:
            return {"pre": x["pre"], "parts": x["parts"], "suf": bytes(x["suf"]) + bytes(y["pre"]), "cut": True}
        return {"pre": bytes(x["pre"]) + bytes(y["pre"]), "parts": y["parts"], "suf": y["suf"], "cut": y["cut"]}

    one = {"pre": b"", "parts": [], "suf": b"", "cut": False}
    for r in ends:
        one = fold(one, {"pre": r["pre"], "parts": [bytes(r["mid"])] if r["cut"] else [], "suf": r["suf"], "cut": r["cut"]})
    want = [p for p in [bytes(one["pre"]), *one["parts"], bytes(one["suf"])] if p]
    long = spark.createDataFrame([(5, bytearray(text))], "doc long, bytes binary")
    got = [bytes(r["bytes"]) for r in T.long_parts(long, 11).orderBy("ord").collect()]
    assert got == want and b"".join(got) == text


def test_empty_table_repeated_rows_and_null_key(spark):
    assert T.token_alignment(table(spark, []), *PATHS).count() == 0
    df = spark.createDataFrame([(None, "one two " * 20), (3, "one two " * 20), (3, "one two " * 20)], "doc_id long, text string")
    want = plain(["one two " * 20] * 3)[0]
    assert sorted((tuple(r) for r in T.token_alignment(df, *PATHS, chunk=50).collect()), key=str) == sorted([(3, *want), (3, *want), (None, *want)], key=str)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="tables are not there")
def test_given_table(spark):
    from rollcall.llm.queries import op12_align

    path = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{path}/documents.parquet' WHERE length(text) < 3000 ORDER BY doc_id").fetchall()
    small = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in T.token_alignment(small, *PATHS, chunk=1000).collect()}
    assert got == dict(zip([d for d, _ in docs], plain([t for _, t in docs]), strict=True))
    assert op12_align(spark, path).count() == 200
