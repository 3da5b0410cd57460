import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollcall.llm import token_counts as T

public_tokenizers = pytest.importorskip("public_tokenizers")


def path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizer.from_file(path())


def whole(library, text: str) -> int:
    return len(library.encode(text, add_special_tokens=False).ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "word", " ", "  ", "\n", "\t", "é", "12", "'s", "!?", "<|endoftext|>", "中", "　", " ", "x" * 40, "🙂"]), max_size=60))
def test_pieces_count_like_the_whole(library, parts):
    text = "".join(parts)
    cut = T.pieces(text, 7)
    assert "".join(cut) == text
    assert sum(T.count_lengths(cut, path())) == whole(library, text)


def test_long_and_odd_texts(spark, library):
    texts = ["lorem ipsum, dolor's " * 20_000, "a" * 200_000, "no<|endoftext|>yes <|endoftext|>", "", None, "  \x0b\x1c x", "tab\tß é ñ", "  lead and trail  \n\n "]
    docs = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens long")
    got = {r["doc_id"]: r for r in T.token_counts(docs, path(), limit=10).collect()}
    for k, t in enumerate(texts):
        assert got[k]["n_tokens"] == whole(library, t or "")
        assert got[k]["n_bytes"] == len((t or "").encode())
        assert got[k]["over_limit"] == (whole(library, t or "") > 10)


def test_empty_table(spark):
    assert T.token_counts(spark.createDataFrame([], "doc_id long, text string"), path()).count() == 0


def test_calls_hold_equal_bytes():
    texts = ["é" * 40, None, "a" * 30, "", "中文 " * 30, "b " * 100_000]
    got = list(T.calls(texts, 100))
    assert [k for owner, _ in got for k in owner] == sorted(k for owner, _ in got for k in owner)
    for k, text in enumerate(texts):
        assert "".join(p for owner, call in got for o, p in zip(owner, call, strict=True) if o == k) == (text or "")
    sizes = [sum(len(p.encode()) for p in call) for _, call in got]
    assert all(n <= 100 or len(call) == 1 for n, (_, call) in zip(sizes, got, strict=True))
    assert got[0][0] == [0] and got[1][0] == [2]  # 80 bytes of 40 characters, and 30
