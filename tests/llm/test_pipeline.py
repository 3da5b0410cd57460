import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    import numpy as np

    rng = np.random.default_rng(1)
    out = tmp_path_factory.mktemp("sf")
    text = lambda n: "\n".join(" ".join("".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(14)) for _ in range(n))
    rows = [(k, text(4), "en", f"s{k % 3}") for k in range(60)]
    item = rows[7][1].split("\n")[1]
    rows += [(100, rows[0][1], "en", "s0"), (101, rows[1][1].replace("\n", " \n", 1), "en", "s1"), (102, rows[2][1].replace("\n", " "), "en", "s1"), (103, "12 34", "en", "s0"), (104, None, None, None), (105, text(1) + " " + item, "en", "s2"), (106, rows[3][1].split("\n")[0] + "\n" + text(2), "en", "s2"), (107, rows[4][1], "en", "s0"), (107, rows[4][1], "en", "s0"), (None, text(2), "en", None)]
    frame = spark.createDataFrame([(*r, len(r[1] or ""), 0.5) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")
    frame.write.parquet(str(out / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(out / "benchmark.parquet"))
    return str(out)


def test_each_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_copies", "benchmark_leaks", "mix"]
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder))
        seen[name] = docs.collect()
        assert docs.columns == columns or name == "mix" and docs.columns[: len(columns)] == columns
    ids = {n: [r["doc_id"] for r in rows] for n, rows in seen.items()}
    assert 103 not in ids["language"] and 104 not in ids["language"] and set(range(60)) <= set(ids["language"]) and None in ids["language"]
    assert 100 not in ids["lines"] and 107 not in ids["lines"] and 106 in ids["lines"]
    cut = next(r for r in seen["lines"] if r["doc_id"] == 106)
    assert cut["text"].count("\n") == 1 and cut["n_chars"] == len(cut["text"])
    assert 102 not in ids["near_copies"] and 2 in ids["near_copies"] and set(range(60)) <= set(ids["near_copies"])
    assert set(ids["near_copies"]) - set(ids["benchmark_leaks"]) == {7, 105}
    assert all(0 < r["taken"] and r["copies"] <= 3 for r in seen["mix"])
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, seen["mix"]))


def test_blank_left_overs_and_equal_rows(spark):
    long = "a line that is long enough to find a pair"
    rows = [(1, long, "a"), (2, " \n" + long, "a"), (3, "one two three four five six seven", "b"), (3, "one two three four five six seven", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = corpus_pipeline.line_stage(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["source"]) for r in left) == [(1, "a"), (3, "a"), (3, "b")]
    kept = corpus_pipeline.near_copy_stage(spark, docs, "")
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [(1, long, "a"), (3, rows[3][1], "a")]


def test_unclear_language_goes(spark, monkeypatch):
    class Even:
        classes = ["a", "b"]

    monkeypatch.setattr(corpus_pipeline, "train", lambda docs: Even())
    monkeypatch.setattr(corpus_pipeline, "identify", lambda docs, net, pred, score_name: docs.withColumn(pred, F.lit("a")).withColumn(score_name, F.col("p")))
    docs = spark.createDataFrame([(1, 0.51), (2, 0.53), (3, 1.0)], "doc_id long, p double")
    assert [r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").collect()] == [2, 3]


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_with_clashing_names_and_maps_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 12 or doc_id in (100, 107) or doc_id is null")
    names = ["_id", "_h", "_size", "_row", "_text", "own_id", "own_hash", "own_size", "lang_pred", "lang_score", "_lang_pred", "n_lines", "N_Removed", "text_hash", "size", "group", "entry", "k", "h", "t", "taken"]
    docs = docs.withColumns({n: F.lit(f"my {n}") for n in names} | {"tags": F.create_map(F.lit("a"), F.col("source"))})
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, folder))
        rows = docs.collect()
        assert rows and all(c in docs.columns for c in [*names, "tags"]), name
        for r in rows:
            assert all(r[n] == f"my {n}" for n in names if name != "mix" or n != "taken") and r["tags"] == before[r["doc_id"]]["tags"], name
        assert name == "mix" or docs.columns == list(before.values())[0].__fields__
    assert len({r["doc_id"] for r in rows}) == len(rows)
