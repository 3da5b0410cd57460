import math

import pytest
from pyspark.sql import functions as F

from rollcall.functions import age_group, age_group_label, canonical_path, classify_candidate, classify_preprocess, cosine, l2_norm, l2_normalize, unpad_detections, with_output_paths, with_path_parts
from rollcall.functions.classify import VERDICTS
from rollcall.operators.detections import best_detection, without_detection


def test_age_groups(spark):
    ages = [-1, 0, 24, 25, 44, 45, 64, 65, None]
    rows = spark.createDataFrame([(k, a) for k, a in enumerate(ages)], "k int, age int").select("k", age_group(F.col("age")).alias("g"))
    rows = rows.withColumn("l", age_group_label(F.col("g"))).withColumn("m", age_group_label(F.col("g"), unknown=False)).orderBy("k").collect()
    assert [r["g"] for r in rows] == [-1, 0, 0, 1, 1, 2, 2, 3, -1]
    assert rows[0]["l"] == "Unknown" and rows[0]["m"] is None and rows[1]["m"] == "Young (0-24)"


def test_verdicts(spark):
    nan = float("nan")
    cases = [
        (False, None, None, 100.0, True, "no_face"),
        (False, None, None, 1.0, True, "no_face+blur"),
        (True, 0.0, None, 100.0, True, "invalid_embedding"),
        (True, nan, nan, 1.0, True, "invalid_embedding+blur"),
        (True, None, None, 100.0, True, "invalid_embedding"),
        (True, 1.0, 0.44, 100.0, True, "low_similarity"),
        (True, 1.0, 0.44, 79.9, True, "low_similarity+blur"),
        (True, 1.0, 0.45, 80.0, True, "accepted"),
        (True, 1.0, 0.9, 79.9, True, "blur"),
        (True, 1.0, nan, 90.0, True, "accepted"),
        (True, 1.0, 0.9, 90.0, False, "unreadable_image"),
    ]
    df = spark.createDataFrame([c for c in cases], "face boolean, n double, s double, b double, ok boolean, want string")
    args = [F.col(c) for c in ("face", "n", "s", "b")]
    got = df.select("want", classify_candidate(*args, readable=F.col("ok")).alias("got"), classify_candidate(*args, readable=F.col("ok"), reject_nan=True).alias("strict")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]
    assert got[9]["strict"] == "low_similarity"
    assert {r["got"] for r in got} == set(VERDICTS)


def test_preprocess_outcomes(spark):
    cases = [(None, 100.0, None, "no_face"), (0.84, 1.0, None, "low_conf"), (0.85, 79.0, None, "blurry"), (0.85, 80.0, None, "success"), (0.9, 90.0, "bad", "error")]
    df = spark.createDataFrame(cases, "c double, b double, e string, want string")
    got = df.select("want", classify_preprocess(F.col("c"), F.col("b"), error=F.col("e")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got)


def test_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, None)], "k int, v array<float>")
    rows = df.select("k", l2_norm(F.col("v")).alias("n"), l2_normalize(F.col("v")).alias("u"), cosine(F.col("v"), F.array(F.lit(1.0), F.lit(0.0))).alias("c")).orderBy("k").collect()
    assert rows[0]["n"] == 5.0 and rows[0]["u"] == pytest.approx([0.6, 0.8]) and rows[0]["c"] == pytest.approx(0.6)
    assert rows[1]["u"] is None and rows[1]["c"] is None
    assert math.isnan(rows[2]["n"]) and rows[2]["u"] is None and rows[2]["c"] is None
    assert rows[3]["n"] is None and rows[3]["u"] is None


def test_paths(spark):
    df = spark.createDataFrame([("file:///a/b.c/x.y.PNG",), ("file:/a/.hidden",), ("/p/q",)], "path string")
    rows = with_path_parts(df.withColumn("path", canonical_path(F.col("path")))).collect()
    assert [(r["path"], r["filename"], r["stem"], r["suffix"], r["processed_name"]) for r in rows] == [
        ("/a/b.c/x.y.PNG", "x.y.PNG", "x.y", ".PNG", "x.y_face.jpg"),
        ("/a/.hidden", ".hidden", ".hidden", "", ".hidden_face.jpg"),
        ("/p/q", "q", "q", "", "q_face.jpg"),
    ]
    named = with_output_paths(spark.createDataFrame([(7, 3, 1), (1234, 0, None)], "identity_id int, trial int, accepted_idx int"), "/o/").orderBy("identity_id").collect()
    assert named[0]["candidate_path"] == "/o/_candidates/007_003.png" and named[0]["image_path"] == "/o/images/identity_007/001.png"
    assert named[1]["rejected_path"] == "/o/rejected/identity_1234_trial_000.png" and named[1]["image_path"] is None


def test_detections(spark):
    box = lambda w, h: [10.0, 10.0, 10.0 + w, 10.0 + h]
    rows = [("a", 1, 0, box(1, 1)), ("a", 1, 1, box(3, 3)), ("a", 1, 2, box(3, 3)), ("a", 0, 5, box(1, 2)), ("b", 2, 1, box(9, 9)), ("b", 2, 0, box(1, 1))]
    df = spark.createDataFrame(rows, "image string, attempt int, face_idx int, bbox array<double>")
    largest = {r["image"]: (r["attempt"], r["face_idx"]) for r in best_detection(df).collect()}
    assert largest == {"a": (0, 5), "b": (2, 1)}
    assert {r["image"]: r["face_idx"] for r in best_detection(df, "first").collect()} == {"a": 5, "b": 0}
    assert [r["image"] for r in without_detection(spark.createDataFrame([("a",), ("z",)], "image string"), df).collect()] == ["z"]
    padded = spark.createDataFrame([([100.0, 50.0, 120.0, 70.0], [[101.0, 51.0]], 101, 200, 0.25)], "bbox array<double>, kps array<array<double>>, height int, width int, ratio double")
    moved = unpad_detections(padded).first()
    assert moved["bbox"] == [50.0, 25.0, 70.0, 45.0] and moved["kps"] == [[51.0, 26.0]]
