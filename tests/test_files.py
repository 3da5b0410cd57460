import json
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions import laplacian_variance
from rollcall.operators.scoring import score_images, stub_scorer
from rollcall.plans import Settings, run
from rollcall.sources import count_images, filter_images, list_files, new_files, newest_new_file, read_chunks, read_images, read_json_doc, read_manifest, read_snapshot, save_snapshot, write_chunk, write_manifests, write_summary
from rollcall.streaming import stream_extract, stream_summary
from tests.pngs import png


@pytest.fixture
def folder(tmp_path):
    rng = np.random.default_rng(1)
    root = tmp_path / "raw"
    (root / "sub").mkdir(parents=True)
    golden = np.zeros((4, 5, 3), np.uint8)
    golden[..., 0] = 200
    golden[0, 0] = (1, 2, 3)
    (root / "golden.png").write_bytes(png(golden))
    (root / "sub" / "upper.PNG").write_bytes(png(rng.integers(0, 255, (6, 6, 3))))
    (root / "broken.png").write_bytes(b"no image")
    (root / "black.png").write_bytes(png(np.zeros((3, 3, 3), np.uint8)))
    (root / "metadata.png").write_bytes(png(golden))
    (root / "other.webp").write_bytes(b"RIFF")
    (root / "notes.txt").write_text("x")
    return str(root)


def names(df):
    return sorted(os.path.basename(r["path"]) for r in df.select("path").collect())


def test_listing_and_presets(spark, folder):
    files = list_files(spark, folder)
    assert "content" not in files.columns and files.count() == 7
    assert all(r["path"].startswith("/") for r in files.collect())
    assert names(filter_images(files, "raw")) == ["black.png", "broken.png", "golden.png", "metadata.png"]
    assert names(filter_images(files, "pool")) == ["black.png", "broken.png", "golden.png", "metadata.png", "other.webp", "upper.PNG"]
    assert names(filter_images(files, "extract", root=folder, recursive=False)) == ["black.png", "broken.png", "golden.png"]
    assert count_images(files).first()["n_images"] == 5


def test_listing_takes_presets_and_times_itself(spark, folder):
    for preset in ("raw", "pool", "adapter"):
        want = names(filter_images(list_files(spark, folder), preset))
        listed = list_files(spark, folder, preset=preset)
        assert names(listed) == want and len(listed.inputFiles()) == len(want)
    assert names(list_files(spark, folder, recursive=False, preset="extract")) == ["black.png", "broken.png", "golden.png"]
    os.utime(os.path.join(folder, "golden.png"), (10, 10))
    old = list_files(spark, folder, since="1970-01-01T00:00:30")
    assert "golden.png" not in names(old) and len(old.inputFiles()) == 6
    assert old.where("length > 1000")._jdf.queryExecution().executedPlan().toString().count("GreaterThan(length,1000)")


def test_snapshots(spark, folder, tmp_path):
    before = save_snapshot(list_files(spark, folder, preset="pool"), str(tmp_path / "snap"))
    os.utime(os.path.join(folder, "broken.png"), (10, 10))
    os.rename(os.path.join(folder, "broken.png"), os.path.join(folder, "moved in.png"))
    after = list_files(spark, folder, preset="pool")
    assert names(new_files(after, before)) == ["moved in.png"] and names(read_snapshot(spark, str(tmp_path / "snap"))) == names(before)
    again = save_snapshot(after, str(tmp_path / "snap"))
    assert new_files(after, again).count() == 0


def test_sharpness_and_scores(spark, folder):
    images = read_images(spark, folder)
    found = {os.path.basename(r["path"]): r["laplacian_variance"] for r in laplacian_variance(images).collect()}
    assert found["golden.png"] == pytest.approx(2993.96)
    assert found["broken.png"] is None and found["black.png"] == 0.0

    def picky():
        score = stub_scorer()()

        def run_one(image):
            if image.shape[0] == 6:
                raise RuntimeError("odd")
            return score(image)

        return run_one

    rows = {os.path.basename(r["path"]): r for r in score_images(images, picky).collect()}
    assert len(rows["golden.png"]["embedding"]) == 8 and rows["golden.png"]["error"] is None
    assert rows["black.png"]["embedding"] is None and rows["black.png"]["readable"]
    assert not rows["broken.png"]["readable"] and rows["upper.PNG"]["error"] == "RuntimeError: odd"
    with pytest.raises(Exception, match="odd"):
        score_images(images, picky, on_error="raise").collect()


def test_newest_new_file(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5), ("d", 9)], "path string, modificationTime int")
    assert newest_new_file(rows, rows.where("path = 'd'")).first()["path"] == "c"
    assert newest_new_file(rows, rows).count() == 0


def test_chunks_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "chunks")
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "chunk_id int, v string")
    write_chunk(df, out)
    write_chunk(df.where("chunk_id = 1").withColumn("v", F.upper("v")), out)
    assert sorted(r["v"] for r in read_chunks(spark, out).collect()) == ["A", "B", "c"]


def test_manifest_round_trip(spark, tmp_path):
    row = spark.createDataFrame([(1, 2, 25)], "identity_id int, trial int, detected_age int")
    for name, kind in {"seed_path": "string", "style_path": "string", "generation_seed": "bigint", "candidate_path": "string", "arcface_similarity": "double", "laplacian_variance": "double", "detected_gender": "int", "rejection_reason": "string", "image_path": "string", "cluster_id": "int"}.items():
        row = row.withColumn(name, F.lit(None).cast(kind))
    write_manifests(row, row.limit(0), str(tmp_path))
    back = read_manifest(spark, str(tmp_path / "identity_manifest")).first()
    assert (back["identity_id"], back["detected_age"], back["detected_gender"]) == (1, 25, None)
    empty = [f for f in os.listdir(tmp_path / "rejection_manifest") if f.endswith(".csv")]
    assert any("identity_id" in (tmp_path / "rejection_manifest" / f).read_text() for f in empty)


def test_summary_document(spark, tmp_path):
    write_summary(spark.createDataFrame([(1, {"a": 2})], "n int, m map<string,bigint>"), str(tmp_path / "s"))
    text = next((tmp_path / "s").glob("part-*")).read_text()
    assert json.loads(text) == {"n": 1, "m": {"a": 2}}
    assert read_json_doc(spark, str(tmp_path / "s"), "n int, m map<string,bigint>").first()["m"] == {"a": 2}


def test_stream_equals_batch_and_replay_counts_once(spark, folder, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    stream_extract(spark, folder, out, stub_scorer(), mark, 2).awaitTermination(120)
    totals = stream_summary(spark, out)["totals"].first()
    assert (totals["source_images"], totals["extracted"], totals["failed"]) == (7, 3, 4)
    from rollcall.streaming.extract import save_batch

    first = spark.read.format("image").option("recursiveFileLookup", "true").load(folder).where("image.origin like '%golden%'")
    save_batch(first, 0, out, stub_scorer())
    save_batch(first, 0, out, stub_scorer())
    assert read_chunks(spark, out).where("chunk_id = 1").count() == 1


def test_whole_pipeline(spark, tmp_path):
    rng = np.random.default_rng(2)
    raw, out = tmp_path / "raw", tmp_path / "out"
    (out / "_candidates").mkdir(parents=True)
    raw.mkdir()
    for k in range(12):
        (raw / f"r{k}.png").write_bytes(png(rng.integers(0, 255, (8, 8, 3))))
    for i in range(4):
        for t in range(4):
            (out / "_candidates" / f"{i:03d}_{t:03d}.png").write_bytes(png(rng.integers(0, 255, (8, 8, 3))))
    s = Settings(raw=str(raw), out=str(out), scorer=stub_scorer(), n_identities=4, images_per_identity=2, candidates_per_identity=4, n_forget=1, n_test=1, conf_threshold=0.1, blur_threshold=1.0, crop_blur_threshold=1.0, min_similarity=0.0, chunk_size=5)
    made = run(spark, s)
    assert made["funnel"].first()["success"] == 12
    assert made["accepted"].count() == 8 and made["chunks"].count() == 2
    rows = made["dataset"].collect()
    assert len(rows) == 8 and {r["split"] for r in rows} == {"forget", "test", "retain"}
    assert made["summary"].first()["n_clusters"] == 4
    written = spark.read.option("header", True).csv(str(out / "dataset" / "csv"))
    assert written.columns == ["image_path", "cluster_id", "age_group", "split", "forget_step"] and written.count() == 8
    # a candidate that wasn't made is an error if its identity needs it, not after that
    (out / "_candidates" / "002_000.png").rename(tmp_path / "kept.png")
    with pytest.raises(ValueError, match="1 planned candidates weren't made, identity/trial 2/0"):
        run(spark, replace(s, steps={"preprocess": False, "extract": False, "build": False}))
    (tmp_path / "kept.png").rename(out / "_candidates" / "002_000.png")
    looked_at = {os.path.basename(r["candidate_path"]) for key in ("accepted", "rejected") for r in made[key].select("candidate_path").collect()}
    (out / "_candidates" / min({f"00{i}_003.png" for i in range(4)} - looked_at)).unlink()
    again = run(spark, replace(s, steps={"preprocess": False, "extract": False, "build": False}))
    assert again["accepted"].count() == 8
    # steps alone, from what the others wrote
    alone = run(spark, replace(s, steps={"preprocess": False, "generate": False, "extract": False}))
    assert sorted(alone["dataset"].collect()) == sorted(rows)
    with pytest.raises(ValueError, match="needs what step generate writes"):
        run(spark, replace(s, out=str(tmp_path / "none"), steps={"preprocess": False, "generate": False}))
    # a shorter rerun leaves no chunk of the longer one, and a chunk of failures replaces its rows
    from rollcall.plans.jobs import extract

    paths = spark.createDataFrame([(str(out / "_candidates" / f"00{k}_000.png"),) for k in range(4)], "path string")
    attributes, chunks, _ = extract(spark, paths, str(out / "_candidates"), str(out / "attributes"), replace(s, chunk_size=2))
    assert attributes.count() == 4 and sorted(r["saved_embeddings"] for r in chunks.collect()) == [2, 2]
    for k in range(2):
        (out / "_candidates" / f"00{k}_000.png").write_bytes(png(np.zeros((3, 3, 3))))
    attributes, chunks, summary = extract(spark, paths.limit(3), str(out / "_candidates"), str(out / "attributes"), replace(s, chunk_size=2))
    assert [r["chunk_id"] for r in attributes.collect()] == [2]
    assert sorted((r["saved_embeddings"], r["failed"]) for r in chunks.collect()) == [(0, 2), (1, 0)] and summary.first()["failed"] == 2
