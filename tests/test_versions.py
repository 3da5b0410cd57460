"""Tables of chunks that are replaced at once, folders that are, and the stream's ledger."""

import json
import os

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rollcall.operators.scoring import stub_scorer
from rollcall.sources import ChunkTable, read_chunks, write_chunk, write_chunks, write_summary
from rollcall.sources.versions import Conflict, Version
from rollcall.streaming import stream_extract, stream_summary
from rollcall.streaming.extract import save_batch
from tests.pngs import png


def rows(spark, *values):
    return spark.createDataFrame(values, "chunk_id long, v string")


def state(spark, path, version=None):
    return sorted((r["chunk_id"], r["v"]) for r in read_chunks(spark, path, version).collect())


def test_a_write_that_fails_midway_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_chunks(rows(spark, (1, "a"), (2, "b")), path)
    bad = rows(spark, (1, "x"), (2, "y"), (3, "z")).repartition(3, "v").withColumn("v", F.when(F.col("v") == "z", F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("v")))
    for write in (write_chunk, write_chunks):
        with pytest.raises(Exception, match="stop"):
            write(bad, path)
        assert state(spark, path) == [(1, "a"), (2, "b")]

    def end(before):
        assert before.number == 1
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        write_chunk(rows(spark, (1, "x")), path, before_publish=end)
    assert state(spark, path) == [(1, "a"), (2, "b")] and ChunkTable(spark, path).numbers() == [1]


def test_versions_replace_conflict_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    table = ChunkTable(spark, path)
    with pytest.raises(ValueError, match="no chunks"):
        table.read()
    write_chunks(rows(spark, (1, "a"), (1, "b"), (2, "c")), path)
    write_chunk(rows(spark, (1, "A"), (3, "d")), path)
    assert state(spark, path) == [(1, "A"), (2, "c"), (3, "d")] and state(spark, path, 1) == [(1, "a"), (1, "b"), (2, "c")]
    # a reader that has begun keeps its version while another is published
    before = read_chunks(spark, path)
    write_chunks(rows(spark, (9, "z")), path)
    assert before.count() == 3 and state(spark, path) == [(9, "z")]
    # two writers that both follow version 2: the later one must not hide the earlier one's
    with pytest.raises(Conflict):
        table.publish(Version(2, {}), {1: {"folder": "write=wx", "batch": None}})
    assert table.vacuum(1) == 2 and table.numbers() == [3] and state(spark, path) == [(9, "z")]
    with pytest.raises(ValueError, match="no version 1"):
        table.read(1)
    write_chunks(rows(spark).where("false"), path)
    with pytest.raises(ValueError, match="no chunks"):
        read_chunks(spark, path)


def test_many_writes_are_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(1, 5):
        write_chunk(rows(spark, (k, f"v{k}")), path)
    found = read_chunks(spark, path)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert state(spark, path) == [(k, f"v{k}") for k in range(1, 5)]
    assert len(found.where("chunk_id = 2").inputFiles()) == 4 and found.where("chunk_id = 2").count() == 1


def test_folders_are_replaced_after_the_write(spark, tmp_path):
    path = str(tmp_path / "s")
    write_summary(spark.createDataFrame([(1,)], "n int"), path)
    bad = spark.range(1).select(F.raise_error(F.lit("stop")).cast("int").alias("n"))
    with pytest.raises(Exception, match="stop"):
        write_summary(bad, path)
    assert json.loads(next((tmp_path / "s").glob("part-*")).read_text()) == {"n": 1}
    write_summary(spark.createDataFrame([(2,)], "n int"), path)
    assert json.loads(next((tmp_path / "s").glob("part-*")).read_text()) == {"n": 2}
    assert os.listdir(tmp_path) == ["s"]


@pytest.fixture
def images(tmp_path):
    folder = tmp_path / "images"
    folder.mkdir()
    rng = np.random.default_rng(6)
    for k in range(9):
        (folder / f"i {k}%41.png").write_bytes(png(rng.integers(0, 255, (4 + k % 2, 5, 3))) if k % 4 else b"broken")
        os.utime(folder / f"i {k}%41.png", (1_000_000 + k, 1_000_000 + k))
    return str(folder)


def totals(spark, out):
    found = stream_summary(spark, out)
    return tuple(found["totals"].first()), sorted(map(tuple, found["ages"].collect())), tuple(found["genders"].first())


def test_stream_fails_restarts_and_replays(spark, images, tmp_path):
    out, mark, seen = str(tmp_path / "out"), str(tmp_path / "mark"), []

    def fault(before):
        seen.append(before.number)
        if before.number == 2:
            raise RuntimeError("power")

    with pytest.raises(StreamingQueryException, match="power"):
        stream_extract(spark, images, out, stub_scorer(), mark, 2, fault).awaitTermination(120)
    assert seen == [0, 1, 2] and sorted(ChunkTable(spark, out).current().chunks) == [1, 2]
    stream_extract(spark, images, out, stub_scorer(), mark, 2).awaitTermination(120)
    done = ChunkTable(spark, out).current()
    assert sorted(done.chunks) == [1, 2, 3, 4, 5] and len(done.batches) == 5
    assert read_chunks(spark, out).count() == 9 and read_chunks(spark, out).select("image_path").distinct().count() == 9
    assert all(os.path.exists(r["image_path"]) for r in read_chunks(spark, out).collect())
    # all over again, in one chunk: the same totals
    stream_extract(spark, images, str(tmp_path / "one"), stub_scorer(), str(tmp_path / "mark1"), 100).awaitTermination(120)
    want = totals(spark, str(tmp_path / "one"))
    assert totals(spark, out) == want and want[0] == (9, 6, 3)
    # a batch that the stream repeats because it hadn't noted it is in the ledger
    batch = spark.read.format("image").load(images).limit(2)
    save_batch(batch, 4, out, stub_scorer(), mark)
    assert ChunkTable(spark, out).current().number == done.number
    # a second stream into the table adds chunks after the last
    save_batch(batch, 0, out, stub_scorer(), "other")
    assert sorted(ChunkTable(spark, out).current().chunks)[-1] == 6 and totals(spark, out)[0][0] == 11


def test_totals_are_merged_without_reading_rows(spark, images, tmp_path):
    out = str(tmp_path / "out")
    stream_extract(spark, images, out, stub_scorer(), str(tmp_path / "mark"), 3).awaitTermination(120)
    before = totals(spark, out)
    for df in stream_summary(spark, out).values():
        assert df.inputFiles() and all("/versions/" in f for f in df.inputFiles())
    # a replaced chunk replaces its part of the totals
    only = spark.read.format("image").load(images).where("image.height = 5").limit(1)
    save_batch(only, 0, out, stub_scorer())
    rows = read_chunks(spark, out)
    after = totals(spark, out)
    assert after[0] == (rows.count(), rows.where("saved").count(), rows.where("not saved").count()) and after[0] != before[0]
    assert after[2] == (rows.where("saved and gender = 0").count(), rows.where("saved and gender = 1").count())


def test_files_do_not_grow_with_the_number_of_chunks(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(3000).select(F.col("id").alias("chunk_id"), F.col("id").cast("string").alias("v"))
    write_chunks(many, path)
    write_chunk(many.where("chunk_id % 3 = 0").withColumn("v", F.lit("new")), path)
    data = [os.path.join(d, f) for d, _, names in os.walk(os.path.join(path, "data")) for f in names if f.endswith(".parquet")]
    assert len(data) < 100 and os.path.getsize(ChunkTable(spark, path).file(2)) < 2000
    assert state(spark, path) == [(k, "new" if k % 3 == 0 else str(k)) for k in range(3000)]
    assert state(spark, path, 1) == [(k, str(k)) for k in range(3000)]


def test_vacuum_takes_lines_and_stopped_writes_with_it(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in "abc":
        write_chunks(rows(spark, (1, v), (2, v)), path)

    def end(before):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        write_chunk(rows(spark, (2, "x")), path, before_publish=end)
    write_chunk(rows(spark, (2, "d")), path)
    kept = lambda: [n for n in os.listdir(os.path.join(path, "versions")) if n.startswith("lines=")]
    assert len(kept()) == 4 and ChunkTable(spark, path).vacuum(2) == 3 and len(kept()) == 2
    assert state(spark, path) == [(1, "c"), (2, "d")] and state(spark, path, 3) == [(1, "c"), (2, "c")]
