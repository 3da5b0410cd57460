"""Files listed by the tasks."""

import os

import pytest

from rollcall import file_queries
from rollcall.sources import list_files, list_in_tasks

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_tasks_list_what_spark_lists(spark, tmp_path, scheme):
    for name in ("a.png", "below/b c%20[1].png", "below/deep/x+{2}.txt", ".hidden.png", "_made/c.png", "below/_SUCCESS", "_k=1/d.png", "empty"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if name == "empty" else name.encode())
    (tmp_path / "nothing").mkdir()
    os.utime(tmp_path / "a.png", (1_000_000.25, 1_000_000.25))
    root = f"{scheme}{tmp_path}"
    got, want = ([tuple(r) for r in f(spark, root).orderBy("path").collect()] for f in (list_in_tasks, list_files))
    # Spark's reader leaves out files without a byte
    assert [r for r in got if r[2]] == want and len(got) == 5 and len(want) == 4
    assert list_in_tasks(spark, str(tmp_path / "nothing")).count() == 0


def test_named_images_are_not_listed_by_the_driver(spark, monkeypatch):
    def refuse(*a, **b):
        raise AssertionError("all names go through the driver")

    monkeypatch.setattr(file_queries, "list_files", refuse)
    n = spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey").distinct().count()
    assert file_queries.q60_named_images(spark, DATA).count() == n
