"""Chunks of an extraction follow the order that is asked for."""

from rollcall.operators.scoring import stub_scorer
from rollcall.plans import Settings
from rollcall.plans.jobs import extract
from tests.pngs import png

import numpy as np


def test_chunks_follow_numbers_not_names(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = []
    for i in (2, 999, 1000, 1001):
        path = tmp_path / f"{i:03d}_000.png"
        path.write_bytes(png(rng.integers(0, 255, (4, 4, 3))))
        rows.append((str(path), i, 0))
    paths = spark.createDataFrame(rows, "path string, identity_id int, trial int")
    s = Settings(raw="", out="", scorer=stub_scorer(), chunk_size=2)
    found, _, _ = extract(spark, paths, str(tmp_path), str(tmp_path / "out"), s, order=("identity_id", "trial"))
    chunk = {int(r["image_path"].rsplit("/", 1)[1].split("_")[0]): r["chunk_id"] for r in found.collect()}
    assert chunk == {2: 1, 999: 1, 1000: 2, 1001: 2}
