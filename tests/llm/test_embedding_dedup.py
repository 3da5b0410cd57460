import numpy as np
import pytest

from rollcall.llm.embedding_dedup import close, embedding_components


def brute(rows, threshold=0.95):
    n = len(rows)
    vectors = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        vectors.append(np.array(v, np.float32).astype(float) if ok else None)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            a, b = vectors[i], vectors[j]
            if i != j and a is not None and b is not None and len(a) == len(b):
                link[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold
    label = list(range(n))
    for _ in range(n):
        for i in range(n):
            for j in np.flatnonzero(link[i]):
                label[i] = label[j] = min(label[i], label[j])
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[label[i]] = min(least.get(label[i], 1 << 60), rows[i][0])
    return sorted((rows[i][0] if rows[i][0] is not None else -1, int(link[i].sum()), least.get(label[i], -1)) for i in range(n))


@pytest.mark.parametrize("tile", [4096, 16])
def test_equals_brute_force(spark, tile):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(25, 32))
    near = np.repeat(base[:10], 4, 0) + rng.normal(scale=0.15, size=(40, 32))
    rows = [[int(k), [float(x) for x in np.float32(v)]] for k, v in enumerate(np.concatenate([base, near]))]
    rows += [[200, rows[0][1]], [201, rows[0][1]], [202, [2 * x for x in rows[0][1]]], [203, None], [204, [0.0] * 32], [205, [float("nan")] * 32], [206, [None] * 32], [207, []], [208, [1.0, 0.0]], [209, [1.0, 0.1]], [210, [float("inf")] * 32], [None, rows[3][1]]]
    rows.append([200, rows[0][1]])
    rng.shuffle(rows)
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<float>, n_links int, c int")
    got = embedding_components(df, tile=tile).collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"], r["component_id"] if r["component_id"] is not None else -1) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_early_stop_loses_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 40)) * np.linspace(2, 0.2, 40)
    x = np.concatenate([x, x[:100] + rng.normal(scale=0.1, size=(100, 40))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = close(x, x, True, 0.9, 4)
    want = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    assert set(zip(*map(list, want), strict=True)) <= set(zip(i.tolist(), j.tolist(), strict=True))


def test_empty_and_unusable(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embedding_components(df).orderBy("vec_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]
    assert embedding_components(df.limit(0)).count() == 0


def test_equal_first_coordinates_fill_several_tiles(spark):
    rows = [(k, [3.0] + [0.3 * (k == j) for j in range(40)]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in embedding_components(df, tile=16).collect())
    assert got == [(k, 39, 0, k == 0) for k in range(40)]


def test_tiles_of_near_copies_are_compared_in_bounded_pieces(monkeypatch):
    """Two tiles all of whose 360,000 pairs link: no piece holds more than the given number of pairs."""
    from rollcall.llm import embedding_dedup as module

    rng = np.random.default_rng(8)
    base = rng.normal(size=64)
    tiles = [{"ids": np.arange(600) + 600 * k, "many": np.ones(600, np.int64), "raw": np.float32(base + rng.normal(scale=0.05, size=(600, 64))).ravel()} for k in range(2)]
    monkeypatch.setattr(module, "PAIR_CELLS", 64 * 1000)
    seen = []
    whole = module.close_blocks
    monkeypatch.setattr(module, "close_blocks", lambda *a: (seen.append(len(b[0])) or b for b in whole(*a)))
    found = module._pair_links(tiles, np.eye(64), 0.95).to_pylist()
    assert max(seen) <= 1000 and sum(seen) >= 360_000
    assert len(found) == 1200 and all(r["n"] == 600 for r in found) and sum(r["other"] is None for r in found) == 1
