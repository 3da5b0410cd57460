import duckdb
import pytest
from pyspark.sql import functions as F

from rollcall.llm import mixing as M


def water(sizes: list[int]) -> list[float]:
    """Targets by literal re-sharing."""
    weights = [k % 3 + 1 for k in range(len(sizes))]
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(3 * sizes[k] for k in capped)
        open_ = sum(w for k, w in enumerate(weights) if k not in capped)
        share = [3 * sizes[k] if k in capped else left * weights[k] / open_ for k in range(len(sizes))]
        over = {k for k in range(len(sizes)) if k not in capped and share[k] > 3 * sizes[k] + 1e-9}
        if not over:
            return share
        capped |= over


def docs(spark):
    rows = []
    for k in range(400):
        source = ["big", "big", "big", "mid", "tiny", None, "é", "Z"][k % 8] if k % 50 else "lone"
        rows.append((k, ("word " * (k * 7 % 40)).strip() if k % 31 else None, source, "x", k))
    rows += [(1, rows[1][1], "big", "x", 1), (None, "a b c", "big", "x", 1), (900, "huge " * 3000, "tiny", "x", 1), (901, "", "empty", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, taken long")


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(M, "BIN_ROWS", 7)
    table = docs(spark)
    rows = M.mix(table).collect()
    assert len(rows) == table.count()
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    order = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    sizes = [by[s][0]["source_size"] for s in order]
    assert sizes == [sum(r["size"] for r in by[s]) for s in order]
    for s, want in zip(order, water(sizes), strict=True):
        assert by[s][0]["target"] == pytest.approx(want)
        largest = max(r["size"] for r in by[s])
        assert abs(sum(r["taken"] for r in by[s]) - want) <= largest / 2 + 1
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, rows)) == sorted(map(key, M.mix(table.repartition(5)).collect()))


def test_mix_equals_sql(spark):
    table = docs(spark).select("doc_id", "text", "source")
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    columns = ["doc_id", "size", "source_size", "taken", "epochs", "source"]
    want = sorted(map(repr, con.execute(f"SELECT {', '.join(columns)} FROM ({M.MIX_SQL})").fetchall()))
    assert sorted(repr(tuple(r)) for r in M.mix(table).select(columns).collect()) == want


def test_empty_and_zero(spark):
    table = docs(spark)
    assert M.mix(table.limit(0)).count() == 0
    rows = M.mix(table.withColumn("text", F.lit(" \t"))).collect()
    assert all((r["size"], r["taken"], r["target"]) == (0, 0, 0.0) for r in rows)


def test_better_documents_come_first_more_often(spark):
    rows = [(k, ("word " if k % 2 else "#### ") * 30, "s") for k in range(600)] + [(5000, "x " * 30000, "t"), (5001, "y " * 30000, "u")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = M.mix(table).where("source = 's'").groupBy((F.col("doc_id") % 2).alias("good")).agg(F.sum("taken").alias("n")).collect()
    n = {r["good"]: r["n"] for r in taken}
    assert n[1] > 1.15 * n[0]


def test_reruns_agree_with_null_ids_and_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "BIN_ROWS", 16)
    rows = [(None, f"word{k} and some more", "a") for k in range(300)] + [(None, "the same text again", "a")] * 300 + [(7, None, "a"), (7, None, "a"), (8, "x " * 3000, "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [sorted(map(str, M.mix(t).drop("target").collect())) for t in (table, table.orderBy(F.desc("text")).repartition(3), spark.createDataFrame(rows[::-1], table.schema).coalesce(1))]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    parts = M.with_copy_numbers(M.materialize(table.select("source", F.col("text").alias("row"), F.lit(1).alias("size"), F.spark_partition_id().alias("_part")).where("row is not null")))
    copies = [r["copy"] for r in parts.where("row = 'the same text again'").collect()]
    assert sorted(copies) == list(range(300))
