"""Job queries do the whole table, whatever its size."""

from dataclasses import dataclass

from rollcall import file_queries
from rollcall.plans import Settings

DATA = "/root/testdata/sf0.001"


@dataclass(frozen=True)
class Capped(Settings):
    """Settings whose cap is below the number of suppliers, as the given one is on larger tables."""

    max_images: int | None = 3


def suppliers(spark):
    n = spark.read.parquet(f"{DATA}/supplier.parquet").count()
    assert n > 3
    return n


def test_all_suppliers_are_preprocessed(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "Settings", Capped)
    assert file_queries.q53_job_preprocess(spark, DATA).count() == suppliers(spark)


def test_all_suppliers_are_in_the_funnel(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "Settings", Capped)
    found = {r["filename"]: r for r in file_queries.q68_preprocess_records(spark, DATA).collect()}
    assert int(found["summary"]["original"]) == suppliers(spark)
