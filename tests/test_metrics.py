"""Counts that writes take, against the same counts from what they wrote."""

from pyspark.sql import functions as F

from rollcall.operators import admission, summaries
from rollcall.operators.metrics import settle_with
from rollcall.sources import ChunkTable, read_chunks, write_chunks


def test_settle_counts_what_it_writes(spark):
    rows = spark.range(100).select((F.col("id") % 3 == 0).alias("valid"), F.element_at(F.array(*map(F.lit, summaries.OUTCOMES)), (F.col("id") % 5 + 1).cast("int")).alias("outcome")).repartition(7)
    for df in (rows, rows.where("false"), spark.createDataFrame([], "valid boolean, outcome string")):
        done, counts = settle_with(df, summaries.funnel_metrics() | admission.admission_metrics())
        assert done.count() == df.count()
        assert summaries.funnel_of(spark, counts).collect() == summaries.preprocess_funnel(df).collect()
        described = (3, 2, 0.4, 80.0, 42)
        assert admission.generation_of(spark, counts, *described).collect() == admission.generation_summary(df, *described).collect()


def test_extraction_summary_from_a_version(spark, tmp_path):
    rows = spark.range(50).select(F.col("id").cast("string").alias("image_path"), F.when(F.col("id") % 4 != 0, F.array(F.lit(1.0), F.lit(2.0))).alias("embedding"), (F.col("id") % 3 - 1).cast("tinyint").alias("gender"), (F.col("id") % 5 - 1).cast("tinyint").alias("age_group"), (F.col("id") % 4 != 0).alias("saved"), (F.col("id") % 6 + 1).alias("chunk_id"))
    path = str(tmp_path / "t")
    version = write_chunks(rows, path, {"dim": F.max(F.size("embedding"))})
    assert version.metrics == {"dim": 2}
    lines = ChunkTable(spark, path).lines()
    got, want = summaries.extraction_of(lines, version.metrics["dim"]).first().asDict(), summaries.extraction_summary(read_chunks(spark, path).where("saved"), 50, 6).first().asDict()
    assert got == want and got["failed"] == 13
    assert all("/versions/" in f for f in summaries.extraction_of(lines, 2).inputFiles())
    write_chunks(rows.where("not saved"), path)
    assert summaries.extraction_of(ChunkTable(spark, path).lines(), None).first()["embedding_dim"] == 512
