"""Extraction as a stream of files. A batch is a chunk, published at once; a ledger in the table tells which batches are in.

A batch's rows are staged, then a version of the table names them together with the batch. A run that ends between the
two leaves the table as it was, and the batch is done again on restart; one that ends after it, before
the stream has noted the batch, finds the batch in the ledger and doesn't do it twice. Totals of each chunk stand
in the version too, so sums over all chunks are merged from one line for each, and a replaced chunk replaces its line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import age_group, age_group_label, cast_attributes, with_attr_defaults
from ..functions.classify import split_valid
from ..functions.paths import image_path
from ..operators.scoring import Scorer, score_images
from ..sources.versions import ChunkTable, Version


def save_batch(batch: DataFrame, batch_id: int, out: str, scorer: Callable[[], Scorer], source: str | None = None, before_publish: Callable[[Version], None] | None = None) -> None:
    """Score one batch of images and publish it as a chunk. Rows that fail are kept with saved false.

    A batch of ``source`` that the table has already is left alone; a new one is the chunk after the last. Without a source
    the chunk is batch_id + 1 and is replaced.
    """
    table = ChunkTable(batch.sparkSession, out)
    name, chunk = None, batch_id + 1
    if source is not None:
        name, now = f"{source}#{batch_id}", table.current()
        if name in now.batches:
            return
        chunk = max(now.chunks, default=0) + 1
    images = batch.select(image_path(F.col("image.origin")).alias("path"), (F.col("image.height") > 0).alias("readable"), "image")
    scored = score_images(images, scorer)
    marked = split_valid(scored, F.col("readable"), F.col("embedding").isNotNull())
    rows = cast_attributes(with_attr_defaults(marked).withColumn("age_group", age_group(F.col("age"))))
    rows = rows.select(F.col("path").alias("image_path"), "embedding", "age", "gender", "age_group", "saved", F.lit(chunk).cast("long").alias("chunk_id"))
    table.replace(rows, False, name, before_publish)


def stream_extract(spark: SparkSession, root: str, out: str, scorer: Callable[[], Scorer], checkpoint: str, files_per_chunk: int = 1000, before_publish: Callable[[Version], None] | None = None):
    """Start a query over the images under ``root`` that ends when all are done; files go by modification time.

    Started again with the same checkpoint after it failed, it goes on with the batch that failed. ``before_publish`` is called
    for each batch when its rows are staged, with the version that it will follow.
    """
    schema = spark.read.format("image").load(root).schema
    stream = spark.readStream.format("image").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_chunk).load(root)
    write = stream.writeStream.foreachBatch(lambda batch, batch_id: save_batch(batch, batch_id, out, scorer, checkpoint, before_publish))
    return write.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_summary(spark: SparkSession, out: str, version: int | None = None) -> dict[str, DataFrame]:
    """Totals and distributions, merged from the totals of the chunks of a version; the chunks' rows aren't read."""
    lines = ChunkTable(spark, out).lines(version)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    ages = lines.select(F.explode("ages").alias("a")).groupBy(F.col("a.age_group").alias("age_group")).agg(F.sum("a.n").alias("n"))
    one = lines.select(F.explode_outer("genders").alias("g"))
    of = lambda k: F.coalesce(F.sum(F.when(F.col("g.gender") == k, F.col("g.n"))), F.lit(0))
    return {
        "totals": lines.agg(total("source_images"), total("extracted"), total("failed")),
        "ages": ages.select("age_group", age_group_label(F.col("age_group")).alias("label"), "n"),
        "genders": one.agg(of(0).alias("female"), of(1).alias("male")),
    }
