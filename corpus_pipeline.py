"""A corpus pipeline over documents: language, repeated lines, near copies, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and returns documents, the last one with what the mix takes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import documents, materialize
from rollcall.llm.decontaminate import contamination
from rollcall.llm.language_id import UNKNOWN, identify, train
from rollcall.llm.line_dedup import dedupe_lines
from rollcall.llm.mixing import mix
from rollcall.llm.near_copies import near_copy_groups

#: Documents go whose language is predicted with less than this part of the way from an even guess to certainty.
LEAST_CLEAR = 0.05


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``docs`` has."""
    out = []
    for name in names:
        while name.lower() in {c.lower() for c in docs.columns}:
            name = "_" + name
        out.append(name)
    return out


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or without a clear language, null and empty texts among them. The network learns from ``docs`` itself.

    Without any label nothing has a clear language. Repeated rows and null ids are judged like others, long texts whole; an empty table stays empty.
    """
    pred, score = _free(docs, "lang_pred", "lang_score")
    net = train(docs)
    found = identify(docs, net, pred=pred, score_name=score)
    even = 1 / max(2, len(net.classes) if net else 2)
    return found.where((F.col(pred) != UNKNOWN) & (F.col(score) >= even + LEAST_CLEAR * (1 - even))).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes blocks of lines that an earlier document has; a document of which nothing but white space is left goes.

    Null texts and rows with a null id stay as they are; rows equal in id and text lose the same lines. n_chars follows the text where it
    changed. Columns n_lines and n_removed of the user stay. An empty table stays empty.
    """
    own = [c for c in docs.columns if c.lower() in ("n_lines", "n_removed")]
    names = dict(zip(own, _free(docs, *(f"_{c}" for c in own)), strict=True))
    found = dedupe_lines(docs.withColumnsRenamed(names), every=True)
    found = found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.drop("n_lines", "n_removed").withColumnsRenamed({new: old for old, new in names.items()}).select(docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one with the least doc_id, and of equal ids the least text hash.

    Copies are texts whose 5-word shingles have similarity 0.8 or more, found by the SimHash index and, further
    apart, by MinHash. Of rows equal in both, one stays, the least by its columns as JSON. A row with a null id stays only if
    no row of its group has an id. Texts without words, null ones among them, are copies of each other. An empty table stays empty.
    """
    groups = materialize(near_copy_groups(docs))
    own, h = _free(docs, "own_id", "own_hash")
    chosen = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one"))
    chosen = materialize(chosen.select(F.col("one.doc_id").alias(own), F.col("one.text_hash").alias(h)))
    kept = docs.join(chosen.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col(own)) & F.xxhash64(docs["text"]).eqNullSafe(F.col(h)), "left_semi")
    first = groups.join(chosen, groups["doc_id"].eqNullSafe(F.col(own)) & (F.col("text_hash") == F.col(h)), "left_semi")
    repeated = not first.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    if not repeated:
        return kept
    row = F.struct(*docs.columns)
    return kept.groupBy(F.col("doc_id").alias(own), F.xxhash64("text").alias(h)).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item. Null and empty texts hold none; an empty table stays empty."""
    rows = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    found = contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text="_text", key="_row")
    return found.where(~F.col("contaminated")).select(*(F.col("_row")[c].alias(c) for c in docs.columns))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken (taken) and how often each is read (copies), in place of columns of these names.

    Documents without words, null texts among them, have nothing to take and go; a null source is a source. An empty table stays empty.
    """
    own, h, words, size = _free(docs, "own_id", "own_hash", "own_taken", "own_size")
    taken = mix(docs).where("taken > 0").groupBy("doc_id", "text_hash").agg(F.max("taken").alias("taken"), F.max("size").alias("size"))
    taken = materialize(taken).select(F.col("doc_id").alias(own), F.col("text_hash").alias(h), F.col("taken").alias(words), F.col("size").alias(size))
    joined = docs.join(taken.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(docs["text"]) == F.col(h)))
    left = [c for c in docs.columns if c not in ("taken", "copies")]
    return joined.select(*(docs[c] for c in left), F.col(words).alias("taken"), F.expr(f"`{words}` div `{size}`").alias("copies"))


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near_copies", near_copy_stage),
    ("benchmark_leaks", leak_stage),
    ("mix", mix_stage),
]

#: SQL can express neither the network nor the fingerprints' hash.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
