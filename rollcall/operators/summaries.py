"""Summaries of jobs. Each is an aggregate; lists of identities are whole, with their count beside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import AGE_LABELS, age_group_label
from .chunks import with_position

# Fixed value: how identities came about.
SOURCE = "identity-conditioned synthetic variants"


#: Outcomes that a funnel counts.
OUTCOMES = ["success", "no_face", "low_conf", "blurry", "error"]


def funnel_metrics() -> dict[str, Column]:
    """Counts of a funnel by name, of rows with a column outcome."""
    return {"total": F.count(F.lit(1)), **{k: F.count_if(F.col("outcome") == k) for k in OUTCOMES}}


def _with_yield(counts: DataFrame) -> DataFrame:
    return counts.withColumn("yield_pct", F.round(F.try_divide(F.col("success") * 100.0, F.col("total").cast("double")), 6))


def preprocess_funnel(df: DataFrame) -> DataFrame:
    """Rows by outcome (column outcome) and the yield in percent, null without rows."""
    return _with_yield(df.agg(*(c.alias(name) for name, c in funnel_metrics().items())))


def funnel_of(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The funnel from counts that a write has taken."""
    return _with_yield(spark.createDataFrame([tuple(counts[k] for k in ("total", *OUTCOMES))], ", ".join(f"{k} long" for k in ("total", *OUTCOMES))))


def processed_records(df: DataFrame, out: str) -> DataFrame:
    """Rows that passed as records with their processed path; needs path, filename, processed_name and rounded metrics."""
    kept = df.where(F.col("outcome") == "success")
    return kept.select(F.col("path").alias("original_path"), F.concat(F.lit(out.rstrip("/") + "/"), "processed_name").alias("processed_path"), "filename", "confidence", "blur_score")


def stem_collisions(df: DataFrame, stem: str = "stem") -> DataFrame:
    """(stem, n): stems of several paths, which would share one processed name."""
    return df.groupBy(stem).agg(F.count("*").alias("n")).where("n > 1")


def sample_counts(listed: DataFrame, sampled: DataFrame) -> DataFrame:
    """One row: how many there were and how many were taken."""
    one = F.lit(1).alias("_one")
    return listed.agg(F.count("*").alias("n_listed")).select("*", one).join(sampled.agg(F.count("*").alias("n_sampled")).select("*", one), "_one").drop("_one")


def age_distribution(df: DataFrame, include_zero: bool = False) -> DataFrame:
    """(age_group, label, n), with ``include_zero`` for every label."""
    counts = df.groupBy(F.col("age_group").cast("int").alias("age_group")).agg(F.count("*").alias("n"))
    if include_zero:
        labels = df.sparkSession.createDataFrame([(k,) for k in AGE_LABELS], "age_group int")
        counts = labels.join(counts, "age_group", "left").select("age_group", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return counts.select("age_group", age_group_label(F.col("age_group")).alias("label"), "n")


def gender_distribution(df: DataFrame) -> DataFrame:
    """(female, male); unknown ones are in neither."""
    return df.agg(F.count_if(F.col("gender") == 0).alias("female"), F.count_if(F.col("gender") == 1).alias("male"))


def extraction_summary(df: DataFrame, total_input: int, n_chunks: int, dim: int = 512) -> DataFrame:
    """Totals, vector length (``dim`` if there is none) and both distributions as maps."""
    base = df.agg(F.lit(total_input).cast("long").alias("total_input"), F.count("*").alias("extracted"), (F.lit(total_input) - F.count("*")).cast("long").alias("failed"), F.coalesce(F.max(F.size("embedding")), F.lit(dim)).alias("embedding_dim"), F.lit(n_chunks).alias("chunks"))
    ages = age_distribution(df).agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("age_distribution"))
    genders = gender_distribution(df).select(F.create_map(F.lit("female"), "female", F.lit("male"), "male").alias("gender_distribution"))
    return base.withColumn("_one", F.lit(1)).join(ages.withColumn("_one", F.lit(1)), "_one").join(genders.withColumn("_one", F.lit(1)), "_one").drop("_one")


def extraction_of(lines: DataFrame, embedding_dim: int | None, dim: int = 512) -> DataFrame:
    """The same summary from the lines of a version of chunks and the vector length that its write has seen; no row of a chunk is read."""
    ages = lines.select(F.explode("ages").alias("a")).groupBy("a.age_group").agg(F.sum("a.n").alias("n"))
    ages = ages.agg(F.map_from_entries(F.collect_list(F.struct(age_group_label(F.col("age_group")).alias("label"), "n"))).alias("age_distribution"))
    of = lambda k: F.coalesce(F.sum(F.aggregate(F.filter("genders", lambda g: g["gender"] == k), F.lit(0).cast("long"), lambda s, g: s + g["n"])), F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias("total_input" if c == "source_images" else c)
    base = lines.agg(total("source_images"), total("extracted"), total("failed"), F.lit(embedding_dim or dim).alias("embedding_dim"), F.count(F.lit(1)).cast("int").alias("chunks"), F.create_map(F.lit("female"), of(0), F.lit("male"), of(1)).alias("gender_distribution"))
    return base.withColumn("_one", F.lit(1)).join(ages.withColumn("_one", F.lit(1)), "_one").select("total_input", "extracted", "failed", "embedding_dim", "chunks", "age_distribution", "gender_distribution")


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n")).orderBy("split")


def label_distribution(df: DataFrame, split: str = "retain") -> DataFrame:
    """(age_group, label, n) of a split, most frequent first."""
    counts = df.where(F.col("split") == split).groupBy(F.col("age_group").cast("int").alias("age_group")).agg(F.count("*").alias("n"))
    return counts.select("age_group", age_group_label(F.col("age_group"), unknown=False).alias("label"), "n").orderBy(F.desc("n"), "age_group")


def dataset_summary(dataset: DataFrame, ids: DataFrame, special: DataFrame, n_forget: int, key: str = "cluster_id") -> DataFrame:
    """One row. n_clusters counts all ids, also those that lost all their images; id lists are in rank order.

    Retained ids, which have no rank, are counted in n_retain; ``retained_parts`` lists them.
    """
    one = F.lit(1).alias("_one")
    sizes = split_sizes(dataset).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("split", "n")))).alias("split_sizes"))
    labels = label_distribution(dataset).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("label_distribution_retain"))
    total = dataset.agg(F.count("*").alias("total_images"))
    clusters = ids.agg(F.count("*").alias("n_clusters"))

    def ranked(split: str):
        rows = F.collect_list(F.when(F.col("split") == split, F.struct("hash_rank", key)))
        return F.transform(F.array_sort(rows), lambda x: x[key]).alias(f"{split}_clusters")

    known = special.agg(ranked("forget"), ranked("test"))
    retained = ids.join(special.select(key), key, "left_anti").agg(F.count("*").alias("n_retain"))
    out = total.select("*", F.lit(SOURCE).alias("identity_source"), F.lit(n_forget).alias("n_forget"), one)
    for part in (clusters, sizes, known, retained, labels):
        out = out.join(part.select("*", one), "_one")
    return out.drop("_one")


def retained_parts(ids: DataFrame, special: DataFrame, size: int = 10_000, key: str = "cluster_id") -> DataFrame:
    """(part, n_ids, clusters): all retained ids in order, ``size`` in each row, so that no row or task grows with their number."""
    placed = with_position(ids.join(special.select(key), key, "left_anti").select(key), key)
    return placed.groupBy(F.floor(F.col("position") / size).alias("part")).agg(F.count(F.lit(1)).alias("n_ids"), F.array_sort(F.collect_list(key)).alias("clusters"))
