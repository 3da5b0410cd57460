"""First-K-valid admission: in trial order, rows up to the K-th valid one of each identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import settle


def admit_first_k(scored: DataFrame, k: int, valid: Column | None = None, identity: str = "identity_id", order: str = "trial") -> DataFrame:
    """Rows that are looked at: those with fewer than k valid rows before them. Adds valid and accepted_idx (null if rejected).

    One window by identity; trials of an identity are bounded by its plan, so no window grows with the data.
    """
    good = F.col("rejection_reason") == "accepted" if valid is None else valid
    before = Window.partitionBy(identity).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    marked = scored.withColumn("valid", good).withColumn("_before", F.coalesce(F.sum(F.col("valid").cast("int")).over(before), F.lit(0)))
    return marked.where(F.col("_before") < k).withColumn("accepted_idx", F.when(F.col("valid"), F.col("_before").cast("int"))).drop("_before")


#: Trials of a block that are counted together, and identities whose cut-offs may be sent to every task (12 bytes each).
BLOCK, MOST_CUTS = 16, 200_000


def cut_offs(marked: DataFrame, k: int, identity: str = "identity_id", order: str = "trial", block: int = BLOCK) -> DataFrame:
    """(identity, last_block): the block of trials in which an identity gets its k-th valid row, or its last block.

    Counts by block come from partial sums, so only one narrow row for each identity and block is shuffled.
    """
    counts = marked.groupBy(identity, F.floor(F.col(order) / block).alias("_block")).agg(F.count_if("valid").alias("_n"))
    before = Window.partitionBy(identity).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    open_ = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < k)
    return open_.groupBy(identity).agg(F.max("_block").alias("last_block"))


def admit_in_two(scored: DataFrame, k: int, valid: Column | None = None, identity: str = "identity_id", order: str = "trial", block: int = BLOCK) -> DataFrame:
    """The rows of ``admit_first_k``, for wide rows of which most come after the k-th valid one: these are left out before the shuffle.

    ``order`` is a number. Cut-offs of up to MOST_CUTS identities are broadcast; those of more are joined by a
    shuffle, which the window then uses. ``scored`` is read twice: settle it first if it is costly.
    """
    good = F.col("rejection_reason") == "accepted" if valid is None else valid
    marked = scored.withColumn("valid", good)
    cuts = settle(cut_offs(marked, k, identity, order, block).withColumnRenamed(identity, "_identity"))
    small = F.broadcast(cuts) if cuts.count() <= MOST_CUTS else cuts
    near = marked.join(small, F.col(identity).eqNullSafe(F.col("_identity"))).where(F.floor(F.col(order) / block) <= F.col("last_block"))
    return admit_first_k(near.drop("_identity", "last_block"), k, F.col("valid"), identity, order)


def accepted_only(scored: DataFrame, k: int, valid: Column | None = None, identity: str = "identity_id", order: str = "trial") -> DataFrame:
    """The accepted rows alone: filtered first, so that the window keeps k rows of each identity before the shuffle."""
    good = F.col("rejection_reason") == "accepted" if valid is None else valid
    place = F.row_number().over(Window.partitionBy(identity).orderBy(order))
    return scored.where(good).withColumn("accepted_idx", place - 1).where(F.col("accepted_idx") < k)


def split_admission(admitted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Settle or persist ``admitted`` before both are written."""
    return admitted.where("valid").withColumn("cluster_id", F.col("identity_id")), admitted.where("not valid").drop("accepted_idx")


def rejection_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("identity_id", "rejection_reason").agg(F.count("*").alias("n"))


def rejection_maps(rejected: DataFrame) -> DataFrame:
    """(identity_id, reasons): a map of at most nine reasons."""
    entries = F.array_sort(F.collect_list(F.struct("rejection_reason", "n")))
    return rejection_counts(rejected).groupBy("identity_id").agg(F.map_from_entries(entries).alias("reasons"))


def shortfalls(plan: DataFrame, admitted: DataFrame, k: int) -> DataFrame:
    """(identity_id, accepted) of planned identities with fewer than k; those without any row are there too."""
    counts = admitted.groupBy("identity_id").agg(F.count_if("valid").alias("accepted"))
    planned = plan.select("identity_id").distinct()
    return planned.join(counts, "identity_id", "left").select("identity_id", F.coalesce("accepted", F.lit(0)).cast("long").alias("accepted")).where(F.col("accepted") < k)


def require_filled(plan: DataFrame, admitted: DataFrame, k: int) -> None:
    """One error that tells how many identities fall short, with the first of them and their reasons."""
    short = shortfalls(plan, admitted, k)
    n = short.count()
    if n:
        reasons = short.join(rejection_maps(admitted.where("not valid")), "identity_id", "left").orderBy("identity_id").limit(20).collect()
        listed = "; ".join(f"{r['identity_id']}: {r['accepted']} of {k}, {r['reasons'] or {}}" for r in reasons)
        raise ValueError(f"{n} identities have fewer than {k} valid candidates: {listed}")


def admission_metrics() -> dict[str, Column]:
    """Counts of admitted rows by name."""
    return {"accepted": F.count_if("valid"), "rejected": F.count_if(~F.col("valid"))}


def generation_summary(admitted: DataFrame, n_identities: int, k: int, min_similarity: float, blur_threshold: float, seed: int) -> DataFrame:
    counts = admitted.agg(*(c.alias(name) for name, c in admission_metrics().items()))
    return _described(counts, n_identities, k, min_similarity, blur_threshold, seed)


def generation_of(spark: SparkSession, counts: dict[str, int], n_identities: int, k: int, min_similarity: float, blur_threshold: float, seed: int) -> DataFrame:
    """The same summary from counts that a write has taken."""
    return _described(spark.createDataFrame([(counts["accepted"], counts["rejected"])], "accepted long, rejected long"), n_identities, k, min_similarity, blur_threshold, seed)


def _described(counts: DataFrame, n_identities: int, k: int, min_similarity: float, blur_threshold: float, seed: int) -> DataFrame:
    before = [F.lit(n_identities).alias("n_identities"), F.lit(k).alias("images_per_identity")]
    after = [F.lit(min_similarity).alias("min_similarity"), F.lit(blur_threshold).alias("blur_threshold"), F.lit(seed).alias("seed")]
    return counts.select(*before, "accepted", "rejected", *after)
