"""The five steps as jobs. Each step reads what the one before has written, unless that ran in the same call, so each can be run again alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import age_group, cast_attributes, with_attr_defaults
from ..functions.classify import classify_candidate, classify_preprocess, drop_unknown, split_valid
from ..functions.paths import round_metrics, with_output_paths, with_path_parts
from ..operators.admission import admission_metrics, admit_first_k, generation_of, require_filled, split_admission
from ..operators.candidates import attach_seed, attach_style, plan_candidates, seed_vectors, with_similarity_in_blocks
from ..operators.chunks import assign_chunks, chunk_manifest
from ..operators.joins import join_one_to_one, require_plan
from ..operators.metrics import settle_with
from ..operators.sampling import sample_cap, split_pools
from ..operators.scoring import Scorer, score_images
from ..operators.splits import apply_split, distinct_ids, special_ids
from ..operators.summaries import dataset_summary, extraction_of, funnel_metrics, funnel_of, processed_records, retained_parts
from ..schemas import PROCESSED
from ..sources.images import Decoder, decode_png, read_named
from ..sources.readers import filter_images, list_files, read_chunks, read_images, read_manifest
from ..sources.versions import ChunkTable
from ..sources.writers import write_chunks, write_dataset, write_manifests, write_records, write_summary
from ..storage import settle


#: Name patterns of images that need Spark's own decoder where the workers have none.
OTHER_KINDS = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[wW][eE][bB][pP]}"
#: What stands for a verdict where a planned candidate has no file.
NOT_MADE = "not_made"
#: Bytes that a file counts for when work is dealt out and its length isn't known.
UNKNOWN_LENGTH = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Parameters of all steps."""

    raw: str
    out: str
    scorer: Callable[[], Scorer]
    n_identities: int = 400
    images_per_identity: int = 40
    candidates_per_identity: int = 70
    n_forget: int = 40
    n_test: int = 60
    ids_per_step: int = 1
    max_images: int | None = 30_000
    conf_threshold: float = 0.85
    crop_blur_threshold: float = 80.0
    blur_threshold: float = 80.0
    min_similarity: float = 0.45
    chunk_size: int = 10_000
    seed: int = 42
    strict: bool = True
    decode: Decoder | None = None
    steps: dict[str, bool] = field(default_factory=dict)


def _images(spark: SparkSession, files: DataFrame, root: str, decode: Decoder | None) -> DataFrame:
    """(path, readable, image) of the given files (path, perhaps length), all of them below ``root``; one that isn't there ends the job.

    Only the named files are opened. Without a decoder the workers read PNG; other kinds then come
    from Spark's image source, which decodes all of these kinds below ``root``.
    """
    length = F.col("length") if "length" in files.columns else F.lit(None).cast("long")
    named = files.select("path", F.coalesce(length, F.lit(UNKNOWN_LENGTH)).alias("length"))
    if decode is not None:
        return read_named(named, decode)
    png = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)) == "png"
    found, others = read_named(named.where(png), decode_png), named.where(~png).select("path")
    if others.isEmpty():
        return found
    joined = others.join(read_images(spark, root, pattern=OTHER_KINDS), "path", "left")
    there = F.coalesce("readable", F.raise_error(F.concat(F.lit("no such image: "), "path")).cast("boolean"))
    return found.unionByName(joined.select("path", there.alias("readable"), "image"))


def _scored(spark: SparkSession, files: DataFrame, s: Settings, root: str) -> DataFrame:
    """Scores and sharpness of the given images, from one pass over their pixels."""
    return score_images(_images(spark, files, root, s.decode), s.scorer, sharp=True)


def preprocess(spark: SparkSession, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(outcome of every image, funnel). Names are sampled before anything is decoded."""
    names = sample_cap(list_files(spark, s.raw, preset="raw"), s.max_images, s.seed)
    scored = _scored(spark, settle(names), s, s.raw)
    face = F.when(F.col("embedding").isNotNull(), F.coalesce("confidence", F.lit(1.0)))
    broken = F.when(~F.col("readable"), F.lit("unreadable")).otherwise(F.col("error"))
    outcome = classify_preprocess(face, F.col("laplacian_variance"), s.conf_threshold, s.crop_blur_threshold, broken)
    marked = with_path_parts(scored).withColumn("outcome", outcome).withColumnRenamed("laplacian_variance", "blur_score")
    marked, counts = settle_with(round_metrics(marked), funnel_metrics())
    return marked, funnel_of(spark, counts)


def generate(plan: DataFrame, scored: DataFrame, seeds: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(accepted, rejected, summary) from the plan, scored candidates (identity_id, trial, embedding, blur, age, gender, readable) and seeds with embeddings.

    A planned candidate without scores wasn't made. That is an error if its identity still lacks images when its trial comes; trials after
    the last image of an identity need not be there.
    """
    require_plan(candidates=s.candidates_per_identity, images=s.images_per_identity)
    vectors = seed_vectors(seeds, s.strict)
    joined = with_similarity_in_blocks(attach_seed(plan.join(scored.withColumn("_made", F.lit(True)), ["identity_id", "trial"], "left"), vectors))
    verdict = classify_candidate(F.col("embedding").isNotNull(), F.col("norm"), F.col("arcface_similarity"), F.col("laplacian_variance"), s.min_similarity, s.blur_threshold, F.coalesce("readable", F.lit(True)))
    judged = joined.withColumn("rejection_reason", F.when(F.col("_made"), verdict).otherwise(NOT_MADE)).drop("_made").withColumnRenamed("age", "detected_age").withColumnRenamed("gender", "detected_gender")
    admitted = with_output_paths(admit_first_k(judged, s.images_per_identity), s.out).drop("seed_unit", "embedding")
    admitted, counts = settle_with(admitted, admission_metrics() | {NOT_MADE: F.count_if(F.col("rejection_reason") == NOT_MADE)})
    if counts[NOT_MADE]:
        _tell_not_made(admitted, counts[NOT_MADE])
    if s.strict:
        require_filled(plan, admitted, s.images_per_identity)
    accepted, rejected = split_admission(admitted)
    return accepted, rejected, generation_of(plan.sparkSession, counts, s.n_identities, s.images_per_identity, s.min_similarity, s.blur_threshold, s.seed)


def _tell_not_made(admitted: DataFrame, n: int) -> None:
    lost = admitted.where(F.col("rejection_reason") == NOT_MADE).select("identity_id", "trial").orderBy("identity_id", "trial").limit(5)
    raise ValueError(f"{n} planned candidates weren't made, identity/trial {', '.join(f'{i}/{t}' for i, t in lost.collect())} among them")


def plan_generation(pool: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(plan, seeds): which seed and style make which candidate."""
    require_plan(sources=pool.limit(2 * s.n_identities).count(), identities=s.n_identities)
    seeds, styles = split_pools(pool, s.n_identities, s.seed)
    seeds = settle(seeds.select("identity_id", F.col("path").alias("seed_path")))
    styles = settle(styles.select("style_idx", F.col("path").alias("style_path")))
    plan = attach_style(plan_candidates(seeds, s.candidates_per_identity, s.seed), styles, s.candidates_per_identity)
    return settle(plan.drop("style_idx")), seeds


def extract(spark: SparkSession, paths: DataFrame, root: str, out: str, s: Settings, preset: str = "extract", order: tuple[str, ...] = ("path",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(attributes, chunk manifest, summary) of the images ``paths`` (below ``root``), written chunk by chunk to ``out``.

    Chunks follow the columns ``order``; names with numbers of different lengths don't sort as the numbers do.
    Images that fail are written too, with saved false: a rerun replaces every chunk, also one that holds nothing else.
    """
    chosen = filter_images(paths, preset).select("path", *(c for c in order if c != "path"))
    names = settle(assign_chunks(chosen, s.chunk_size, *order).select("path", "position", "chunk_id"))
    scored = settle(names.join(_scored(spark, names.select("path"), s, root), "path", "left"))
    marked = split_valid(scored, F.col("readable"), F.col("embedding").isNotNull())
    rows = cast_attributes(with_attr_defaults(marked).withColumn("age_group", age_group(F.col("age"))))
    version = write_chunks(rows.select(F.col("path").alias("image_path"), "embedding", "age", "gender", "age_group", "saved", "chunk_id"), out, {"dim": F.max(F.size("embedding"))})
    manifest = settle(chunk_manifest(marked, F.col("saved")))
    attributes = read_chunks(spark, out).where("saved").drop("saved")
    # totals by chunk stand in the version, the vectors' length comes from the write
    return attributes, manifest, extraction_of(ChunkTable(spark, out).lines(version.number), max(0, version.metrics["dim"] or 0))


def build_dataset(manifest: DataFrame, attributes: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dataset, summary, parts of the list of retained ids). Splits are assigned to all identities first; images of unknown age go after that."""
    left = manifest.select("image_path", "cluster_id")
    right = attributes.select("image_path", "age_group")
    joined = settle(join_one_to_one(left, right, "image_path", complete=True))
    ids = settle(distinct_ids(joined))
    special = settle(special_ids(ids, s.n_forget, s.n_test, s.seed, per_step=s.ids_per_step))
    dataset = settle(drop_unknown(apply_split(joined, special)).select("image_path", "cluster_id", "age_group", "split", "forget_step"))
    return dataset, dataset_summary(dataset, ids, special, s.n_forget), retained_parts(ids, special)


def run(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    """All steps that ``s.steps`` doesn't switch off. Candidates are expected where the plan puts them, made by any generator."""
    require_plan(identities=s.n_identities, n_forget=s.n_forget, n_test=s.n_test)
    on = {"preprocess": True, "generate": True, "extract": True, "build": True} | s.steps
    made: dict[str, DataFrame] = {}
    if on["preprocess"]:
        made["outcomes"], made["funnel"] = preprocess(spark, s)
        write_records(processed_records(made["outcomes"], f"{s.out}/processed"), f"{s.out}/preprocess_records")
        write_summary(made["funnel"], f"{s.out}/preprocess_summary")
    if on["generate"]:
        pool = _written(lambda: spark.read.schema(PROCESSED).json(f"{s.out}/preprocess_records"))
        pool = list_files(spark, s.raw, preset="pool").select("path") if pool is None else pool.select(F.col("original_path").alias("path"))
        plan, seeds = plan_generation(pool, s)
        plan = with_output_paths(plan, s.out)
        found = list_files(spark, f"{s.out}/_candidates", preset="pool").join(plan.select(F.col("candidate_path").alias("path")), "path", "left_semi")
        candidates = settle(_scored(spark, settle(found), s, f"{s.out}/_candidates"))
        scored = plan.select("identity_id", "trial", F.col("candidate_path").alias("path")).join(candidates, "path").drop("path", "confidence", "error")
        seed_scores = _scored(spark, seeds.select(F.col("seed_path").alias("path")), s, s.raw)
        vectors = seeds.join(seed_scores.select(F.col("path").alias("seed_path"), "embedding"), "seed_path", "left")
        made["accepted"], made["rejected"], summary = generate(plan.select("identity_id", "trial", "generation_seed", "seed_path", "style_path"), scored, vectors, s)
        write_manifests(made["accepted"], made["rejected"], s.out)
        write_summary(summary, f"{s.out}/generation_summary")
    if on["extract"]:
        # files stay where they are: an accepted image is known by its candidate's path
        accepted = _required(lambda: read_manifest(spark, f"{s.out}/identity_manifest"), "extract", "generate").select(F.col("candidate_path").alias("path"), "identity_id", "trial")
        made["attributes"], made["chunks"], summary = extract(spark, accepted, f"{s.out}/_candidates", f"{s.out}/attributes", s, order=("identity_id", "trial"))
        write_summary(summary, f"{s.out}/extraction_summary")
    if on["build"]:
        manifest = _required(lambda: read_manifest(spark, f"{s.out}/identity_manifest"), "build", "generate").select("image_path", "candidate_path", "cluster_id")
        attributes = _required(lambda: read_chunks(spark, f"{s.out}/attributes"), "build", "extract").where("saved").withColumnRenamed("image_path", "candidate_path")
        attributes = attributes.join(manifest.select("candidate_path", "image_path"), "candidate_path").drop("candidate_path")
        made["dataset"], made["summary"], made["retained"] = build_dataset(manifest, attributes, s)
        write_dataset(made["dataset"], f"{s.out}/dataset")
        write_summary(made["summary"], f"{s.out}/dataset_summary")
        write_records(made["retained"], f"{s.out}/dataset_retained")
    return made


def _written(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What an earlier step wrote, None if it didn't."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _required(read: Callable[[], DataFrame], step: str, before: str) -> DataFrame:
    found = _written(read)
    if found is None:
        raise ValueError(f"step {step} needs what step {before} writes")
    return found
