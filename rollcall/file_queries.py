"""Queries whose inputs are files: images, manifests, chunks and summaries that Spark derives from the given tables.

Files go to the shared folder and are read back, so readers, writers, scoring, the stream and the jobs all run. An
image has 4 x 4 pixels of three bytes, from the MD5 of its name; the same in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import SparkRuntimeException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.attributes import age_group, cast_attributes, with_attr_defaults
from .functions.classify import split_valid
from .functions.imaging import encode_png, laplacian_variance
from .functions.paths import round_metrics
from .operators.admission import admit_first_k, admit_in_two, split_admission
from .operators.candidates import attach_seed, attach_style, plan_candidates, seed_vectors, with_similarity, with_similarity_in_blocks
from .operators.chunks import assign_chunks
from .operators.joins import join_one_to_one, require_complete, require_plan
from .operators.scoring import Scorer, batched, score_images, stub_scorer
from .operators.splits import apply_split, distinct_ids, special_ids
from .operators.summaries import extraction_of
from .plans import Settings, jobs
from .queries import _CAND, _DATA, _GROUP, _OUTCOME, _query, _table, attributes, judged, q06_funnel, q19_dataset
from .schemas import CANDIDATES, PROCESSED
from .sources import PRESETS, ChunkTable, count_images, filter_images, list_files, list_in_tasks, newest_new_file, read_attributes, read_chunks, read_images, read_json_doc, read_manifest, read_named, save_snapshot, write_attributes, write_chunk, write_chunks, write_dataset, write_files, write_manifests, write_summary
from .storage import settle, shared_dir
from .streaming import stream_extract, stream_summary

_SIDE = 4


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/steps/{spark.sparkContext.applicationId}/files-{uuid.uuid4().hex}"


def _pixels(name: Column) -> Column:
    """48 bytes of a name, the pixels of its image row by row, blue first."""
    return F.unhex(F.concat(*(F.md5(F.concat(name, F.lit(f":{k}"))) for k in range(3))))


def _images(names: DataFrame, black: Column | None = None) -> DataFrame:
    """(path, readable, image) of a column path, without files; all black where ``black`` says so."""
    data = _pixels(F.col("path"))
    if black is not None:
        data = F.when(black, F.unhex(F.repeat(F.lit("00"), 3 * _SIDE * _SIDE))).otherwise(data)
    return names.select("path", F.lit(True).alias("readable"), F.struct(F.col("path").alias("origin"), F.lit(_SIDE).alias("height"), F.lit(_SIDE).alias("width"), F.lit(3).alias("nChannels"), F.lit(16).alias("mode"), data.alias("data")).alias("image"))


def _write_images(names: DataFrame, root: str) -> DataFrame:
    """Files of a column name: PNGs of its pixels (of column drawn, if there is one), or, where column broken is true, of no image at all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            made = [b"broken" if bad else encode_png(np.frombuffer(data, np.uint8).reshape(_SIDE, _SIDE, 3)) for data, bad in zip(b["data"], b["broken"], strict=True)]
            yield pd.DataFrame({"name": b["name"], "content": made})

    shown = F.col("drawn") if "drawn" in names.columns else F.regexp_replace("name", r"^.*/", "")
    drawn = names.select("name", F.coalesce("broken", F.lit(False)).alias("broken"), _pixels(shown).alias("data"))
    return write_files(drawn.mapInPandas(run, "name string, content binary"), root)


def _drawn(names: str) -> str:
    """SQL tables: px (name, p: pixels), lap (name, sharp), score (name, vector, age, gender, confidence) of the names that ``names`` selects."""
    at = "CAST('0x' || substr(md5(name || ':' || (i // 16)), 2 * (i % 16) + 1, 2) AS INTEGER)"
    near = lambda k: f"CASE WHEN {k} < 0 THEN -({k}) WHEN {k} > 3 THEN 6 - ({k}) ELSE {k} END"
    cell = lambda y, x: f"g[({near(y)}) * 4 + ({near(x)}) + 1]"
    around = " + ".join(cell(y, x) for y, x in (("j // 4 - 1", "j % 4"), ("j // 4 + 1", "j % 4"), ("j // 4", "j % 4 - 1"), ("j // 4", "j % 4 + 1")))
    return f"""
px AS (SELECT name, list_transform(range(48), lambda i: {at}) AS p FROM ({names}) n),
gray AS (SELECT name, p, list_transform(range(16), lambda j: CAST((p[3 * j + 1] * 114 + p[3 * j + 2] * 587 + p[3 * j + 3] * 299 + 500) // 1000 AS DOUBLE)) AS g FROM px),
laps AS (SELECT name, p, list_transform(range(16), lambda j: {around} - 4 * g[j + 1]) AS l FROM gray),
lap AS (SELECT name, p, list_avg(list_transform(l, lambda x: x * x)) - list_avg(l) * list_avg(l) AS sharp FROM laps),
score AS (SELECT name, sharp, list_transform(range(8), lambda j: list_avg(p[6 * j + 1 : 6 * j + 6])) AS vector, CAST(floor(list_avg(p)) AS INTEGER) % 90 AS age, 0 AS gender, list_max(p) / CAST(255 AS DOUBLE) AS confidence FROM lap)"""


_EVENT_NAMES = "SELECT 'event ' || event_id AS name, event_id FROM events"


@_query(f"WITH {_drawn(_EVENT_NAMES)} SELECT name, round(sharp, 3) AS sharpness FROM lap")
def q37_sharpness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gray values and variance of the Laplacian of an image for each event."""
    names = _table(spark, sf_dir, "events").select(F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("path"))
    return laplacian_variance(_images(names)).select(F.col("path").alias("name"), F.round("laplacian_variance", 3).alias("sharpness"))


@_query(f"WITH {_drawn(_EVENT_NAMES)} SELECT name, round(vector[1], 2) AS first, round(vector[8], 2) AS last, age, gender, round(confidence, 4) AS confidence, round(sharp, 3) AS sharpness, CAST(NULL AS VARCHAR) AS error FROM score")
def q38_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the same images by a model that is loaded once in each task, with sharpness from the same pass."""
    names = _table(spark, sf_dir, "events").select(F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("path"))
    got = score_images(_images(names), stub_scorer(), sharp=True)
    vector = F.col("embedding")
    return got.select(F.col("path").alias("name"), F.round(vector[0].cast("double"), 2).alias("first"), F.round(vector[7].cast("double"), 2).alias("last"), "age", "gender", F.round("confidence", 4).alias("confidence"), F.round("laplacian_variance", 3).alias("sharpness"), "error")


def _picky_scorer() -> Scorer:
    """The stub's scores, but a call with an image whose first byte is 240 or more fails as a whole."""
    score = stub_scorer()()

    @batched
    def picky(stack: np.ndarray) -> list[dict | None]:
        if (stack[:, 0, 0, 0] >= 240).any():
            raise RuntimeError("too blue")
        return score(stack)

    return picky


@_query(f"""WITH {_drawn(_EVENT_NAMES)}, n AS ({_EVENT_NAMES}), kind AS (SELECT name, CASE WHEN event_type = 'error' THEN 'no_face' WHEN p[1] >= 240 THEN 'failed' ELSE 'scored' END AS kind FROM n JOIN events USING (event_id) JOIN px USING (name))
SELECT name, kind, CASE WHEN kind = 'scored' THEN round(vector[1], 2) END AS first, CASE WHEN kind = 'scored' THEN age END AS age, CASE WHEN kind = 'scored' THEN round(confidence, 4) END AS confidence,
  CASE WHEN kind = 'no_face' THEN 0 ELSE round(sharp, 3) END AS sharpness, CASE WHEN kind = 'failed' THEN 'RuntimeError: too blue' END AS error FROM score JOIN kind USING (name)""")
def q59_failing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of errors are black and have no face; a model that fails on a call loses only the images that make it fail."""
    names = _table(spark, sf_dir, "events").select(F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("path"), "event_type")
    got = score_images(_images(names, F.col("event_type") == "error"), _picky_scorer, sharp=True)
    kind = F.when(F.col("error").isNotNull(), "failed").when(F.col("embedding").isNull(), "no_face").otherwise("scored").alias("kind")
    return got.select(F.col("path").alias("name"), kind, F.round(F.col("embedding")[0].cast("double"), 2).alias("first"), "age", F.round("confidence", 4).alias("confidence"), F.round("laplacian_variance", 3).alias("sharpness"), "error")


#: Parts of file names that mean something in patterns, URLs or shells.
_ODD = ["plain", "b c", "d%20e", "a[1]", "f{1,2}", "g+h*", "i#j"]
_LINE_NAMES = f"SELECT DISTINCT printf('%s %d-%d-%d.png', list_extract([{', '.join(repr(x) for x in _ODD)}], CAST(l_linenumber AS INTEGER) % 7 + 1), l_orderkey, l_linenumber, l_partkey) AS name, l_partkey FROM lineitem"


@_query(f"WITH {_drawn(_LINE_NAMES)}, b AS ({_LINE_NAMES}) SELECT name, l_partkey % 9 <> 0 AS readable, CASE WHEN l_partkey % 9 <> 0 THEN 4 ELSE -1 END AS height, CASE WHEN l_partkey % 9 <> 0 THEN round(sharp, 3) END AS sharpness FROM lap JOIN b USING (name)")
def q60_named_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image file for each order line, listed and read by name: spaces, %20, brackets, braces and the like are names as any other."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    odd = F.element_at(F.array(*map(F.lit, _ODD)), (F.col("l_linenumber") % 7 + 1).cast("int"))
    name = F.format_string("folder %d/%s %d-%d-%d.png", F.col("l_orderkey") % 50, odd, "l_orderkey", "l_linenumber", "l_partkey")
    root = _folder(spark)
    _write_images(lines.select(name.alias("name"), (F.col("l_partkey") % 9 == 0).alias("broken")), root)
    images = read_named(list_in_tasks(spark, root).select("path", "length"), task_bytes=1 << 18)
    sharp = laplacian_variance(images).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "height", F.round("laplacian_variance", 3).alias("sharpness"))
    return sharp.select("name", (F.col("height") > 0).alias("readable"), "height", "sharpness")


_SUFFIX = "CASE s_suppkey % 6 WHEN 0 THEN 'jpg' WHEN 1 THEN 'PNG' WHEN 2 THEN 'webp' WHEN 3 THEN 'txt' WHEN 4 THEN 'jpeg' ELSE 'png' END"


@_query(f"""WITH f AS (SELECT 's' || s_suppkey || CASE WHEN s_suppkey % 4 = 0 THEN 'metadata' ELSE '' END AS stem, {_SUFFIX} AS x, length(s_name) AS n, s_suppkey % 2 = 0 AS deep FROM supplier)
SELECT 'listed' AS preset, count(*) AS n_images, CAST(sum(n) AS BIGINT) AS n_bytes FROM f
UNION ALL SELECT 'raw', count(*), CAST(sum(n) AS BIGINT) FROM f WHERE x IN ('jpg', 'png', 'jpeg')
UNION ALL SELECT 'pool', count(*), CAST(sum(n) AS BIGINT) FROM f WHERE lower(x) IN ('jpg', 'jpeg', 'png', 'webp')
UNION ALL SELECT 'extract', count(*), CAST(sum(n) AS BIGINT) FROM f WHERE x IN ('jpg', 'png') AND NOT contains(stem, 'metadata') AND NOT deep
UNION ALL SELECT 'adapter', count(*), CAST(sum(n) AS BIGINT) FROM f WHERE lower(x) IN ('png', 'jpg', 'jpeg')""")
def q39_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of suppliers, half of them in a folder below, listed and filtered by each preset."""
    key = F.col("s_suppkey")
    suffix = F.element_at(F.array(*map(F.lit, ("jpg", "PNG", "webp", "txt", "jpeg", "png"))), (key % 6 + 1).cast("int"))
    name = F.concat(F.when(key % 2 == 0, "below/").otherwise(""), F.lit("s"), key.cast("string"), F.when(key % 4 == 0, "metadata").otherwise(""), F.lit("."), suffix)
    root = _folder(spark)
    write_files(_table(spark, sf_dir, "supplier").select(name.alias("name"), F.col("s_name").cast("binary").alias("content")), root)
    listed = list_files(spark, root)
    sized = lambda df, preset: df.agg(F.count("*").alias("n_images"), F.sum("length").alias("n_bytes")).select(F.lit(preset).alias("preset"), "n_images", "n_bytes")
    out = sized(listed, "listed")
    for preset in PRESETS:
        out = out.unionAll(sized(filter_images(listed, preset, root=root, recursive=False), preset))
    counted = count_images(listed).select(F.lit("adapter").alias("preset"), F.col("n_images").alias("_n"))
    return out.join(counted, "preset", "left").select("preset", F.coalesce("_n", "n_images").alias("n_images"), "n_bytes")


_SUPPLIER_NAMES = "SELECT printf('s%04d.png', s_suppkey) AS name, s_suppkey FROM supplier"


def _supplier_images(spark: SparkSession, sf_dir: str, root: str, broken: Column | None = None) -> DataFrame:
    name = F.format_string("s%04d.png", "s_suppkey")
    return _write_images(_table(spark, sf_dir, "supplier").select(name.alias("name"), (F.lit(False) if broken is None else broken).alias("broken")), root)


@_query(f"WITH {_drawn(_SUPPLIER_NAMES)}, b AS ({_SUPPLIER_NAMES}) SELECT name, s_suppkey % 10 <> 0 AS readable, CASE WHEN s_suppkey % 10 <> 0 THEN 4 ELSE -1 END AS height, CASE WHEN s_suppkey % 10 <> 0 THEN round(sharp, 3) END AS sharpness FROM lap JOIN b USING (name)")
def q40_read_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PNG files decoded again; every tenth can't be."""
    root = _folder(spark)
    _supplier_images(spark, sf_dir, root, F.col("s_suppkey") % 10 == 0)
    images = read_images(spark, root)
    name = F.regexp_extract("path", r"([^/]*)$", 1).alias("name")
    sharp = laplacian_variance(images).select(name, "height", F.round("laplacian_variance", 3).alias("sharpness"))
    return images.select(name, "readable").join(sharp, "name").select("name", "readable", "height", "sharpness")


@_query(f"""WITH {_CAND} SELECT CAST(identity_id AS INTEGER) AS identity_id, trial, CAST(42 + event_id AS BIGINT) AS generation_seed, similarity AS arcface_similarity, laplacian_variance, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 90 AS INTEGER) END AS detected_age,
  rejection_reason, CASE WHEN valid THEN 'images/' || event_id END AS image_path FROM counted WHERE before < 5""")
def q41_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected candidates written as manifests and read back."""
    rows = admit_first_k(judged(spark, sf_dir), 5)
    rows = rows.withColumn("generation_seed", 42 + F.col("event_id")).withColumn("arcface_similarity", F.col("similarity")).withColumn("detected_age", F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 90))
    rows = rows.withColumn("image_path", F.concat(F.lit("images/"), F.col("event_id").cast("string")))
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in ("seed_path", "style_path", "candidate_path")}).withColumn("detected_gender", F.lit(None).cast("int"))
    accepted, rejected = split_admission(rows)
    root = _folder(spark)
    write_manifests(accepted, rejected, root)
    columns = ["identity_id", "trial", "generation_seed", "arcface_similarity", "laplacian_variance", "detected_age", "rejection_reason"]
    back = read_manifest(spark, f"{root}/identity_manifest").select(*columns, "image_path")
    other = spark.read.schema(CANDIDATES).option("header", True).csv(f"{root}/rejection_manifest").select(*columns, F.lit(None).cast("string").alias("image_path"))
    return back.unionAll(other)


@_query(f"""WITH a AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN -1 ELSE CAST(event_id % 92 AS INTEGER) - 1 END AS age, CASE WHEN event_id % 5 = 0 THEN -1 ELSE CAST(event_id % 2 AS INTEGER) END AS gender FROM events)
SELECT 'e' || event_id AS image_path, CAST(age AS SMALLINT) AS age, CAST(gender AS TINYINT) AS gender, CAST({_GROUP} AS TINYINT) AS age_group FROM a""")
def q42_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes with defaults and narrow integers, written and read back."""
    key = F.col("event_id")
    rows = _table(spark, sf_dir, "events").select(F.concat(F.lit("e"), key.cast("string")).alias("image_path"), F.array(F.lit(1.0).cast("float")).alias("embedding"), F.when(key % 7 != 0, (key % 92).cast("int") - 1).alias("age"), F.when(key % 5 != 0, (key % 2).cast("int")).alias("gender"))
    filled = with_attr_defaults(rows)
    root = _folder(spark)
    write_attributes(cast_attributes(filled.withColumn("age_group", age_group(F.col("age")))), root)
    return read_attributes(spark, root).select("image_path", "age", "gender", "age_group")


@_query("""WITH p AS (SELECT event_id, value, CAST((row_number() OVER (ORDER BY event_id) - 1) // 100 + 1 AS BIGINT) AS chunk_id FROM events)
SELECT event_id, chunk_id, CASE WHEN chunk_id % 3 = 0 THEN -1 ELSE value END AS value FROM p WHERE NOT (chunk_id % 3 = 0 AND event_id % 2 = 0)""")
def q43_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks written over an older run, every third one replaced by other rows, and all read back as one table."""
    rows = assign_chunks(_table(spark, sf_dir, "events").select("event_id", "value"), 100, "event_id").drop("position")
    root = _folder(spark)
    write_chunks(rows.withColumn("chunk_id", F.col("chunk_id") + 7), root)
    write_chunks(rows, root)
    write_chunk(rows.where("chunk_id % 3 = 0 and event_id % 2 <> 0").withColumn("value", F.lit(-1.0)), root)
    return read_chunks(spark, root).select("event_id", F.col("chunk_id").cast("long").alias("chunk_id"), "value")


class _Stopped(RuntimeError):
    """A write that ends before it publishes."""


@_query("""WITH p AS (SELECT event_id, CAST((row_number() OVER (ORDER BY event_id) - 1) // 100 + 1 AS BIGINT) AS chunk_id FROM events), half AS (SELECT * FROM p WHERE chunk_id % 2 = 0)
SELECT 'all' AS state, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, count(DISTINCT chunk_id) AS chunks FROM p
UNION ALL SELECT 'stopped', count(*), CAST(sum(event_id) AS BIGINT), count(DISTINCT chunk_id) FROM p
UNION ALL SELECT 'replaced', (SELECT count(*) FROM p), (SELECT CAST(sum(event_id) AS BIGINT) FROM p) - (SELECT count(*) FROM half), (SELECT count(DISTINCT chunk_id) FROM p)
UNION ALL SELECT 'first again', count(*), CAST(sum(event_id) AS BIGINT), count(DISTINCT chunk_id) FROM p
UNION ALL SELECT 'shorter', count(*), CAST(sum(event_id) AS BIGINT), count(DISTINCT chunk_id) FROM half""")
def q61_chunk_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see of a table of chunks: a write that stops midway changes nothing, one that ends replaces its chunks at once, and earlier versions can be read."""
    rows = assign_chunks(_table(spark, sf_dir, "events").select("event_id"), 100, "event_id").drop("position")
    root = _folder(spark)
    seen = lambda state, version=None: read_chunks(spark, root, version).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.countDistinct("chunk_id").alias("chunks")).select(F.lit(state).alias("state"), "*")

    def stop(before) -> None:
        raise _Stopped

    first = write_chunks(rows, root)
    out = seen("all")
    changed = rows.where("chunk_id % 2 = 0").withColumn("event_id", F.col("event_id") - 1)
    try:
        write_chunk(changed, root, before_publish=stop)
    except _Stopped:
        out = out.unionAll(seen("stopped"))
    write_chunk(changed, root)
    out = out.unionAll(seen("replaced")).unionAll(seen("first again", first.number))
    write_chunks(rows.where("chunk_id % 2 = 0"), root)
    ChunkTable(spark, root).vacuum(3)
    return out.unionAll(seen("shorter"))


@_query(_OUTCOME + "SELECT count(*) AS total, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'blurry') AS blurry FROM o")
def q44_summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary written as a JSON document and read back."""
    root = _folder(spark)
    write_summary(q06_funnel(spark, sf_dir), root)
    return read_json_doc(spark, root, "total long, success long, blurry long")


@_query(f"WITH {_DATA} SELECT 'e' || image_key AS image_path, CAST(cluster_id AS INTEGER) AS cluster_id, age_group, split, forget_step, CAST(row_number() OVER (ORDER BY CAST(cluster_id AS INTEGER), 'e' || image_key) - 1 AS BIGINT) AS place FROM dataset")
def q45_dataset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset written as CSV in order and as Parquet; the place of each row in the CSV files, one after the other."""
    root = _folder(spark)
    data = q19_dataset(spark, sf_dir).select(F.concat(F.lit("e"), F.col("image_key").cast("string")).alias("image_path"), F.col("cluster_id").cast("int").alias("cluster_id"), F.col("age_group").cast("tinyint").alias("age_group"), "split", "forget_step")
    write_dataset(data, f"{root}/dataset")
    rows = spark.read.schema("image_path string, cluster_id int, age_group tinyint, split string, forget_step int").option("header", True).csv(f"{root}/dataset/csv")
    rows = rows.withColumn("file", F.input_file_name()).withColumn("id", F.monotonically_increasing_id())
    numbered = assign_chunks(rows, 100, "file", "id").select("image_path", F.col("position").alias("place"))
    return spark.read.parquet(f"{root}/dataset/parquet").join(numbered, "image_path")


@_query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_discount * l_tax, 4) AS confidence, round(l_extendedprice / 7, 2) AS blur_score FROM lineitem")
def q46_round_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_discount") * F.col("l_tax")).alias("confidence"), (F.col("l_extendedprice") / 7).alias("blur_score"))
    return round_metrics(lines)


@_query("SELECT user_id, count(*) FILTER (value >= 20 AND event_type <> 'error') AS saved, count(*) FILTER (NOT (value >= 20 AND event_type <> 'error')) AS failed FROM events GROUP BY user_id")
def q47_saved_and_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of what could be saved, by user: readable from 20 on, no face in errors."""
    rows = split_valid(_table(spark, sf_dir, "events").select("user_id", "value", "event_type"), F.col("value") >= 20, F.col("event_type") != "error")
    return rows.groupBy("user_id").agg(F.count_if("saved").alias("saved"), F.count_if(~F.col("saved")).alias("failed"))


_SEED_SQL = """WITH v AS (SELECT vec_id, label AS identity_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), s AS (SELECT identity_id, arg_min(e, vec_id) AS s FROM v GROUP BY identity_id)
SELECT vec_id, identity_id, round(sqrt(list_dot_product(e, e)), 6) AS norm, round(list_dot_product(e, s) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(s, s))), 6) AS arcface_similarity FROM v JOIN s USING (identity_id)"""


@_query(_SEED_SQL)
def q48_seed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised seeds attached to their identity's candidates, and the similarity to them."""
    v = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("identity_id"), "embedding")
    seeds = seed_vectors(v.groupBy("identity_id").agg(F.min_by("embedding", "vec_id").alias("embedding")))
    return with_similarity(attach_seed(v, seeds)).select("vec_id", "identity_id", F.round("norm", 6).alias("norm"), F.round("arcface_similarity", 6).alias("arcface_similarity"))


@_query(_SEED_SQL)
def q62_block_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same similarity, a batch of vectors at a time."""
    v = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("identity_id"), "embedding")
    seeds = seed_vectors(v.groupBy("identity_id").agg(F.min_by("embedding", "vec_id").alias("embedding")))
    return with_similarity_in_blocks(attach_seed(v, seeds)).select("vec_id", "identity_id", F.round("norm", 6).alias("norm"), F.round("arcface_similarity", 6).alias("arcface_similarity"))


@_query(f"WITH {_CAND} SELECT identity_id, trial, event_id, rejection_reason, valid, props, CAST(CASE WHEN valid THEN before ELSE -1 END AS INTEGER) AS accepted_idx FROM counted JOIN events USING (event_id) WHERE before < 5")
def q63_admit_in_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission of rows with all their columns: cut-offs by block of trials first, then only the rows before them."""
    wide = judged(spark, sf_dir).join(_table(spark, sf_dir, "events").select("event_id", "props"), "event_id")
    kept = admit_in_two(settle(wide), 5)
    return kept.select("identity_id", "trial", "event_id", "rejection_reason", "valid", "props", F.coalesce("accepted_idx", F.lit(-1)).alias("accepted_idx"))


@_query("""SELECT 'page ' || max(page_id) || '.PNG' AS newest, count(*) - 1 AS listed_before, count(*) AS listed_after, (SELECT count(*) FROM pages) AS files FROM pages WHERE page_id % 3 <> 0""")
def q64_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest file since a stored listing; pages divisible by three are text files, which the listing itself leaves out."""
    root = _folder(spark)
    pages = _table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("page "), F.col("page_id").cast("string"), F.when(F.col("page_id") % 3 == 0, ".txt").otherwise(".PNG")).alias("name"), F.encode("url", "utf-8").alias("content"))
    last = pages.where("page_id % 3 <> 0").agg(F.max("page_id")).first()[0]
    write_files(pages.where(F.col("page_id") != last), f"{root}/files")
    before = save_snapshot(list_files(spark, f"{root}/files", preset="pool"), f"{root}/snapshot")
    write_files(pages.where(F.col("page_id") == last), f"{root}/files")
    after = list_files(spark, f"{root}/files", preset="pool")
    one = lambda df: df.withColumn("_one", F.lit(1))
    newest = newest_new_file(after, before).select(F.regexp_extract("path", r"([^/]*)$", 1).alias("newest"))
    counts = [(before, "listed_before"), (after, "listed_after"), (list_files(spark, f"{root}/files"), "files")]
    out = one(newest)
    for listed, name in counts:
        out = out.join(one(listed.agg(F.count("*").alias(name))), "_one")
    return out.drop("_one")


@_query("""WITH n AS (SELECT count(*) AS n FROM nation), g AS (SELECT CAST(s_suppkey AS INTEGER) AS identity_id, CAST(t.trial AS INTEGER) AS trial FROM supplier, (SELECT unnest(range(7)) AS trial) t)
SELECT identity_id, trial, n_name AS style FROM g, n JOIN nation ON n_nationkey = (identity_id * 7 + trial) % n.n""")
def q49_attach_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("identity_id"))
    styles = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("style_idx"), F.col("n_name").alias("style"))
    return attach_style(plan_candidates(seeds, 7), styles, 7).select("identity_id", "trial", "style")


@_query(f"""WITH {_DATA}, e AS (SELECT *, image_key % 8 <> 0 AS saved FROM grouped)
SELECT count(*) AS total_input, count(*) FILTER (saved) AS extracted, count(*) FILTER (NOT saved) AS failed, CAST(3 AS INTEGER) AS embedding_dim, CAST((SELECT count(DISTINCT user_id % 9) FROM events) AS INTEGER) AS chunks,
  count(*) FILTER (saved AND age_group = -1) AS unknown, count(*) FILTER (saved AND age_group = 3) AS seniors, count(*) FILTER (saved AND gender = 0) AS female, count(*) FILTER (saved AND gender = 1) AS male FROM e""")
def q50_extraction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of an extraction from the totals of the chunks that it wrote; every eighth image failed, and a chunk is users alike modulo nine."""
    rows = attributes(spark, sf_dir).withColumn("age_group", age_group(F.col("age"))).withColumn("saved", F.col("image_key") % 8 != 0)
    rows = rows.withColumn("embedding", F.when(F.col("saved"), F.array(*(F.lit(1.0) for _ in range(3))))).withColumn("chunk_id", F.col("cluster_id") % 9 + 1)
    root = _folder(spark)
    version = write_chunks(rows.select("image_key", "embedding", "age", "gender", "age_group", "saved", "chunk_id"), root, {"dim": F.max(F.size("embedding"))})
    one = extraction_of(ChunkTable(spark, root).lines(), version.metrics["dim"])
    ages, genders = F.col("age_distribution"), F.col("gender_distribution")
    return one.select("total_input", "extracted", "failed", "embedding_dim", "chunks", F.coalesce(F.try_element_at(ages, F.lit("Unknown")), F.lit(0)).alias("unknown"), F.coalesce(F.try_element_at(ages, F.lit("Senior (65+)")), F.lit(0)).alias("seniors"), genders["female"].alias("female"), genders["male"].alias("male"))


@_query("""SELECT 'one_to_one' AS guard, CASE WHEN EXISTS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) THEN 'keys are not unique in the left side' END AS message
UNION ALL SELECT 'both sides', CASE WHEN EXISTS (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) THEN 'keys are not unique in the left and the right side' END
UNION ALL SELECT 'complete', (SELECT count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) || ' rows have no match'
UNION ALL SELECT 'complete join', CASE WHEN EXISTS (SELECT 1 FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) THEN 'rows have no match' END
UNION ALL SELECT 'plan', CASE WHEN (SELECT count(*) FROM part) < 2 * (SELECT count(*) FROM events) THEN 'the pool needs two images for each identity' END
UNION ALL SELECT 'plan passes', CASE WHEN (SELECT count(*) FROM part) < 2 * (SELECT count(*) FROM nation) THEN 'the pool needs two images for each identity' END
UNION ALL SELECT 'seeds', CASE WHEN EXISTS (SELECT 1 FROM events WHERE value IS NULL OR value = 0 OR event_id % 10 = 0) THEN 'seed without a usable embedding' END
UNION ALL SELECT 'passes', NULL""")
def q51_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say of the given tables; null where they pass. Those inside a plan speak when its result is asked for."""
    table = lambda name: _table(spark, sf_dir, name)
    parts = table("part").count()
    read = lambda df: df.write.format("noop").mode("overwrite").save()
    lines = table("lineitem").select("l_orderkey")
    seeds = table("events").select(F.col("event_id").alias("identity_id"), F.array(F.when(F.col("event_id") % 10 != 0, F.col("value"))).alias("embedding"))
    tried = {
        "one_to_one": lambda: read(join_one_to_one(lines, table("orders").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")),
        "both sides": lambda: read(join_one_to_one(lines, lines, "l_orderkey")),
        "complete": lambda: require_complete(table("documents"), table("labels"), "doc_id"),
        "complete join": lambda: read(join_one_to_one(table("documents").select("doc_id"), table("labels"), "doc_id", complete=True)),
        "plan": lambda: require_plan(sources=parts, identities=table("events").count()),
        "plan passes": lambda: require_plan(sources=parts, identities=table("nation").count()),
        "seeds": lambda: read(seed_vectors(seeds)),
        "passes": lambda: require_complete(table("nation").select(F.col("n_regionkey").alias("r_regionkey")), table("region"), "r_regionkey"),
    }
    rows = []
    for name, guard in tried.items():
        try:
            guard()
            rows.append((name, None))
        except ValueError as e:
            rows.append((name, str(e)))
        except SparkRuntimeException as e:  # says which key or identity, one of several
            rows.append((name, e.getMessageParameters()["errorMessage"].split(":")[0]))
    return spark.createDataFrame(rows, "guard string, message string")


@_query(f"""WITH {_drawn(_SUPPLIER_NAMES)}, b AS ({_SUPPLIER_NAMES}), good AS (SELECT age, gender FROM score JOIN b USING (name) WHERE s_suppkey % 10 <> 0), n AS (SELECT count(*) AS n FROM supplier)
SELECT n AS source_images, (SELECT count(*) FROM good) AS extracted, (SELECT count(*) FROM supplier WHERE s_suppkey % 10 = 0) AS failed,
  (SELECT count(*) FROM good WHERE age >= 25 AND age < 45) AS adults, (SELECT count(*) FROM good WHERE gender = 0) AS female, CAST(ceil(n / greatest(1, n // 4)) AS BIGINT) AS batches, n AS rows_in_chunks FROM n""")
def q52_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over image files in four batches or more, ended by a fault in the second and started again; totals merged from those of its chunks."""
    root = _folder(spark)
    _supplier_images(spark, sf_dir, f"{root}/images", F.col("s_suppkey") % 10 == 0)
    each = max(1, _table(spark, sf_dir, "supplier").count() // 4)

    def fault(before) -> None:
        if len(before.chunks) == 1:
            raise _Stopped

    start = lambda hook: stream_extract(spark, f"{root}/images", f"{root}/out", stub_scorer(), f"{root}/mark", each, hook)
    try:
        start(fault).awaitTermination()
    except StreamingQueryException:
        start(None).awaitTermination()
    found = stream_summary(spark, f"{root}/out")
    adults = found["ages"].agg(F.coalesce(F.sum(F.when(F.col("age_group") == 1, F.col("n"))), F.lit(0)).alias("adults"))
    chunks = read_chunks(spark, f"{root}/out").agg(F.countDistinct("chunk_id").alias("batches"), F.count("*").alias("rows_in_chunks"))
    one = lambda df: df.withColumn("_one", F.lit(1))
    return one(found["totals"]).join(one(adults), "_one").join(one(found["genders"].select("female")), "_one").join(one(chunks), "_one").drop("_one")


def _settings(root: str, **more) -> Settings:
    return Settings(**({"raw": f"{root}/raw", "out": f"{root}/out", "scorer": stub_scorer(), "conf_threshold": 0.95, "crop_blur_threshold": 50_000.0, "blur_threshold": 45_000.0, "min_similarity": 0.0, "strict": False, "seed": 42} | more))


@_query(f"""WITH {_drawn(_SUPPLIER_NAMES)}, b AS ({_SUPPLIER_NAMES})
SELECT name AS filename, CASE WHEN s_suppkey % 10 = 0 THEN 'error' WHEN confidence < 0.95 THEN 'low_conf' WHEN sharp < 50000 THEN 'blurry' ELSE 'success' END AS outcome,
  CASE WHEN s_suppkey % 10 <> 0 THEN round(sharp, 2) END AS blur_score FROM score JOIN b USING (name)""")
def q53_job_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first job over image files: outcome and rounded sharpness of each, without the job's cap on their number."""
    root = _folder(spark)
    _supplier_images(spark, sf_dir, f"{root}/raw", F.col("s_suppkey") % 10 == 0)
    marked, _ = jobs.preprocess(spark, _settings(root, max_images=None))
    return marked.select("filename", "outcome", "blur_score")


@_query(f"""WITH {_drawn(_SUPPLIER_NAMES)}, b AS ({_SUPPLIER_NAMES})
SELECT name AS filename, 'raw/' || name AS original, 'out/processed/' || replace(name, '.png', '_face.jpg') AS processed, round(confidence, 4) AS confidence, round(sharp, 2) AS blur_score FROM score JOIN b USING (name) WHERE s_suppkey % 10 <> 0 AND confidence >= 0.95 AND sharp >= 50000
UNION ALL SELECT 'summary', CAST(count(*) AS VARCHAR), CAST(count(*) FILTER (s_suppkey % 10 = 0) AS VARCHAR), NULL, NULL FROM supplier""")
def q68_preprocess_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first job writes: records of the images that passed, with the paths of both files, and its summary, counted by the write."""
    root = _folder(spark)
    _supplier_images(spark, sf_dir, f"{root}/raw", F.col("s_suppkey") % 10 == 0)
    s = _settings(root, max_images=None, steps={"generate": False, "extract": False, "build": False})
    jobs.run(spark, s)
    records = spark.read.schema(PROCESSED).json(f"{s.out}/preprocess_records")
    below = lambda c: F.regexp_extract(c, r"(raw/.*|out/processed/.*)$", 1)
    found = records.select("filename", below("original_path").alias("original"), below("processed_path").alias("processed"), "confidence", "blur_score")
    total = read_json_doc(spark, f"{s.out}/preprocess_summary", "total long, error long")
    return found.unionAll(total.select(F.lit("summary"), F.col("total").cast("string"), F.col("error").cast("string"), F.lit(None).cast("double"), F.lit(None).cast("double")))


#: Identities of the job queries: four candidates each, the first two sharp ones are taken.
_TRIALS, _TAKEN = 4, 2
_CANDIDATES = f"SELECT s_name || ' ' || s_nationkey || ' ' || t AS name, s_suppkey AS i, t FROM supplier, (SELECT unnest(range({_TRIALS})) AS t) b WHERE s_suppkey < (SELECT count(*) // 2 FROM supplier)"
_TAKE = f"""{_drawn(_CANDIDATES)}, c AS ({_CANDIDATES}), valid AS (SELECT name, i, t, age, sharp, sharp >= 45000 AS ok FROM score JOIN c USING (name)),
seen AS (SELECT *, coalesce(sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY i ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM valid),
taken AS (SELECT * FROM seen WHERE ok AND before < {_TAKEN})"""


def _job_folder(spark: SparkSession, sf_dir: str) -> Settings:
    """Raw images of all suppliers, and for half of them as identities the candidates, drawn from the supplier's name and nation, as files."""
    root = _folder(spark)
    suppliers = _table(spark, sf_dir, "supplier")
    _supplier_images(spark, sf_dir, f"{root}/raw")
    n = suppliers.count() // 2
    grid = suppliers.where(F.col("s_suppkey") < n).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(_TRIALS - 1))))
    drawn = F.concat_ws(" ", "s_name", F.col("s_nationkey").cast("string"), F.col("t").cast("string"))
    _write_images(grid.select(F.format_string("%03d_%03d.png", "s_suppkey", "t").alias("name"), drawn.alias("drawn"), F.lit(False).alias("broken")), f"{root}/out/_candidates")
    return _settings(root, n_identities=n, candidates_per_identity=_TRIALS, images_per_identity=_TAKEN, n_forget=1, n_test=1, chunk_size=16, steps={"preprocess": False})


@_query(f"WITH {_TAKE} SELECT CAST(i AS INTEGER) AS identity_id, CAST(t AS INTEGER) AS trial, CASE WHEN ok THEN 'accepted' ELSE 'blur' END AS rejection_reason, CASE WHEN ok THEN printf('images/identity_%03d/%03d.png', i, CAST(before AS INTEGER)) END AS image FROM seen WHERE before < {_TAKEN}")
def q54_job_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job that plans, scores and admits candidates; its manifests read back."""
    s = _job_folder(spark, sf_dir)
    made = jobs.run(spark, Settings(**(vars(s) | {"steps": {"preprocess": False, "extract": False, "build": False}})))
    image = F.regexp_extract("image_path", r"(images/.*)$", 1).alias("image")
    columns = ["identity_id", "trial", "rejection_reason"]
    return made["accepted"].select(*columns, image).unionAll(made["rejected"].select(*columns, F.lit(None).cast("string").alias("image")))


@_query(f"WITH {_TAKE}, p AS (SELECT printf('%03d_%03d.png', i, t) AS name, age, row_number() OVER (ORDER BY i, t) - 1 AS k FROM taken) SELECT name, CAST(age AS SMALLINT) AS age, CAST({_GROUP} AS TINYINT) AS age_group, CAST(k // 16 + 1 AS BIGINT) AS chunk_id FROM p")
def q55_job_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job that extracts attributes of accepted images, alone after the one that admits them."""
    s = _job_folder(spark, sf_dir)
    jobs.run(spark, Settings(**(vars(s) | {"steps": {"preprocess": False, "extract": False, "build": False}})))
    made = jobs.run(spark, Settings(**(vars(s) | {"steps": {"preprocess": False, "generate": False, "build": False}})))
    return made["attributes"].select(F.regexp_extract("image_path", r"([^/]*)$", 1).alias("name"), "age", "age_group", F.col("chunk_id").cast("long").alias("chunk_id"))


_RANKED = "ids AS (SELECT DISTINCT i FROM taken), ranked AS (SELECT i, row_number() OVER (ORDER BY md5('42:' || i), i) - 1 AS k FROM ids)"


@_query(f"""WITH {_TAKE}, {_RANKED} SELECT printf('images/identity_%03d/%03d.png', i, CAST(before AS INTEGER)) AS image, CAST(i AS INTEGER) AS cluster_id, CAST({_GROUP} AS TINYINT) AS age_group,
  CASE WHEN k < 1 THEN 'forget' WHEN k < 2 THEN 'test' ELSE 'retain' END AS split, CAST(CASE WHEN k < 1 THEN 0 ELSE -1 END AS INTEGER) AS forget_step FROM taken JOIN ranked USING (i)""")
def q56_job_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs one after the other, from image files to the dataset."""
    made = jobs.run(spark, _job_folder(spark, sf_dir))
    return made["dataset"].select(F.regexp_extract("image_path", r"(images/.*)$", 1).alias("image"), "cluster_id", "age_group", "split", "forget_step")


@_query(f"WITH {_DATA} SELECT CAST(e.event_id AS VARCHAR) AS image_path, e.user_id AS cluster_id, CAST(g.age_group AS TINYINT) AS age_group, s.split, s.forget_step FROM events e JOIN grouped g ON e.event_id = g.image_key JOIN splits s ON e.user_id = s.cluster_id WHERE g.age_group <> -1")
def q57_job_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job that builds the dataset, from a manifest and attributes of all events."""
    attrs = attributes(spark, sf_dir)
    path = F.col("event_id").cast("string").alias("image_path")
    manifest = _table(spark, sf_dir, "events").select(path, F.col("user_id").alias("cluster_id"))
    left = attrs.select(F.col("image_key").cast("string").alias("image_path"), age_group(F.col("age")).alias("age_group"))
    return jobs.build_dataset(manifest, left, _settings("", n_forget=4, n_test=6))[0]


@_query(f"WITH {_DATA} SELECT cluster_id, count(*) AS n, split FROM grouped JOIN splits USING (cluster_id) GROUP BY ALL")
def q58_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of each identity with its split."""
    rows = attributes(spark, sf_dir)
    special = special_ids(distinct_ids(rows), 4, 6)
    return apply_split(rows, special).groupBy("cluster_id", "split").agg(F.count("*").alias("n"))
