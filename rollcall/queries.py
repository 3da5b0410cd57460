"""Queries over the given tables, each with the same question in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.attributes import age_group, age_group_label
from .functions.classify import classify_candidate, classify_preprocess, drop_unknown
from .functions.boxes import unpad_detections
from .functions.paths import with_output_paths, with_path_parts
from .functions.vectors import cosine, l2_norm, l2_norm_batch, l2_normalize
from .operators.admission import accepted_only, admit_first_k, generation_summary, rejection_counts, rejection_maps, shortfalls, split_admission
from .operators.candidates import plan_candidates, style_index
from .operators.chunks import assign_chunks, chunk_manifest
from .operators.detections import best_detection, without_detection
from .operators.joins import join_one_to_one, missing_rows
from .operators.sampling import first_by_hash, inspection_sample, sample_cap, split_pools
from .operators.splits import apply_split, assign_splits, distinct_ids, special_ids
from .operators.summaries import age_distribution, dataset_summary, gender_distribution, label_distribution, preprocess_funnel, retained_parts, sample_counts, split_sizes, stem_collisions
from .sources.readers import newest_new_file
from .storage import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- views: what stands for candidates, attributes and detections -------------------------------------


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored candidates: identity = user, trial = place of the event among the user's."""
    trial = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    events = _table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", _k().alias("k"))
    return events.select(F.col("user_id").alias("identity_id"), trial.cast("int").alias("trial"), (F.col("k") / F.lit(100.0)).alias("similarity"), F.col("value").alias("laplacian_variance"), "event_id", "event_type")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their verdict; all have a face and a usable embedding."""
    verdict = classify_candidate(F.lit(True), F.lit(1.0), F.col("similarity"), F.col("laplacian_variance"), 0.45, 20.0)
    return candidates(spark, sf_dir).drop("event_type").withColumn("rejection_reason", verdict)


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select(F.col("event_id").alias("image_key"), F.col("user_id").alias("cluster_id"), ((F.col("event_id") % 92).cast("int") - 1).alias("age"), ((F.col("event_id") % 3).cast("int") - 1).alias("gender"))


_CAND = """cand AS (
  SELECT user_id AS identity_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS trial,
         CAST(json_extract(props, '$.k') AS INTEGER) / CAST(100 AS DOUBLE) AS similarity, value AS laplacian_variance, event_id FROM events),
judged AS (
  SELECT *, coalesce(nullif(concat_ws('+', CASE WHEN similarity < 0.45 THEN 'low_similarity' END, CASE WHEN laplacian_variance < 20 THEN 'blur' END), ''), 'accepted') AS rejection_reason FROM cand),
counted AS (
  SELECT *, rejection_reason = 'accepted' AS valid,
         coalesce(sum(CASE WHEN rejection_reason = 'accepted' THEN 1 ELSE 0 END) OVER (PARTITION BY identity_id ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM judged)"""
_GROUP = "CASE WHEN age < 0 THEN -1 WHEN age < 25 THEN 0 WHEN age < 45 THEN 1 WHEN age < 65 THEN 2 ELSE 3 END"
_LABEL = "CASE age_group WHEN -1 THEN 'Unknown' WHEN 0 THEN 'Young (0-24)' WHEN 1 THEN 'Adult (25-44)' WHEN 2 THEN 'Middle-Aged (45-64)' WHEN 3 THEN 'Senior (65+)' END"
_DATA = f"""attrs AS (
  SELECT event_id AS image_key, user_id AS cluster_id, CAST(event_id % 92 AS INTEGER) - 1 AS age, CAST(event_id % 3 AS INTEGER) - 1 AS gender FROM events),
grouped AS (SELECT *, {_GROUP} AS age_group FROM attrs),
ranked AS (SELECT cluster_id, row_number() OVER (ORDER BY md5('42:' || cluster_id), cluster_id) - 1 AS k FROM (SELECT DISTINCT cluster_id FROM attrs)),
splits AS (SELECT cluster_id, k, CASE WHEN k < 4 THEN 'forget' WHEN k < 10 THEN 'test' ELSE 'retain' END AS split, CAST(CASE WHEN k < 4 THEN k ELSE -1 END AS INTEGER) AS forget_step FROM ranked),
dataset AS (
  SELECT image_key, cluster_id, CAST(age_group AS TINYINT) AS age_group, split, forget_step
  FROM grouped JOIN splits USING (cluster_id) WHERE age_group <> -1)"""


@_query(r"SELECT page_id, url FROM pages WHERE lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^.+\.([^.]+)$', 1)) IN ('html', 'htm', 'php', 'aspx')")
def q01_ext_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by extension, whatever their case."""
    name = F.regexp_extract("url", r"([^/]*)$", 1)
    return _table(spark, sf_dir, "pages").select("page_id", "url").where(F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1)).isin("html", "htm", "php", "aspx"))


@_query("SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def q02_sample_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_cap(_table(spark, sf_dir, "documents").select("doc_id", "source"), 100, 42, "doc_id")


@_query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT vec_id, round(sqrt(list_dot_product(e, e)), 6) AS norm, round(e[1] / sqrt(list_dot_product(e, e)), 6) AS first_unit FROM v""")
def q03_l2_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _table(spark, sf_dir, "embeddings")
    return v.select("vec_id", F.round(l2_norm(F.col("embedding")), 6).alias("norm"), F.round(l2_normalize(F.col("embedding"))[0], 6).alias("first_unit"))


@_query("""WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
seeds AS (SELECT label, min(vec_id) AS seed_id, arg_min(e, vec_id) AS s FROM v GROUP BY label)
SELECT vec_id, label, seed_id, round(list_dot_product(e, s) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(s, s))), 6) AS similarity
FROM v JOIN seeds USING (label)""")
def q04_seed_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each vector to its label's seed, the vector with the least id."""
    v = _table(spark, sf_dir, "embeddings")
    first = v.groupBy("label").agg(F.min("vec_id").alias("seed_id"), F.min_by("embedding", "vec_id").alias("seed"))
    return v.join(first, "label").select("vec_id", "label", "seed_id", F.round(cosine(F.col("embedding"), F.col("seed")), 6).alias("similarity"))


_OUTCOME = """WITH o AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'no_face' WHEN CAST(json_extract(props, '$.k') AS INTEGER) / CAST(100 AS DOUBLE) < 0.20 THEN 'low_conf'
  WHEN value < 20 THEN 'blurry' ELSE 'success' END AS outcome FROM events) """


@_query(_OUTCOME + "SELECT event_id, outcome FROM o")
def q05_preprocess_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    confidence = F.when(F.col("event_type") != "error", _k() / F.lit(100.0))
    return _table(spark, sf_dir, "events").select("event_id", classify_preprocess(confidence, F.col("value"), 0.20, 20.0).alias("outcome"))


@_query(_OUTCOME + """SELECT count(*) AS total, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'no_face') AS no_face, count(*) FILTER (outcome = 'low_conf') AS low_conf,
  count(*) FILTER (outcome = 'blurry') AS blurry, CAST(0 AS BIGINT) AS error, round(count(*) FILTER (outcome = 'success') * CAST(100 AS DOUBLE) / nullif(count(*), 0), 6) AS yield_pct FROM o""")
def q06_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess_funnel(q05_preprocess_class(spark, sf_dir))


@_query("""WITH c AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'no_face' WHEN CAST(json_extract(props, '$.k') AS INTEGER) / CAST(100 AS DOUBLE) < 0.45 THEN 'low_similarity' END AS identity,
  CASE WHEN value < 20 THEN 'blur' END AS blur FROM events)
SELECT event_id, coalesce(nullif(concat_ws('+', identity, blur), ''), 'accepted') AS verdict FROM c""")
def q07_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(spark, sf_dir)
    verdict = classify_candidate(F.col("event_type") != "error", F.lit(1.0), F.col("similarity"), F.col("laplacian_variance"), 0.45, 20.0)
    return c.select("event_id", verdict.alias("verdict"))


@_query("""SELECT CAST(s_suppkey AS INTEGER) AS identity_id, CAST(t.trial AS INTEGER) AS trial, CAST((s_suppkey * 7 + t.trial) % 30 AS INTEGER) AS style_idx, CAST(42 + s_suppkey * 7 + t.trial AS BIGINT) AS generation_seed,
  printf('out/_candidates/%03d_%03d.png', s_suppkey, t.trial) AS candidate_path FROM supplier, (SELECT unnest(range(7)) AS trial) t""")
def q08_plan_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("identity_id"))
    plan = with_output_paths(plan_candidates(seeds, 7, 42).withColumn("style_idx", style_index(7, 30)), "out")
    return plan.select("identity_id", "trial", "style_idx", "generation_seed", "candidate_path")


@_query(f"""WITH {_CAND} SELECT identity_id, trial, event_id, rejection_reason, valid, CASE WHEN valid THEN CAST(before AS INTEGER) ELSE -1 END AS accepted_idx FROM counted WHERE before < 5""")
def q09_admit_first_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: in trial order, everything looked at until five candidates of an identity are valid; accepted_idx -1 for the others."""
    kept = admit_first_k(judged(spark, sf_dir), 5)
    return kept.select("identity_id", "trial", "event_id", "rejection_reason", "valid", F.coalesce("accepted_idx", F.lit(-1)).alias("accepted_idx"))


@_query(f"WITH {_CAND} SELECT identity_id, rejection_reason, count(*) AS n FROM counted WHERE before < 5 AND NOT valid GROUP BY ALL")
def q10_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_counts(q09_admit_first_k(spark, sf_dir).where("not valid"))


@_query(f"WITH {_CAND} SELECT identity_id, CAST(count(*) FILTER (valid) AS BIGINT) AS accepted FROM counted GROUP BY identity_id HAVING count(*) FILTER (valid) < 20")
def q11_shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(spark, sf_dir)
    return shortfalls(_table(spark, sf_dir, "events").select(F.col("user_id").alias("identity_id")), admit_first_k(rows, 20), 20)


@_query(f"""WITH {_DATA} SELECT CAST(g.age_group AS INTEGER) AS age_group, {_LABEL.replace('CASE age_group', 'CASE g.age_group')} AS label, coalesce(c.n, 0) AS n
FROM (SELECT unnest([-1, 0, 1, 2, 3]) AS age_group) g LEFT JOIN (SELECT age_group, count(*) AS n FROM grouped GROUP BY age_group) c ON g.age_group = c.age_group""")
def q12_age_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return age_distribution(attributes(spark, sf_dir).withColumn("age_group", age_group(F.col("age"))), include_zero=True)


@_query(f"WITH {_DATA} SELECT count(*) FILTER (gender = 0) AS female, count(*) FILTER (gender = 1) AS male FROM attrs")
def q13_gender_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gender_distribution(attributes(spark, sf_dir))


@_query("""WITH p AS (SELECT n_chars, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT CAST(position // 64 + 1 AS BIGINT) AS chunk_id, count(*) AS source_images, count(*) FILTER (n_chars >= 500) AS saved_embeddings, count(*) FILTER (n_chars < 500) AS failed,
  min(position) AS chunk_start, max(position) + 1 AS chunk_end FROM p GROUP BY 1""")
def q14_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 64 by doc_id; a text of 500 characters stands for an image that could be saved."""
    rows = assign_chunks(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), 64, "doc_id")
    return chunk_manifest(rows, F.col("n_chars") >= 500)


@_query("SELECT doc_id, lang, source, quality, toxic FROM documents JOIN labels USING (doc_id)")
def q15_join_1to1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = _table(spark, sf_dir, "labels")
    return join_one_to_one(docs, labels, "doc_id").select("doc_id", "lang", "source", "quality", "toxic")


@_query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q16_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_rows(_table(spark, sf_dir, "documents").select("doc_id", "source"), _table(spark, sf_dir, "labels"), "doc_id")


@_query(f"WITH {_DATA} SELECT cluster_id, split FROM splits")
def q17_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = distinct_ids(attributes(spark, sf_dir))
    return assign_splits(ids, 4, 6).select("cluster_id", "split")


@_query(f"WITH {_DATA} SELECT cluster_id, CAST(k AS INTEGER) AS step_of_one, CAST(k // 2 AS INTEGER) AS step_of_two FROM splits WHERE split = 'forget'")
def q18_forget_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each identity is forgotten, with one and with two of them in a step."""
    ids = distinct_ids(attributes(spark, sf_dir))
    one = special_ids(ids, 4, 6, per_step=1).where("split = 'forget'").select("cluster_id", F.col("forget_step").alias("step_of_one"))
    two = special_ids(ids, 4, 6, per_step=2).where("split = 'forget'").select("cluster_id", F.col("forget_step").alias("step_of_two"))
    return one.join(two, "cluster_id")


@_query(f"WITH {_DATA} SELECT * FROM dataset")
def q19_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest and attributes joined, splits by identity, unknown ages dropped after that."""
    attrs = attributes(spark, sf_dir)
    manifest = _table(spark, sf_dir, "events").select(F.col("event_id").alias("image_key"), F.col("user_id").alias("cluster_id"))
    joined = join_one_to_one(manifest, attrs.select("image_key", age_group(F.col("age")).alias("age_group")), "image_key")
    special = special_ids(distinct_ids(joined), 4, 6)
    return drop_unknown(apply_split(joined, special)).select("image_key", "cluster_id", "age_group", "split", "forget_step")


@_query(f"WITH {_DATA} SELECT split, count(*) AS n FROM dataset GROUP BY split")
def q20_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_sizes(q19_dataset(spark, sf_dir))


@_query(f"WITH {_DATA} SELECT CAST(age_group AS INTEGER) AS age_group, {_LABEL} AS label, count(*) AS n FROM dataset WHERE split = 'retain' GROUP BY ALL")
def q21_retain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_distribution(q19_dataset(spark, sf_dir))


@_query("""WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY md5('42:' || p_partkey), p_partkey) - 1 AS k FROM part)
SELECT p_partkey, CASE WHEN k < 50 THEN 'seed' ELSE 'style' END AS pool, CAST(k % 50 AS INTEGER) AS idx FROM r WHERE k < 100""")
def q22_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds, styles = split_pools(_table(spark, sf_dir, "part").select("p_partkey"), 50, 42, "p_partkey")
    return seeds.select("p_partkey", F.lit("seed").alias("pool"), F.col("identity_id").alias("idx")).unionAll(styles.select("p_partkey", F.lit("style").alias("pool"), F.col("style_idx").alias("idx")))


@_query("""WITH f AS (SELECT l_orderkey, min(l_linenumber) AS attempt FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey AS image, f.attempt, round(max(l_quantity * l_extendedprice), 4) AS area, count(*) AS faces
FROM lineitem JOIN f USING (l_orderkey) WHERE l_linenumber = f.attempt GROUP BY ALL""")
def q23_best_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as faces: order = image, line number = attempt, a box of quantity by price."""
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("attempt"), F.col("l_partkey").alias("face_idx"), F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity"), F.col("l_extendedprice")).alias("bbox"))
    return best_detection(lines).select("image", "attempt", F.round("area", 4).alias("area"), "faces")


@_query(f"""WITH {_CAND}, kept AS (SELECT identity_id, event_id, CAST(before AS INTEGER) AS accepted_idx FROM counted WHERE valid AND before < 5),
top AS (SELECT identity_id FROM (SELECT DISTINCT identity_id FROM kept) ORDER BY md5('42:' || identity_id), identity_id LIMIT 6)
SELECT identity_id, event_id, accepted_idx FROM kept JOIN top USING (identity_id) WHERE accepted_idx < 9""")
def q24_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection_sample(accepted_only(judged(spark, sf_dir), 5), 6, 9).select("identity_id", "event_id", "accepted_idx")


@_query("SELECT url AS path FROM pages WHERE page_id % 2 <> 0 AND url NOT IN (SELECT url FROM pages WHERE page_id % 2 = 0) ORDER BY page_id DESC, url DESC LIMIT 1")
def q25_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest page that was not there before; pages with even ids were."""
    pages = _table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.col("page_id").alias("modificationTime"))
    return newest_new_file(pages, pages.where("modificationTime % 2 = 0"))


_PART = 40


@_query(f"""WITH {_DATA}, placed AS (SELECT cluster_id, (row_number() OVER (ORDER BY cluster_id) - 1) // {_PART} AS part FROM splits WHERE split = 'retain')
SELECT (SELECT count(*) FROM dataset) AS total_images, (SELECT count(*) FROM splits) AS n_clusters, 'identity-conditioned synthetic variants' AS identity_source, CAST(4 AS INTEGER) AS n_forget,
  (SELECT count(*) FROM splits WHERE split = 'retain') AS n_retain,
  (SELECT string_agg(cluster_id, ',' ORDER BY k) FROM splits WHERE split = 'forget') AS forget_clusters,
  (SELECT string_agg(cluster_id, ',' ORDER BY k) FROM splits WHERE split = 'test') AS test_clusters,
  (SELECT string_agg(split || '=' || n, ',' ORDER BY split) FROM (SELECT split, count(*) AS n FROM dataset GROUP BY split)) AS split_sizes,
  (SELECT string_agg(label || '=' || n, ',' ORDER BY label) FROM (SELECT {_LABEL} AS label, count(*) AS n FROM dataset WHERE split = 'retain' GROUP BY 1)) AS label_distribution_retain,
  CAST(NULL AS BIGINT) AS part, CAST(NULL AS VARCHAR) AS retain_clusters
UNION ALL SELECT NULL, NULL, NULL, NULL, count(*), NULL, NULL, NULL, NULL, CAST(part AS BIGINT), string_agg(cluster_id, ',' ORDER BY cluster_id) FROM placed GROUP BY part""")
def q26_dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the dataset in one row, its lists and maps as text, and all retained ids in rows of at most 40."""
    ids = distinct_ids(attributes(spark, sf_dir))
    special = special_ids(ids, 4, 6)
    one = dataset_summary(settle(q19_dataset(spark, sf_dir)), ids, special, 4)
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))).alias(c)
    maps = {c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",") for c in ("split_sizes", "label_distribution_retain")}
    one = one.withColumns({c: listed(c) for c in ("forget_clusters", "test_clusters")} | maps)
    parts = retained_parts(ids, special, _PART).select("part", F.col("n_ids").alias("n_retain"), listed("clusters").alias("retain_clusters"))
    return one.unionByName(parts, allowMissingColumns=True)


@_query("""WITH r AS (SELECT o_custkey, count(*) AS orders, md5('7:' || o_custkey) AS h FROM orders GROUP BY o_custkey)
SELECT o_custkey, orders, CAST(row_number() OVER (ORDER BY h, o_custkey) - 1 AS BIGINT) AS hash_rank FROM r QUALIFY hash_rank < 500""")
def q27_large_hash_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First by hash the way that large samples take: whole hash prefixes, and a rank in the one on the border."""
    customers = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    ranked = first_by_hash(customers, 500, 7, "o_custkey", top_rows=0)
    return ranked.select("o_custkey", "orders", F.col("hash_rank").cast("long").alias("hash_rank"))


@_query("""SELECT l_orderkey AS image, count(*) AS n FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F') GROUP BY 1""")
def q28_unmatched_detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images whose order isn't finished, with how many faces they have: completeness over large tables."""
    finished = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("image"))
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"))
    return missing_rows(lines, finished, "image").groupBy("image").agg(F.count("*").alias("n"))


@_query(f"WITH {_DATA} SELECT age_group, label, n FROM (SELECT CAST(age_group AS INTEGER) AS age_group, {_LABEL} AS label, count(*) AS n FROM grouped GROUP BY ALL)")
def q29_age_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age groups that occur, with labels."""
    rows = attributes(spark, sf_dir).select(age_group(F.col("age")).cast("int").alias("age_group"))
    return rows.groupBy("age_group").agg(F.count("*").alias("n")).select("age_group", age_group_label(F.col("age_group")).alias("label"), "n")


_PARTS = r"""WITH n AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS filename FROM pages),
p AS (SELECT *, regexp_extract(filename, '^.+(\.[^.]+)$', 1) AS suffix FROM n),
q AS (SELECT page_id, filename, suffix, left(filename, length(filename) - length(suffix)) AS stem FROM p) """


@_query(_PARTS + "SELECT page_id, filename, suffix, stem, stem || '_face.jpg' AS processed_name FROM q")
def q30_path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File name, stem, suffix and processed name of every page's address."""
    pages = _table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    return with_path_parts(pages).select("page_id", "filename", "suffix", "stem", "processed_name")


@_query(_PARTS + "SELECT stem, count(*) AS n FROM q GROUP BY stem HAVING count(*) > 1")
def q31_stem_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stem_collisions(with_path_parts(_table(spark, sf_dir, "pages").select(F.col("url").alias("path"))))


@_query("""WITH d AS (SELECT *, CAST(l_linenumber % 3 AS DOUBLE) / 4 AS ratio FROM lineitem),
p AS (SELECT l_orderkey AS image, l_linenumber AS attempt, l_partkey AS face_idx, floor(200 * ratio) AS px, floor(101 * ratio) AS py, l_quantity, l_extendedprice FROM d)
SELECT image, attempt, face_idx, round(10 - px, 6) AS x0, round(20 - py, 6) AS y0, round(l_quantity - px, 6) AS x1, round(l_extendedprice - py, 6) AS y1 FROM p""")
def q32_unpad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of line items, found in padded copies of a 200 by 101 image, in the image's own coordinates."""
    box = F.array(F.lit(10.0), F.lit(20.0), F.col("l_quantity"), F.col("l_extendedprice"))
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("attempt"), F.col("l_partkey").alias("face_idx"), box.alias("bbox"), F.array(F.array(F.lit(1.0), F.lit(1.0))).alias("kps"), F.lit(101).alias("height"), F.lit(200).alias("width"), ((F.col("l_linenumber") % 3) / F.lit(4.0)).alias("ratio"))
    moved = unpad_detections(lines)
    return moved.select("image", "attempt", "face_idx", *(F.round(F.col("bbox")[k], 6).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))))


@_query(f"""WITH {_CAND} SELECT CAST(count(DISTINCT identity_id) AS INTEGER) AS n_identities, CAST(5 AS INTEGER) AS images_per_identity, count(*) FILTER (before < 5 AND valid) AS accepted, count(*) FILTER (before < 5 AND NOT valid) AS rejected,
  CAST(0.45 AS DOUBLE) AS min_similarity, CAST(20 AS DOUBLE) AS blur_threshold, CAST(42 AS INTEGER) AS seed FROM counted""")
def q33_generation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(spark, sf_dir)
    n = distinct_ids(rows, "identity_id").count()
    return generation_summary(admit_first_k(rows, 5), n, 5, 0.45, 20.0, 42)


@_query(f"""WITH {_CAND}, n AS (SELECT identity_id, rejection_reason, count(*) AS n FROM counted WHERE before < 5 AND NOT valid GROUP BY ALL)
SELECT identity_id, string_agg(rejection_reason || '=' || n, ',' ORDER BY rejection_reason) AS reasons FROM n GROUP BY identity_id""")
def q34_rejection_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons and their counts of each identity, as text."""
    _, rejected = split_admission(admit_first_k(judged(spark, sf_dir), 5))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return rejection_maps(rejected).select("identity_id", text.alias("reasons"))


@_query("SELECT vec_id, round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6) AS norm FROM embeddings")
def q35_l2_norm_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select("vec_id", F.round(l2_norm_batch(F.col("embedding")), 6).alias("norm"))


@_query("SELECT (SELECT count(*) FROM documents) AS n_listed, least(100, (SELECT count(*) FROM documents)) AS n_sampled")
def q36_sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    return sample_counts(docs, sample_cap(docs, 100, 42, "doc_id"))


@_query("""WITH c AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) / CAST(100 AS DOUBLE) AS similarity, event_id % 11 = 0 AS lost, event_id % 7 AS kind FROM events),
r AS (SELECT event_id, lost, CASE WHEN event_type = 'error' THEN 'no_face' WHEN kind IN (1, 2) THEN 'invalid_embedding' WHEN similarity < 0.45 THEN 'low_similarity' END AS identity, CASE WHEN value < 20 THEN 'blur' END AS blur FROM c)
SELECT event_id, CASE WHEN lost THEN 'unreadable_image' ELSE coalesce(nullif(concat_ws('+', identity, blur), ''), 'accepted') END AS verdict FROM r""")
def q65_all_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine verdicts: of seven norms one is zero and one is not a number, and every eleventh image can't be read."""
    kind = F.col("event_id") % 7
    norm = F.when(kind == 1, F.lit(0.0)).when(kind == 2, F.lit(float("nan"))).otherwise(1.0 + kind)
    verdict = classify_candidate(F.col("event_type") != "error", norm, F.col("similarity"), F.col("laplacian_variance"), 0.45, 20.0, F.col("event_id") % 11 != 0)
    return candidates(spark, sf_dir).select("event_id", verdict.alias("verdict"))


@_query("""WITH d AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'), f AS (SELECT l_orderkey, min(l_linenumber) AS attempt FROM d GROUP BY l_orderkey),
b AS (SELECT d.l_orderkey AS image, f.attempt, count(*) AS faces FROM d JOIN f ON d.l_orderkey = f.l_orderkey AND d.l_linenumber = f.attempt GROUP BY ALL)
SELECT image, attempt, faces FROM b UNION ALL SELECT o_orderkey, NULL, 0 FROM orders WHERE o_orderkey NOT IN (SELECT image FROM b)""")
def q66_faceless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as images, returned lines as faces: the attempt with the best face, and the images in which none was found."""
    lines = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    faces = lines.select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("attempt"), F.col("l_partkey").alias("face_idx"), F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity"), F.col("l_extendedprice")).alias("bbox"))
    images = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image"))
    none = without_detection(images, faces).select("image", F.lit(None).cast("int").alias("attempt"), F.lit(0).cast("long").alias("faces"))
    return best_detection(faces).select("image", "attempt", "faces").unionByName(none)


@_query("""WITH d AS (SELECT *, CAST(l_linenumber % 3 AS DOUBLE) / 4 AS ratio FROM lineitem), p AS (SELECT *, floor(200 * ratio) AS px, floor(101 * ratio) AS py FROM d)
SELECT l_orderkey AS image, l_linenumber AS attempt, l_partkey AS face_idx, CAST(t.point AS INTEGER) AS point, round(l_quantity + t.point - px, 6) AS x, round(l_extendedprice / (t.point + 1) - py, 6) AS y FROM p, (SELECT unnest(range(5)) AS point) t""")
def q67_unpad_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five key points of each line item's face, found in padded copies of a 200 by 101 image, in the image's own coordinates."""
    points = F.array(*(F.array(F.col("l_quantity") + k, F.col("l_extendedprice") / (k + 1)) for k in range(5)))
    box = F.array(*(F.lit(0.0) for _ in range(4)))
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("attempt"), F.col("l_partkey").alias("face_idx"), box.alias("bbox"), points.alias("kps"), F.lit(101).alias("height"), F.lit(200).alias("width"), ((F.col("l_linenumber") % 3) / F.lit(4.0)).alias("ratio"))
    each = unpad_detections(lines).select("image", "attempt", "face_idx", F.posexplode("kps").alias("point", "p"))
    return each.select("image", "attempt", "face_idx", "point", F.round(F.col("p")[0], 6).alias("x"), F.round(F.col("p")[1], 6).alias("y"))
