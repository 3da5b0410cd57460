import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from rollcall.operators import admission, candidates, chunks, joins, sampling, splits, summaries


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.booleans()), max_size=40), st.integers(1, 4))
def test_admission_is_a_loop_with_early_exit(spark, flips, k):
    trials, rows = {}, []
    for identity, ok in flips:
        trials[identity] = trials.get(identity, -1) + 1
        rows.append((identity, trials[identity], "accepted" if ok else "blur"))
    want, taken = set(), {}
    for identity, trial, reason in rows:
        if taken.get(identity, 0) < k:
            idx = taken.get(identity, 0) if reason == "accepted" else None
            want.add((identity, trial, idx))
            taken[identity] = taken.get(identity, 0) + (reason == "accepted")
    df = spark.createDataFrame(rows, "identity_id int, trial int, rejection_reason string")
    kept = admission.admit_first_k(df, k)
    assert {(r["identity_id"], r["trial"], r["accepted_idx"]) for r in kept.collect()} == want
    again = admission.admit_first_k(kept.drop("valid", "accepted_idx"), k)
    assert again.count() == len(want)
    only = {(r["identity_id"], r["trial"], r["accepted_idx"]) for r in admission.accepted_only(df, k).collect()}
    assert only == {w for w in want if w[2] is not None}


def test_shortfalls_name_identities_without_rows(spark):
    plan = spark.createDataFrame([(0,), (1,), (2,)], "identity_id int")
    admitted = admission.admit_first_k(spark.createDataFrame([(0, 0, "accepted"), (1, 0, "blur")], "identity_id int, trial int, rejection_reason string"), 1)
    assert sorted((r[0], r[1]) for r in admission.shortfalls(plan, admitted, 1).collect()) == [(1, 0), (2, 0)]
    with pytest.raises(ValueError, match="2 identities .* 1: 0 of 1, .'blur': 1.; 2: 0 of 1"):
        admission.require_filled(plan, admitted, 1)
    row = admission.generation_summary(admitted, 3, 1, 0.45, 80.0, 42).first()
    assert (row["accepted"], row["rejected"]) == (1, 1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, 0, 1, 2]), st.booleans()), min_size=1, max_size=60), st.integers(1, 4), st.integers(1, 5))
def test_admission_in_two_phases_is_the_same(spark, flips, k, block):
    trials, rows = {}, []
    for identity, ok in flips:
        trials[identity] = trials.get(identity, -1) + 1
        rows.append((identity, trials[identity], "accepted" if ok else "blur", "x" * 20))
    df = spark.createDataFrame(rows, "identity_id int, trial int, rejection_reason string, wide string")
    want = sorted(map(repr, admission.admit_first_k(df, k).collect()))
    got = admission.admit_in_two(df, k, block=block)
    assert sorted(map(repr, got.select(admission.admit_first_k(df, k).columns).collect())) == want


def test_rows_after_the_cut_off_are_not_shuffled(spark):
    df = spark.range(5000).select((F.col("id") % 5).alias("identity_id"), F.floor(F.col("id") / 5).alias("trial"), F.lit("accepted").alias("rejection_reason"))
    cuts = admission.cut_offs(df.withColumn("valid", F.lit(True)), 20)
    assert sorted(map(tuple, cuts.collect())) == [(k, 1) for k in range(5)]
    got = admission.admit_in_two(df, 20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 100 and plan.index("Window") < plan.index("BroadcastHashJoin")


def test_block_similarity_at_512_dimensions(spark):
    import numpy as np

    rng = np.random.default_rng(8)
    rows = [(k, k % 3, rng.normal(size=512).tolist()) for k in range(60)] + [(60, 0, None), (61, 0, [0.0] * 512), (62, 1, [float("nan")] * 512), (63, 7, rng.normal(size=512).tolist()), (64, 2, [None, *[1.0] * 511])]
    df = spark.createDataFrame(rows, "vec_id int, identity_id int, embedding array<float>")
    seeds = candidates.seed_vectors(df.where("vec_id < 3"))
    joined = candidates.attach_seed(df, seeds)
    want = {r["vec_id"]: r for r in candidates.with_similarity(joined).collect()}
    got = candidates.with_similarity_in_blocks(joined)
    assert got.columns == candidates.with_similarity(joined).columns
    for r in got.collect():
        w = want[r["vec_id"]]
        for c in ("norm", "arcface_similarity"):
            assert (r[c] is None) == (w[c] is None) and (r[c] is None or r[c] == pytest.approx(w[c], nan_ok=True)), (r["vec_id"], c)
    assert got.where("identity_id = 9").count() == 0


def test_one_to_one_names_the_side(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2)], "p string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "p string, w int")
    with pytest.raises(SparkRuntimeException, match="left side: x"):
        joins.join_one_to_one(a, b, "p").count()
    with pytest.raises(SparkRuntimeException, match="right side: x"):
        joins.join_one_to_one(b, a, "p").count()
    with pytest.raises(SparkRuntimeException, match="left and the right side: x"):
        joins.join_one_to_one(a, a, "p").count()
    # a key that repeats without a match is an error too
    with pytest.raises(SparkRuntimeException, match="left side: x"):
        joins.join_one_to_one(a, b.where("p = 'y'"), "p").count()
    good = joins.join_one_to_one(b, b.withColumnRenamed("w", "z"), "p")
    assert good.count() == 2 and good.columns == ["p", "w", "z"]
    assert joins.join_one_to_one(b, b.where("p = 'y'").withColumnRenamed("w", "z"), "p").collect() == [("y", 2, 2)]
    with pytest.raises(SparkRuntimeException, match="rows have no match: x"):
        joins.join_one_to_one(b, b.where("p = 'y'"), "p", complete=True).count()
    with pytest.raises(ValueError, match="1 rows"):
        joins.require_complete(b, a, "p")


def test_guards_shuffle_each_side_once(spark):
    a = spark.range(1000).withColumnRenamed("id", "k").withColumn("v", F.lit(1))
    b = spark.range(1000).withColumnRenamed("id", "k").withColumn("w", F.lit(2))
    plan = joins.join_one_to_one(a, b, "k", complete=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_seeds_without_a_vector_end_the_job(spark):
    seeds = spark.createDataFrame([(1, [3.0, 4.0]), (7, [0.0, 0.0])], "identity_id int, embedding array<double>")
    with pytest.raises(SparkRuntimeException, match="identity 7"):
        candidates.seed_vectors(seeds).collect()
    assert candidates.seed_vectors(seeds, strict=False).where("identity_id = 1").first()["seed_unit"] == [0.6, 0.8]


def test_guards():
    for bad in ({"chunk_size": 0}, {"candidates": 3, "images": 4}, {"sources": 7, "identities": 4}, {"identities": 10, "n_forget": 4, "n_test": 6}):
        with pytest.raises(ValueError):
            joins.require_plan(**bad)
    joins.require_plan(chunk_size=1, candidates=4, images=4, sources=8, identities=4, n_forget=1, n_test=2)


def test_splits_are_whole_disjoint_and_stable(spark):
    ids = spark.range(50).withColumnRenamed("id", "cluster_id")
    got = {r[0]: (r[1], r[2]) for r in splits.assign_splits(ids, 8, 12).collect()}
    assert got == {r[0]: (r[1], r[2]) for r in splits.assign_splits(ids.repartition(7), 8, 12).collect()}
    count = lambda s: sum(1 for v in got.values() if v[0] == s)
    assert (count("forget"), count("test"), count("retain")) == (8, 12, 30)
    assert sorted(v[1] for v in got.values() if v[0] == "forget") == list(range(8))
    two = splits.special_ids(ids, 8, 12, per_step=2).where("split = 'forget'").collect()
    assert sorted(r["forget_step"] for r in two) == [0, 0, 1, 1, 2, 2, 3, 3]
    with pytest.raises(ValueError):
        splits.special_ids(ids, 20, 30)


def test_numpy_order(spark):
    ids = spark.range(400).withColumnRenamed("id", "cluster_id")
    listed = [r["cluster_id"] for r in sampling.numpy_order(ids, "cluster_id", 42).orderBy("hash_rank").limit(10).collect()]
    assert listed == [209, 280, 33, 210, 93, 84, 329, 94, 266, 126]


def test_samples(spark):
    df = spark.range(300).withColumnRenamed("id", "path")
    small = [r["path"] for r in sampling.first_by_hash(df, 70, 1, "path").orderBy("hash_rank").collect()]
    large = [r["path"] for r in sampling.first_by_hash(df, 70, 1, "path", top_rows=0).orderBy("hash_rank").collect()]
    assert small == large and len(set(small)) == 70
    assert sampling.sample_cap(df, None).count() == sampling.sample_cap(df, 0).count() == sampling.sample_cap(df, 1000).count() == 300
    seeds, styles = sampling.split_pools(df, 20)
    assert seeds.join(styles, "path").count() == 0 and seeds.count() == styles.count() == 20
    with pytest.raises(ValueError):
        sampling.split_pools(df, 151)


def test_chunks(spark):
    df = spark.createDataFrame([(f"p{k:03d}", k % 3 == 0) for k in range(25)], "path string, ok boolean").repartition(5)
    rows = chunks.assign_chunks(df, 10, "path")
    assert [r["position"] for r in rows.orderBy("path").collect()] == list(range(25))
    manifest = chunks.chunk_manifest(rows, F.col("ok")).orderBy("chunk_id").collect()
    assert [tuple(r) for r in manifest] == [(1, 10, 4, 6, 0, 10), (2, 10, 3, 7, 10, 20), (3, 5, 2, 3, 20, 25)]
    assert chunks.assign_chunks(df.limit(0), 10, "path").count() == 0


def test_summaries_of_empty_tables(spark):
    empty = spark.createDataFrame([], "outcome string, age_group int, gender int, split string, embedding array<float>")
    funnel = summaries.preprocess_funnel(empty).first()
    assert funnel["total"] == 0 and funnel["yield_pct"] is None
    assert [r["n"] for r in summaries.age_distribution(empty, include_zero=True).collect()] == [0] * 5
    row = summaries.extraction_summary(empty, 3, 0).first()
    assert (row["extracted"], row["failed"], row["embedding_dim"]) == (0, 3, 512)


def test_an_identity_that_loses_all_images_is_counted(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "cluster_id int")
    special = splits.special_ids(ids, 1, 1)
    data = splits.apply_split(spark.createDataFrame([("a", 1, 0), ("b", 2, -1), ("c", 3, 1)], "image_path string, cluster_id int, age_group int"), special)
    row = summaries.dataset_summary(data.where("age_group <> -1"), ids, special, 1).first()
    assert row["n_clusters"] == 3 and row["total_images"] == 2
    kept = summaries.retained_parts(ids, special).first()["clusters"]
    assert sorted(row["forget_clusters"] + row["test_clusters"] + kept) == [1, 2, 3] and row["n_retain"] == 1
