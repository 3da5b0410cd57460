from rollcall.operators.summaries import dataset_summary, retained_parts


def test_all_retained_ids_are_listed_in_bounded_rows(spark):
    n = 100_050
    data = spark.createDataFrame([(1, "forget", 2), (2, "test", 2), (3, "retain", 2)], "cluster_id long, split string, age_group int")
    special = spark.createDataFrame([(1, "forget", 0), (2, "test", 0)], "cluster_id long, split string, hash_rank int")
    ids = spark.range(1, n + 1).withColumnRenamed("id", "cluster_id").repartition(5)
    row = dataset_summary(data, ids, special, 1).first()
    assert row["n_retain"] == n - 2 and (row["forget_clusters"], row["test_clusters"]) == ([1], [2])
    parts = sorted(retained_parts(ids, special, 1000).collect())
    assert [r["part"] for r in parts] == list(range(101)) and all(r["n_ids"] == len(r["clusters"]) <= 1000 for r in parts)
    assert [k for r in parts for k in r["clusters"]] == list(range(3, n + 1))
    assert retained_parts(ids.limit(0), special).count() == 0
