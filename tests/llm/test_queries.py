"""Queries against their SQL, and the leading columns of each, over the smallest given tables."""

import os

import duckdb
import pytest

from rollcall.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op3_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op4_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op5_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op6_simhash": ["doc_id", "fingerprint", "component_id"],
    "op7_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op8_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op9_line_dedup": ["doc_id", "n_lines", "n_removed", "kept_bytes", "kept_sha256"],
    "op10_quality": ["doc_id", "n_features", "log_weight", "gumbel_sum", "kept"],
    "op11_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    "op12_align": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    "op13_lm_score": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables are not there")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, DATA)
    assert got.columns[: len(COLUMNS[name])] == COLUMNS[name]
    columns = sorted(got.columns)
    rows = got.select(*columns).collect()
    counted = {"op5_embedding_dedup": "count(*) FROM embeddings", "op11_repair": "count(DISTINCT conv_id) FROM conversations"}.get(name, "count(*) FROM documents")
    assert len(rows) == sql.execute(f"SELECT {counted}").fetchall()[0][0]
    if name in ORACLE_SQL:
        want = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
        assert sorted(repr(tuple(r)) for r in rows) == sorted(map(repr, want))
