"""The registered queries return their contracts' columns over whole tables."""

import duckdb
import pytest

from rosterforge.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_lm_scoring": {"doc_id", "score"},
    "op2_kneser_ney": {"doc_id", "log_perplexity", "keep"},
    "op3_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op4_simhash": {"doc_id", "fingerprint", "component_id"},
    "op5_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op6_merkle": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"},
    "op7_line_templates": {"doc_id", "text", "n_dropped"},
    "op8_token_counts": {"doc_id", "n_tokens"},
    "op9_nra": {"query_id", "rank", "vec_id", "score"},
    "op10_sanitise": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op11_interaction": {"part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"},
    "op12_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op13_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
}


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(df.columns)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, rows = docs.count(), df.count()
    known = {"op9_nra": 50, "op11_interaction": 600 * docs.select("source").distinct().count(), "op13_whitening": 8 * 500}
    assert rows >= n if name == "op5_packing" else rows == known.get(name, n)


@pytest.mark.parametrize("name", SQL)
def test_rows_are_the_sqls(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.01/{t}.parquet'")
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, "/root/testdata/sf0.01").select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
