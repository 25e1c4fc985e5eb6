"""The registered queries of the subpackage on the smallest tables: against DuckDB where SQL can
express them, and their columns and types by contract."""

import duckdb
import pytest

import __spark_entry__ as E
from flowmart.llm import oracle

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_model": {"doc_id": "bigint", "expected_grade": "double", "p_top": "double", "kept": "boolean"},
    "op2_secret_scan": {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint",
                        "base_sha256": "string", "spans": "string"},
    "op3_token_output": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op4_near_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op5_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
                     "slot": "bigint", "grown_shard": "int"},
    "op6_decontaminate": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint",
                          "items_sha256": "string", "contaminated": "boolean"},
    "op7_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
                "base_sha256": "string", "spans": "string"},
    "op8_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                          "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
                          "kept": "boolean"},
    "op9_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double",
                   "taken": "bigint"},
    "op10_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op11_centroids": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
                       "inertia": "bigint", "centroid_sha256": "string"},
    "op12_chat_format": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint",
                         "loss_sha256": "string", "formatted_chars": "bigint"},
    "op13_collocations": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint",
                          "r": "bigint", "n": "bigint", "score": "bigint"},
}
#: rows of the result from the tables, where they are not the documents
ROWS = {"op11_centroids": ("embeddings", "count(*)", 0), "op12_chat_format": ("conversations",
                                                                            "count(DISTINCT conv_id)", 1)}


def test_one_query_per_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(names) == sorted(COLUMNS) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SF)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    if name != "op13_collocations":
        table, rows, more = ROWS.get(name, ("documents", "count(*)", 0))
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").selectExpr(rows).first()[0] + more


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF)
    res = con.execute(oracle.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(res.fetchall())
