"""The registered queries: those with an oracle against DuckDB, all on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as se
from tessera.llm import queries
from tessera.sources.tables import TABLE_NAMES, table_path
from tools.oracle_check import digest

#: Columns that the contracts name.
COLUMNS = {
    "op1_embedding_near_dedup": "vec_id n_links component_id kept",
    "op2_toxicity": "doc_id held_out score predicted",
    "op3_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op4_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5_minhash_near_dedup": "doc_id n_shingles component_id kept",
    "op6_html_text": "page_id url text n_chars",
    "op7_context_mixing": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op9_source_mix": "doc_id size source_size target taken",
    "op11_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
}
NATIVE = {"op8_preference_pairs", "op9_source_mix"}
TABLE = {1: "embeddings", 6: "pages"}


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_oracle(spark, small_dir, key):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{table_path(small_dir, t)}')")
    df = queries.QUERIES[key](spark, small_dir)
    found = con.execute(se.oracle_sql()[key])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, found.fetchall())


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_a_row_for_each_row_of_the_table(spark, small_dir, key):
    df = queries.QUERIES[key](spark, small_dir)
    assert df.columns[:len(COLUMNS[key].split())] == COLUMNS[key].split()
    table = TABLE.get(int(key[2:].split("_")[0]), "documents")
    assert df.count() == spark.read.parquet(table_path(small_dir, table)).count()


@pytest.mark.parametrize("key", sorted(NATIVE))
def test_native_plans_hold_no_python(spark, small_dir, key):
    plan = queries.QUERIES[key](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "MapPartitions", "CartesianProduct"))
