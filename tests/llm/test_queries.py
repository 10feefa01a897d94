"""The registered queries on whole tables of sf0.001, and those with SQL against it."""

import duckdb
import pytest

from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256", "op3_language_id": "doc_id held_out lang_pred score",
    "op4_token_files": "doc_id start n_tokens ids_crc32", "op5_embedding_near_dedup": "vec_id n_links component_id kept",
    "op6_decontaminate": "doc_id n_words n_hit n_items items_sha256 contaminated", "op7_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op9_pack": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op10_simhash_near_dedup": "doc_id fingerprint component_id",
}
ROWS = {"op1_warc_derivatives": ("pages", 2), "op5_embedding_near_dedup": ("embeddings", 1), "op9_pack": None,
        "op12_conversation_trie": None, "op13_collocations": None}


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, name):
    got = REGISTRY[name](spark, SF)
    assert got.columns[:len(COLUMNS.get(name, "").split())] == COLUMNS.get(name, "").split()
    rows = got.collect()
    table = ROWS.get(name, ("documents", 1))
    if table:
        assert len(rows) == table[1] * spark.read.parquet(f"{SF}/{table[0]}.parquet").count()
    if name not in ORACLE:
        return
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    order = [got.columns.index(d[0]) for d in want.description]
    assert len(order) == len(got.columns)
    assert sorted(tuple(r[i] for i in order) for r in rows) == sorted(want.fetchall())
