"""Every query of the training-data operators and the pipeline as registered, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.test_entry import FOLDER, rows

duckdb = pytest.importorskip("duckdb")
public_tokenizers = pytest.importorskip("public_tokenizers")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

COLUMNS = {
    "op1": "doc_id n_words n_tokens n_unknown",
    "op2": "doc_id start n_tokens ids_crc32 shard",
    "op3": "conv_id perspective n_turns n_target rendered mask",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id n_shingles component_id kept",
    "op6": "vec_id n_links component_id kept recall",
    "op7": "doc_id item_id similarity start_word n_words",
    "op8": "doc_id size source_size target taken",
    "op9": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10": "page_id url text n_chars n_templates",
    "pipeline": "doc_id start n_tokens ids_crc32 shard",
}
SOURCES = {"op3": None, "op6": "embeddings", "op7": None, "op10": "pages", "pipeline": None}


def connected():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n.startswith("op") or n == "pipeline"))
def test_query_as_registered(spark, name):
    got = entry.queries()[name](spark, FOLDER)
    assert got.columns == COLUMNS[name.split("_")[0]].split()
    found = rows(got.columns, [tuple(r) for r in got.collect()])
    source = SOURCES.get(name.split("_")[0], "documents")
    if source:
        assert len(found[1]) == spark.read.parquet(f"{FOLDER}/{source}.parquet").count()
    if name in entry.oracle_sql():
        answer = connected().execute(entry.oracle_sql()[name])
        assert found == rows([c[0] for c in answer.description], answer.fetchall())
