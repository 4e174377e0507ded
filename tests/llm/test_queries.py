"""The registered queries: against their SQL where they have some, else for rows and columns."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from compare import connect, difference, spark_side, sql_side
from tideglass.llm.oracle import ORACLE
from tideglass.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
COLUMNS = {
    "op4_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_near_duplicates": ["doc_id", "class_id", "kept"],
    "op6_extract_text": ["page_id", "url", "text", "n_chars"],
    "op7_find_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
}


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())
    assert set(QUERIES) == set(ORACLE) | set(COLUMNS)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    names, rows = spark_side(QUERIES[name](spark, SF_DIR))
    assert rows and difference(names, rows, *sql_side(connect(SF_DIR), ORACLE[name])) is None


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_has_a_row_for_each_input_row(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns == COLUMNS[name]
    table = "pages" if name.startswith("op6") else "documents"
    assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
