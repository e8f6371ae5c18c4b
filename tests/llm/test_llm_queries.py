"""The registered queries: against SQL where there is some, and their columns, at small sizes."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tablemend.llm.queries import QUERIES
from tablemend.llm.sql import SQL

COLUMNS = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op2_decontaminate": "doc_id item_id start_word n_words n_equal",
    "op3_lines": "page_id host text n_lines n_dropped",
    "op4_topk": "query_id rank vec_id score",
    "op5_quality": "doc_id held_out score predicted",
    "op6_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7_jaccard": "doc_id n_shingles component_id",
    "op8_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_substrings": "doc_id n_words n_removed kept_sha256",
    "op10_language": "doc_id held_out lang_pred score",
    "op11_token_files": "doc_id start n_tokens ids_crc32",
    "op12_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley",
    "op13_collocations": "lang rank phrase a l r n score",
}


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(r[i] for i in order) for r in rows)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name, scale):
    sf_dir = f"/root/testdata/{scale}"
    df = QUERIES[name](spark, sf_dir)
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    want = con.execute(SQL[name])
    assert _table(df.columns, df.collect()) == _table([c[0] for c in want.description], want.fetchall())


def test_columns_and_registration(spark):
    registered = entry_points.queries()
    assert "pipeline" in registered
    for name, columns in COLUMNS.items():
        assert registered[name] is QUERIES[name]
    assert set(QUERIES) == set(COLUMNS)


#: Their contracts give rows per part, order and step, and per phrase.
OTHER_ROWS = {"op2_decontaminate", "op4_topk", "op12_filter_audit", "op13_collocations"}


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - OTHER_ROWS))
def test_one_row_for_each_input_row(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf_dir)
    table = "pages" if name == "op3_lines" else "documents"
    assert df.columns == COLUMNS[name].split()
    assert df.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_rows_of_audit_and_collocations(spark):
    sf_dir = "/root/testdata/sf0.001"
    parts = {r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("coalesce(lang, '')").distinct().collect()}
    audit = QUERIES["op12_filter_audit"](spark, sf_dir)
    assert audit.columns == COLUMNS["op12_filter_audit"].split()
    assert audit.count() == audit.select("part", "filter_order", "step").distinct().count() == len(parts) * 120 * 5
    found = QUERIES["op13_collocations"](spark, sf_dir)
    assert found.columns == COLUMNS["op13_collocations"].split()
    ranks = {}
    for r in found.select("lang", "rank").collect():
        ranks.setdefault(r[0], []).append(r[1])
    assert ranks and all(sorted(got) == list(range(1, len(got) + 1)) and len(got) <= 2000 for got in ranks.values())
