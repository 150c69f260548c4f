import re

import duckdb
import pytest

from ledgerline.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    assert sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(map(str, want.fetchall()))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_contract_columns(spark, name):
    want = {
        "op1_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        "op2_jaccard": "doc_id bigint, n_shingles bigint, component_id bigint",
        "op3_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        "op4_language": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op5_main_text": "page_id bigint, url string, text string, n_chars bigint",
        "op8_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
        "op10_maxscore": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op11_chat": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
        "op12_targets": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
        "op13_periodic": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    }.get(name)
    if want:
        have = dict(queries.QUERIES[name](spark, SF).dtypes)
        assert all(have[c.split()[0]] == c.split()[1] for c in want.split(", "))
