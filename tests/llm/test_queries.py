"""The registered queries: columns, and results against SQL where SQL can express them."""

from __future__ import annotations

import pytest

from tests.oracle_compare import compare, connect
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES

COLUMNS = {
    "op1_exact_top_k": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op2_entropy_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op3_quadratic_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_recurrent_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_best_fit_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op7_balanced_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op8_license_digests": "doc_id bigint, license string, part_licenses string, n_parts bigint, n_rows bigint",
    "op9_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op10_indexed_tokens": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op11_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
    "n_strays bigint, complete boolean",
    "op12_turn_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string",
    "op13_target_sampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}


def test_all_are_here():
    assert set(QUERIES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, folder, name):
    result = QUERIES[name](spark, folder)
    assert ", ".join(f"{n} {t}" for n, t in result.dtypes) == COLUMNS[name]
    if name in ORACLE_SQL:
        assert compare(result, connect(folder), ORACLE_SQL[name]) == []
    elif name != "op6_best_fit_packing":
        if name == "op12_turn_repair":
            expected = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id").distinct()
        else:
            expected = spark.read.parquet(f"{folder}/documents.parquet")
        assert result.count() == expected.count()
