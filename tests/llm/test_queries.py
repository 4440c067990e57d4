"""The registered queries on a test table: columns, whole results, plans without nested loops."""

import os
import zlib
from collections import Counter
from functools import cache

import pytest

from bizregistry.llm.queries import QUERIES
from bizregistry.session import configure

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

# Fixed columns of the results; more may follow.
COLUMNS = {
    "op1_simhash": "doc_id fingerprint component_id",
    "op2_quality": "doc_id held_out score predicted",
    "op3_top_k": "query_id rank vec_id score",
    "op4_bpe_round_trip": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "quality_base": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed",
    "op6_token_counts": "length",
    "op7_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op10_line_dedup": "doc_id n_lines n_dropped kept_sha256",
    "op11_period_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_ngram_join": "doc_id n_shingles component_id",
    "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
}
# A row for each document.
WHOLE = {key for key in COLUMNS if key.startswith("op") and "doc_id" in COLUMNS[key].split()} - {"op7_packing"}
NATIVE = {"op8_sharding", "op10_line_dedup"}


@pytest.fixture(scope="module")
def results(spark):
    return cache(lambda key: QUERIES[key](configure(spark), SF).cache())


def test_all_queries_are_listed():
    assert QUERIES.keys() == COLUMNS.keys()


@pytest.mark.parametrize("key", COLUMNS)
def test_query(spark, results, key):
    df = results(key)
    assert set(COLUMNS[key].split()) <= set(df.columns)
    rows = df.collect()
    assert rows
    if key in WHOLE:
        docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if key in NATIVE:
        assert not any(sign in plan for sign in ("Python", "InArrow", "InPandas"))


def test_simhash_digits(results):
    """Sixteen lowercase hex digits; blank texts have fingerprint zero."""
    rows = results("op1_simhash").collect()
    assert all(len(r.fingerprint) == 16 and int(r.fingerprint, 16) >= 0 for r in rows)
    assert all(r.fingerprint == r.fingerprint.lower() and r.component_id <= r.doc_id for r in rows)


def test_held_out_rows_and_verdicts(results):
    for r in results("op2_quality").collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_packing_is_gapless(results):
    ends = {}
    for r in sorted(results("op7_packing").collect(), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024


def test_slots_are_gapless(results):
    slots = {}
    for r in results("op8_sharding").collect():
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())
    assert set(slots) <= set(range(40))
