"""The pipeline, and its queries, on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import canonical
from llm.queries import ORACLES, QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF).cache()
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "near_copies":
            kept = {c for _, _, c in brute.near(before)}
            assert set(after) == kept
        elif name == "substring_dedup":
            want = {k: text for k, _, gone, text in brute.substrings(before) if gone}
            assert {k: after[k] for k in want} == want
            assert all(after[k] == t for k, t in before if k not in want)
        else:
            assert len(after) >= 0.95 * len(before)
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.collect()}
    assert n >= docs.count() > 0.5 * n


def test_queries_over_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_substring_dedup", "op4_quality_model", "op5_piece_codec", "op6_ngram_join", "op8_line_dedup", "op9_language_id", "op10_quality_rules", "op12_decontamination"):
        assert QUERIES[name](spark, SF).count() == docs, name
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op1_substring_dedup"](spark, SF).collect()}
    assert got == {(k, n, gone, brute.sha(kept)) for k, n, gone, kept in brute.substrings(rows)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)


def test_language_stage_without_languages(spark):
    rows = [(1, "words here"), (2, None), (3, ""), (4, "12 34 _ !"), (5, "\u6f22\u5b57"), (6, "\u00b2"), (7, "\u2167")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for lang in (None, "en"):
        out = corpus_pipeline.language_stage(spark, docs.withColumn("lang", F.lit(lang).cast("string")), SF)
        assert sorted(r.doc_id for r in out.collect()) == [1, 5]


def test_emptied_texts_are_packed_as_closing_ids(spark):
    docs = spark.createDataFrame([(k, "first line\nsecond line") for k in (1, 2)], "doc_id bigint, text string")
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
    assert {r.doc_id: r.length for r in docs.collect()}[2] == 1
