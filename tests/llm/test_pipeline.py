"""The registered queries and the pipeline against the operators' brute-force meaning."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeops.llm import queries

SF = "/root/testdata/sf0.001"


def test_every_query_returns_whole_tables(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").count()
    of_other_rows = {"op11_prefix_trie", "op12_bin_slack", "op13_spelling"}        # nodes, pieces, words: tests of their own
    for name, query in queries.QUERIES.items():
        if name not in of_other_rows:
            rows = query(spark, SF)
            assert rows.count() == (spark.read.parquet(f"{SF}/pages.parquet").count() if "html" in name else documents), name


def test_oracle(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    for name, sql in queries.ORACLES.items():
        want = con.execute(sql)
        names = [d[0] for d in want.description]
        got = queries.QUERIES[name](spark, SF).select(*names).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want.fetchall(), key=str), name


def test_held_out_rule(spark):
    rows = queries.op5_language_id(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_pipeline(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    kept, expected = docs, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept, _ = corpus_pipeline.written(stage(spark, kept, SF), "test-stage")
        assert kept.columns == docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert ids(last) == ids(kept) and last.where("not decoded").count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert ids(run) == ids(kept)
    # the same by the operators' verdicts on the whole table
    first = queries.op8_exact_dedup(spark, SF).where("kept")
    expected = docs.where(F.rlike("text", F.lit(r"\p{L}"))).join(first.select("doc_id"), "doc_id", "left_semi")
    expected = expected.join(corpus_pipeline.simhash.near_duplicates(expected).where("doc_id = component_id").select("doc_id"),
                             "doc_id", "left_semi")
    dirty = queries.op6_decontamination(spark, SF).where("contaminated").select("doc_id")
    assert ids(run) == ids(expected.join(dirty, "doc_id", "left_anti"))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs.select(*docs.columns), SF).count() == 0
        stage(spark, odd_docs.select(*docs.columns), SF).count()


def test_extra_columns_pass_through_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["predicted", "score", "input", "digest", "id", "key", "fp", "kept", "copies", "nbest", "decoded", "piece_ids", "N_Tokens"]
    wide = docs.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in names})
    kept = plain = None
    for name, stage in corpus_pipeline.STAGES:
        kept, _ = corpus_pipeline.written(stage(spark, wide if kept is None else kept, SF), "test-wide")
        plain, _ = corpus_pipeline.written(stage(spark, docs if plain is None else plain, SF), "test-plain")
        assert kept.count() == plain.count() > 0
        where = {c: c if c in kept.columns and name != "sentencepiece" or c.lower() not in corpus_pipeline.ADDED else f"{c}_" for c in names}
        for c, at in where.items():
            assert kept.where(F.col(at) != F.concat(F.lit(f"{c}:"), F.col("doc_id"))).count() == 0, (name, c)
    assert set(plain.columns) <= set(kept.columns)


def test_without_labels_the_language_stage_keeps_texts_with_letters(spark):
    docs = spark.createDataFrame([(1, "words", None), (2, "123", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in corpus_pipeline.identify_language(spark, docs, SF).collect()] == [(1, "words", None)]


def test_scratch_tables_go_with_their_scope(spark):
    from lakeops.llm.common import scratch_scope, written
    from lakeops.session import path_exists
    with scratch_scope(spark) as outer:
        _, first = written(spark.range(3), "scope")
        with scratch_scope(spark) as inner:
            kept, second = written(spark.range(4), "scope")
            _, third = written(spark.range(5), "scope")
            inner.remove(second)
        assert not path_exists(spark, third) and path_exists(spark, first) and kept.count() == 4
        assert outer == [first]
    assert not path_exists(spark, first)
