"""Registered queries against their SQL, and the pipeline against its parts."""

import duckdb
import pytest

import corpus_pipeline
from llm import quality, wrappers
from llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    keys = sorted(want.columns)
    assert sorted(got.columns) == keys
    # convert_dtypes: a nullable BIGINT reaches pandas as float64 from Spark, as Int64 from DuckDB 2
    show = lambda d: d[keys].convert_dtypes().sort_values(keys).astype(str).reset_index(drop=True)
    assert show(got).equals(show(want))


def test_pipeline_equals_its_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() <= n
        n = docs.count()
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "byte_bpe"]
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))


def test_html_blocks_are_joined_by_two_newlines(spark, tmp_path):
    page = "<article><h1>Head</h1><p>One<br>line<p>two</article>"
    spark.createDataFrame([(1, "http://a.com/1", page)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert [(r.text, r.n_chars) for r in QUERIES["op9_html_wrappers"](spark, str(tmp_path)).collect()] == [("Head\n\nOne line\n\ntwo", 19)]


def pages_of(spark, *pages):
    return spark.createDataFrame([(i, "http://a.com/x", p) for i, p in enumerate(pages)], "page_id long, url string, html string")


def test_blanks_between_inline_elements_stay(spark):
    got = wrappers.extract(pages_of(spark, "<article><p><b>one</b> <i>two</i></p><p>a</p> <p>b <b>c</b></p></article>"), "\n\n").first()
    assert got.text == "one two\n\na\n\nb c"


def test_words_of_a_name_do_not_take_article_text_away(spark):
    page = "<article><p>Start</p><section class='related-work'>Earlier work.</section><div class='share-price'>Up 3 %.</div><div class='related-posts'>Read more</div><div class='comments'>Nice!</div><div class='share'>Post it</div><div class='ad-leaderboard'>Buy</div></article>"
    assert wrappers.extract(pages_of(spark, page), "\n\n").first().text == "Start\n\nEarlier work.\n\nUp 3 %."


def test_a_column_named_like_the_score_stays(spark):
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "BAD!! ") * 20, 7.0) for i in range(60)], "doc_id long, text string, quality_score double")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.quality_score for r in kept.collect()} == {7.0}


def test_stages_on_an_empty_table(spark, tmp_path):
    """No documents, no labels and no benchmark items give no rows, with the columns of documents until the last stage."""
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.collect() == []
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
