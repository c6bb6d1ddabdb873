"""Shapes of physical plans, and every query against its SQL on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import bindings
from agorastat.functions.sentiment import Lexicon
from agorastat.operators import aggregates as agg, clean, features, sentiment, text, trends as tr
from bindings import check
from bindings.registry import posts, raw_posts, table

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_core_operators_run_without_python_workers(spark):
    docs = table(spark, FOLDER, "documents")
    frames = [
        clean.question_features(clean.clean_posts(raw_posts(spark, FOLDER))),
        text.add_ngrams(text.preprocess(docs, "text")),
        sentiment.analyze(docs, "text", lexicon=Lexicon()),
        tr.trending_tags(tr.tag_trends(posts(spark, FOLDER))),
        tr.forecast(tr.tag_trends(posts(spark, FOLDER))),
    ]
    for df in frames:
        shape = plan(df)
        assert "Python" not in shape and "Pandas" not in shape and "Cartesian" not in shape


@needs_data
def test_expected_nodes(spark):
    series = tr.tag_trends(posts(spark, FOLDER))
    assert "WindowGroupLimit" in plan(tr.top_tags_by_period(series, 3))
    assert "TakeOrderedAndProject" in plan(agg.top(agg.tag_counts(posts(spark, FOLDER)), "Count", "Tag", 5))
    # Lag and total share one partitioning: one shuffle by tag after the aggregate's own.
    trending = plan(tr.trending_tags(series, latest=F.lit(0).cast("timestamp")))
    assert trending.count("Exchange hashpartitioning(Tag") == 2 and "SortMergeJoin" not in trending
    dated = clean.in_date_range(table(spark, FOLDER, "orders"), "1996-01-01", "1996-12-31", "o_orderdate")
    assert "GreaterThanOrEqual(o_orderdate" in plan(dated.select("o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan(dated.select("o_orderkey"))


@needs_data
def test_tokens_are_made_once(spark):
    tokens = text.preprocess(table(spark, FOLDER, "documents"), "text").select("doc_id", "ProcessedText")
    for df in (features.token_counts(tokens, key="doc_id"), agg.word_frequency(tokens)):
        assert plan(df).count("split(") == 1


@needs_data
def test_no_query_uses_a_product_of_tables(spark):
    for name in ("q01_above_average_by_month", "q06_posts_with_tag_names", "a43_duplicate_pairs", "a51_coherence"):
        shape = plan(bindings.QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in shape and "BroadcastNestedLoopJoin" not in shape, name


@needs_data
@pytest.mark.parametrize("name", sorted(bindings.ORACLES))
def test_query_equals_its_sql(spark, name):
    report = check.compare(spark, name, FOLDER)
    assert report.startswith("OK"), report


@needs_data
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
