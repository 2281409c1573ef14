"""Analyzer goldens (edge n-gram table, n-gram counts, folding, splitting)."""

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A


def toks(spark, analyzer, text):
    row = spark.createDataFrame([(text,)], "t string").select(analyzer.expr(F.col("t")).alias("x")).first()
    return [(t.pos, t.term) for t in row.x]


@pytest.mark.parametrize("mn,mx,limit,text,expected", [
    (1, 4, 20, "ตัวอย่ง", [(0, "ตั"), (1, "ว"), (2, "อ"), (3, "ย่"), (4, "ง")]),
    (2, 5, 20, "hello my friend", [(0, "he"), (0, "hel"), (0, "hell"), (0, "hello"), (1, "my"),
                                   (2, "fr"), (2, "fri"), (2, "frie"), (2, "frien")]),
    (2, 5, 10, "hello my friend", [(0, "he"), (0, "hel"), (0, "hell"), (0, "hello"), (1, "my")]),
    (2, 3, 10, "hi my", [(0, "hi"), (1, "my")]),
    (1, 3, 10, "", []),
    (6, 10, 10, "hello", []),
])
def test_edge_ngram_table(spark, mn, mx, limit, text, expected):
    assert toks(spark, A.edge_ngram(mn, mx, limit), text) == expected


def test_edge_ngram_thai_byte_ends(spark):
    from lexiq.operators.highlight import _tokens_with_offsets
    df = spark.createDataFrame([(1, "ตัวอย่ง")], "k int, t string")
    rows = _tokens_with_offsets(df, A.edge_ngram(1, 4, 20), "t").orderBy("pos").collect()
    assert [r.end for r in rows] == [6, 3, 3, 6, 3]


def test_ngram_counts_force_golden_score(spark):
    assert len(toks(spark, A.ngram(1, 4), "an apple")) == 26
    assert len(toks(spark, A.ngram(1, 4), "apple")) == 14
    assert all(p == 0 for p, _ in toks(spark, A.ngram(1, 4), "an apple"))


def test_simple_split_and_fold(spark):
    assert [t for _, t in toks(spark, A.simple(), "Strange/text/body")] == ["strange", "text", "body"]
    assert [t for _, t in toks(spark, A.simple(), "Idées fête straße")] == ["idees", "fete", "strasse"]
    assert [t for _, t in toks(spark, A.default(), "Idées fête")] == ["idées", "fête"]


def test_drop_long_keeps_positions(spark):
    out = toks(spark, A.Analyzer("simple", limit=5), "tiny enormous ok")
    assert out == [(0, "tiny"), (2, "ok")]


def test_raw_is_one_unchanged_token(spark):
    assert toks(spark, A.raw(), "Hello World") == [(0, "Hello World")]


def test_unsupported_language():
    with pytest.raises(ValueError, match="xx is an unsupported language"):
        A.simple(40, "xx")


def test_duplicate_field():
    from lexiq.plans.schema import Schema
    s = Schema().add_text_field("title")
    with pytest.raises(ValueError, match="field already defined: title"):
        s.add_text_field("title")
