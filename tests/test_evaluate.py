"""Retrieval metrics against hand-computed values."""

import math

import pytest

from lexiq.operators import evaluate as E


def test_metrics(spark):
    results = spark.createDataFrame([(1, 1, "a"), (1, 2, "x"), (1, 3, "b"), (2, 1, "y")], "qid long, rank long, doc_id string")
    qrels = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "z")], "qid long, doc_id string")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "qid long")
    m = {r.qid: r for r in E.per_query_metrics(queries, results, qrels, 10).collect()}
    assert m[1].precision == pytest.approx(2 / 3)
    assert m[1].recall == pytest.approx(2 / 3)          # duplicates count in the denominator
    dcg = 1 + 1 / math.log2(4)
    assert m[1].dcg == pytest.approx(dcg)
    idcg = 1 + 1 / math.log2(3) + 1 / math.log2(4)     # ideal over 3 relevant entries
    assert m[1].ndcg == pytest.approx(dcg / idcg)
    assert m[2].precision == 0.0 and m[2].recall == 0.0 and m[2].ndcg == 0.0
    assert m[3].precision is None and m[3].recall == 0.0  # nothing retrieved


def test_judged_set_drops_unjudged(spark):
    topics = spark.createDataFrame([(1, "q one"), (2, "q two")], "qid long, text string")
    judg = spark.createDataFrame([(1, "d1", "1"), (1, "d2", "0")], "qid long, doc_id string, grade string")
    j = E.judged_set(topics, judg).collect()
    assert len(j) == 1 and sorted(j[0].relevant_docs) == ["d1", "d2"]
    assert E.judged_set(topics, judg, min_grade=1).first().relevant_docs == ["d1"]
