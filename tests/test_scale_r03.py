"""Plans and rows of prefixes, phrases and postings beyond the bounds of a broadcast."""

import re
from collections import defaultdict

import pytest

from lexiq.functions import analyzers as A
from lexiq.operators import search as S
from lexiq.operators.index import build_index, field_postings
from lexiq.plans import clauses as C
from lexiq.plans.schema import Schema


def body_schema() -> Schema:
    return Schema().register("body", A.simple(40, None, fold=True)).add_text_field("body", analyzer="body")


def moves_postings(df) -> bool:
    """Whether a plan sorts for a join, or exchanges rows by document or term."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" in plan or bool(re.search(r"Exchange hashpartitioning\([^)]*(doc_id|hit|term)", plan))


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture()
def index(spark):
    rows = [(i, f"common pair a{chr(97 + i)} ab{chr(97 + i)}x zz{i}") for i in range(12)]
    return build_index(spark, spark.createDataFrame(rows, "doc_id long, body string"), body_schema(), doc_shards=4)


def test_a_prefix_of_many_terms_moves_no_posting(spark, index, no_auto_broadcast, monkeypatch):
    monkeypatch.setattr(S, "SMALL_TABLE_ROWS", 5)  # fewer than the 24 terms that start with "a"
    q = spark.createDataFrame([(1, "a"), (2, "abc"), (3, "zzz")], "qid long, text string")
    hits = S.search_hits(index, C.single_clause(q, "term_prefix", "body"))
    assert not moves_postings(hits)
    got = defaultdict(set)
    for r in hits.collect():
        assert r["score"] == 1.0
        got[r["qid"]].add(r["doc_id"])
    assert got == {1: set(range(12)), 2: {2}}


def test_phrases_of_many_candidates_move_no_posting(spark, index, no_auto_broadcast, monkeypatch):
    q = spark.createDataFrame([(1, "common pair"), (2, "pair common")], "qid long, text string")
    few = {(r["qid"], r["doc_id"]): round(r["score"], 6) for r in S.search_hits(index, C.single_clause(q, "phrase", "body")).collect()}
    monkeypatch.setattr(S, "SMALL_TABLE_ROWS", 7)  # fewer than the 24 candidates, a shard holds 6 on average
    hits = S.search_hits(index, C.single_clause(q, "phrase", "body"))
    assert not moves_postings(hits)
    many = {(r["qid"], r["doc_id"]): round(r["score"], 6) for r in hits.collect()}
    assert many == few and set(many) == {(1, i) for i in range(12)}


def test_postings_of_batches(spark):
    rows = [(1, "b a b ñandú"), (1, "a a"), (None, "Straße x"), (3, None), (4, "?!"), (5, "Œuvre " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, body string").coalesce(1)
    got = sorted(((r["doc_id"] or 0, r["term"], r["tf"], r["len"], tuple(r["positions"]))
                  for r in field_postings(docs, body_schema(), "body").collect()))
    assert got == sorted([
        (1, "b", 2, 4, (0, 2)), (1, "a", 1, 4, (1,)), (1, "nandu", 1, 4, (3,)), (1, "a", 2, 2, (0, 1)),
        (0, "strasse", 1, 2, (0,)), (0, "x", 1, 2, (1,)), (5, "oeuvre", 3, 3, (0, 1, 2))])
