"""Batches scored by products of matrices have the rows of the other plan, also with repeated and null keys."""

import random

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.operators import matrix as M
from lexiq.operators import search as S
from lexiq.operators.index import build_index
from lexiq.plans import clauses as C
from lexiq.plans.schema import Schema

WORDS = [f"w{i}" for i in range(30)]


def text(rng, n):
    return " ".join(rng.choices(WORDS, [1 / (i + 1) for i in range(30)], k=n))


@pytest.fixture(scope="module")
def index(spark):
    rng = random.Random(3)
    rows = [(i, f"t{i % 4}", text(rng, 5 + i % 40)) for i in range(150)]
    rows += rows[:4] + [(None, "t1", text(rng, 9)), (None, "t2", text(rng, 9)), (900, "t0", None), (901, None, "w0 w1")]
    rows += [(1000 + i, "t3", "w7 w8 w9 w1") for i in range(20)]  # equal scores: the first ids are the best
    s = Schema().register("raw", A.raw()).register("plain", A.simple(40, None))
    s.add_text_field("title", analyzer="raw").add_text_field("body", analyzer="plain")
    return build_index(spark, spark.createDataFrame(rows, "doc_id long, title string, body string"), s, term_buckets=2, doc_shards=4)


@pytest.fixture()
def queries(spark):
    rng = random.Random(4)
    rows = [(i, text(rng, 1 + i % 12)) for i in range(60)] + [(100, "w7 w8 w9"), (101, "none"), (102, ""), (103, None), (104, "t2"), (105, "w3 w3")]
    return spark.createDataFrame(rows, "qid long, text string")


def both(monkeypatch, index, clauses, k=4):
    found = []
    for least in (1 << 60, 0):
        monkeypatch.setattr(S, "MATRIX_POSTINGS", least)
        found.append(sorted((r.qid, r.rank, -1 if r.doc_id is None else r.doc_id, r.score) for r in S.search(index, clauses, k, 4).collect()))
    return found


@pytest.mark.parametrize("kind", ["one_of", "every_term", "phrase_prefix"])
def test_single_leaves(monkeypatch, index, queries, kind):
    old, new = both(monkeypatch, index, C.single_clause(queries, kind, "body"))
    assert new == old and new


def test_blocks_and_shards(monkeypatch, index, queries):
    monkeypatch.setattr(M, "BLOCK_ROWS", 50)
    monkeypatch.setattr(M, "BLOCKS_PER_SCAN", 2)
    monkeypatch.setattr(M, "CELLS", 300)
    monkeypatch.setattr(M, "DENSE", 0.1)
    old, new = both(monkeypatch, index, C.recipe_clauses(queries, "title", "body"))
    assert new == old and new


def test_groups_of_words(monkeypatch, index, queries):
    monkeypatch.setattr(S, "SCAN_TERMS", 3)  # all postings of the fields are read
    old, new = both(monkeypatch, index, C.keyword_clauses(queries, {"title": 10.0, "body": 1.0}))
    assert new == old and new


def test_repeated_and_null_queries(monkeypatch, spark, index, queries):
    again = queries.union(queries.filter("qid < 10")).union(queries.filter("qid < 5").select(F.lit(None).cast("long"), "text"))
    old, new = both(monkeypatch, index, C.single_clause(again, "every_term", "body").union(C.single_clause(again, "one_of", "body")))
    assert new == old and new


def test_other_trees_keep_their_plan(monkeypatch, spark, index):
    monkeypatch.setattr(S, "matrix_search", lambda *_: pytest.fail("no sum of leaves"))
    monkeypatch.setattr(S, "MATRIX_POSTINGS", 0)
    for rows in ([C.leaf(1, 1, "must", "term", "body", "w1"), C.leaf(1, 2, "should", "term", "body", "w2")],
                 [C.leaf(1, 1, "should", "term", "body", "w1"), C.leaf(1, 2, "must_not", "term", "body", "w2")],
                 [C.leaf(1, 1, "should", "term", "body", "w1"), C.leaf(1, 2, "should", "all", None, None)],
                 [C.leaf(1, 1, "should", "term", "body", "w1", -1.0)]):
        assert S.search(index, C.clause_rows(spark, rows), 3, 4).count()


def test_a_scan_hands_on_the_best_of_a_shard_only(monkeypatch, spark, index):
    """Before, every (query, document) that shared a word was a row of the plan."""
    given = []

    def counted(*args):
        for df in M.best_documents(*args):
            given.append(df.count())
            yield df

    monkeypatch.setattr(S, "best_documents", counted)
    monkeypatch.setattr(S, "MATRIX_POSTINGS", 0)
    q = spark.createDataFrame([(i, "w0 w1 w2 w3") for i in range(20)], "qid long, text string")
    assert S.search(index, C.single_clause(q, "one_of", "body"), 2, 4).count() == 40
    assert len(given) == 1 and given[0] <= 20 * 4 * 4  # at most some of equal scores more than 2 for each of 4 shards


def test_the_methods_that_are_compared_are_products(monkeypatch, index, queries):
    """Keyword and recipe batches, whose phrases and prefixes are few, make no row for each document that a word hits."""
    monkeypatch.setattr(S, "MATRIX_POSTINGS", 0)
    monkeypatch.setattr(S, "top_k", lambda hits, k, digits: hits)  # what comes before the last step
    for clauses in (C.keyword_clauses(queries, {"title": 10.0, "body": 1.0}, escape=True), C.recipe_clauses(queries, "title", "body")):
        found = S.search(index, clauses, 2, 4)
        every = S.search_hits(index, clauses)
        assert found.count() < every.count() / 2
