"""Postings of a stemmed field: the dictionary goes to the documents, in parts, and tokens move to no term."""

from collections import defaultdict

import pytest

from lexiq.functions import analyzers as A
from lexiq.operators import index as I
from lexiq.operators import search as S
from lexiq.plans import clauses as C
from lexiq.plans.schema import Schema

ROWS = [(1, "Häuser Haus haus häusern x"), (2, "xx läuft laufen"), (2, "laufen lauf xx"), (None, "Haus"), (None, "häuser lief"), (3, None), (4, "?"),
        (5, "laufen " * 5)]
STEMS = {"hauser": "haus", "hausern": "haus", "lauft": "lauf", "laufen": "lauf", "lief": None, "never": "nie"}


@pytest.fixture(scope="module")
def schema(spark):
    stems = spark.createDataFrame([("de", t, s) for t, s in STEMS.items()] + [("fr", "xx", "y")], "lang string, term string, stem string")
    return Schema().register("st", A.Analyzer("simple", limit=40, fold=True, lang="de"), stems=stems).add_text_field("body", analyzer="st")


def postings(df):
    return sorted((r.doc_id or 0, r.term, r.tf, tuple(r.positions)) for r in df.collect())


def test_rows_of_stems(spark, schema, monkeypatch):
    monkeypatch.setattr(I, "STEM_ROWS", 1)
    want = defaultdict(list)
    for i, t in ROWS:
        for pos, w in enumerate((t or "").replace("?", "").lower().replace("ä", "a").split()):
            want[i or 0, STEMS.get(w) or w].append(pos)
    want = sorted((i, t, len(p), tuple(sorted(p))) for (i, t), p in want.items())
    docs = spark.createDataFrame(ROWS, "doc_id long, body string").repartition(3)
    for shards in (None, 4):
        df = I.corpus_postings(docs, schema, include_all=False, shards=shards)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "hashpartitioning(term" not in plan
        assert postings(df) == want


def test_search_of_stems(spark, schema):
    idx = I.build_index(spark, spark.createDataFrame(ROWS[:3], "doc_id long, body string"), schema, doc_shards=2)
    q = spark.createDataFrame([(1, "häusern x"), (2, "laufen")], "qid long, text string")
    assert {(r.qid, r.doc_id) for r in S.search_hits(idx, C.single_clause(q, "every_term", "body")).collect()} == {(1, 1), (2, 2)}
