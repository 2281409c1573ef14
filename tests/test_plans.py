"""What moves and what is joined how, on small tables of their own."""

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.operators.index import build_index, layout_for
from lexiq.operators.maintain import VersionedIndex
from lexiq.operators.search import search, without_lone_groups
from lexiq.plans import catalog
from lexiq.plans import clauses as C
from lexiq.plans.oracle import ORACLE_SQL
from lexiq.plans.schema import Schema


def plain_schema():
    return Schema().register("plain", A.simple(40, None)).add_text_field("title", analyzer="plain").add_text_field("body", analyzer="plain")


@pytest.fixture(scope="module")
def index(spark):
    rows = [(i, f"t{i % 3}", f"alpha beta w{i} gamma delta") for i in range(40)]
    return build_index(spark, spark.createDataFrame(rows, "doc_id long, title string, body string"), plain_schema(), term_buckets=2,
                       doc_shards=4)


def test_phrases_and_terms_are_united_in_their_shards(spark, index):
    q = spark.createDataFrame([(1, "beta w7 gamma"), (2, "alpha beta w9")], "qid long, text string")
    found = search(index, C.recipe_clauses(q, "title", "body"), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and not [x for x in plan.split("\n") if "Exchange hashpartitioning(qid" in x and "doc" in x]
    assert "SortMergeJoin" not in plan  # the phrases' few candidates are broadcast
    assert {r.qid: r.doc_id for r in found.filter("rank = 1").collect()} == {1: 7, 2: 9}


def test_lone_groups_vanish(spark):
    rows = [C.group(1, 1, "must", 2.0), C.group(1, 2, "should", 3.0, 1, 2), C.leaf(1, 3, "must", "term", "body", "x", 0.5, 2, 3),
            C.group(2, 1, "must", 2.0), C.leaf(2, 2, "must_not", "term", "body", "x", 1.0, 1, 2),
            C.group(3, 1, "must_not", 5.0), C.group(3, 2, "must", 2.0, 1, 2), C.leaf(3, 3, "should", "term", "body", "x", 1.0, 2, 3),
            C.leaf(3, 4, "should", "term", "body", "y", 1.0, 2, 3), C.leaf(3, 5, "should", "all", None, None)]
    got = sorted(tuple(r)[:5] + (r.boost,) for r in without_lone_groups(C.clause_rows(spark, rows)).collect())
    assert got == [(1, 3, 0, 1, "must", 3.0), (2, 1, 0, 1, "must", 2.0), (2, 2, 1, 2, "must_not", 1.0), (3, 2, 0, 1, "must_not", 10.0),
                   (3, 3, 2, 3, "should", 1.0), (3, 4, 2, 3, "should", 1.0), (3, 5, 0, 1, "should", 1.0)]


def test_shards_of_a_large_corpus_are_small(spark):
    docs = spark.range(1 << 30).selectExpr("id AS doc_id")  # 8 GB
    assert layout_for(docs)[1] >= 512


def test_deleted_ids_are_broadcast(spark):
    vi = VersionedIndex.create(spark, plain_schema(), term_buckets=2)
    vi.commit(adds=spark.createDataFrame([("a", "x y"), ("b", "y z")], "title string, body string"))
    vi.commit(deletes=spark.createDataFrame([("title", "a")], "field string, term string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        live = vi.live_docs()
        assert "SortMergeJoin" not in live._jdf.queryExecution().executedPlan().toString()
        assert [r.title for r in live.collect()] == ["b"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_table_of_part_files_is_ingested(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i}", "en" if i % 2 else "fr", "s", 6) for i in range(6)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.lang: r.n for r in catalog.q_stream_ingest(spark, str(tmp_path)).collect()} == {"en": 3, "fr": 3}


def test_conversations_queries(spark, tmp_path):
    rows = spark.createDataFrame([(c, t, "user", f"q {c}") for c in (0, 1, 99, 100, 200, 250) for t in (0, 1)],
                                 "conv_id long, turn int, role string, text string")
    rows.write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted(r.qid for r in catalog.conv_queries(spark, str(tmp_path)).collect())
    assert got == [c * catalog.TURNS + t for c in (0, 1, 99, 100, 200, 250) for t in (0, 1)]


def test_all_turns_are_queries():
    sql = ORACLE_SQL["topk_per_query"]
    assert "FROM conversations)" in sql and "conv_id %" not in sql
