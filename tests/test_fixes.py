"""Cases that the registered queries' data does not reach."""

import json

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.functions.lexicon import segment
from lexiq.operators import evaluate as E
from lexiq.operators.boolean import query_rejects
from lexiq.operators.highlight import highlights
from lexiq.operators.index import build_index
from lexiq.operators.maintain import VersionedIndex, dense_ids
from lexiq.operators.rank import fast_field, fetch
from lexiq.operators.search import search
from lexiq.plans import clauses as C
from lexiq.plans.schema import RECORD_BASIC, Schema

PLAIN = A.simple(40, None)


@pytest.fixture(scope="module")
def hello(spark):
    s = Schema().register("plain", PLAIN).add_text_field("body", analyzer="plain")
    s.add_text_field("basic", analyzer="plain", record=RECORD_BASIC, stored=False)
    s.add_text_field("tag", analyzer="plain", stored=False, is_fast=True)
    rows = [(0, "hello world", "hello world", "t0"), (1, "hello there world", "x", "t1"), (2, "world hello", "x", None),
            (3, "", None, "t3")]
    return build_index(spark, spark.createDataFrame(rows, "doc_id long, body string, basic string, tag string"), s,
                       term_buckets=2)


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid long, text string")


def test_phrase_prefix_needs_its_prefix(spark, hello):
    q = queries(spark, "hello wor", "hello xyz", "hello tex", "hello there wo", "there hello wor", "world xyz")
    r = search(hello, C.single_clause(q, "phrase_prefix", "body"), 10).collect()
    assert sorted((x.qid, x.doc_id) for x in r) == [(0, 0), (3, 1)]


def test_explicit_and(spark, hello):
    r = search(hello, C.keyword_clauses(queries(spark, "hello AND there", "hello OR there"), {"body": 1.0}), 10).collect()
    assert sorted((x.qid, x.doc_id) for x in r) == [(0, 1), (1, 0), (1, 1), (1, 2)]


def leaf(kind, text=0, field=0, modifier=1):
    return {"query_type": kind, "query_modifier": modifier, "query": {"field_index": field, "text_index": text}}


def group(*subs, modifier=1, boost=1.0):
    return {"query_type": 0, "query_modifier": modifier, "query": {"subqueries": list(subs), "boost": boost}}


def specs(spark, *trees, fields=("body",), texts=("hello",)):
    rows = [(i, json.dumps({"texts": list(texts), "fields": list(fields), "query": {"boost": 1.0, "subqueries": t}}))
            for i, t in enumerate(trees)]
    return C.parse_specs(spark.createDataFrame(rows, "qid long, spec_json string"))


def test_many_children_and_deep_trees(spark, hello):
    deep = leaf(4)
    for _ in range(6):
        deep = group(deep, boost=2.0)
    wide = [group(leaf(4))] + [leaf(4, text=1) for _ in range(70)]
    flat = C.flatten_specs(specs(spark, wide, [deep], texts=("there", "nowhere")))
    assert flat.groupBy("qid", "clause_id").count().filter("count > 1").count() == 0
    r = {x.qid: x for x in search(hello, flat, 10).collect()}
    assert r[0].doc_id == r[1].doc_id == 1 and r[1].score == pytest.approx(64 * r[0].score)


def test_rejects(spark, hello):
    trees = [[leaf(9)], [leaf(4, modifier=7)], [{"query_modifier": 1, "query": {}}], [{"query_type": 4, "query": {}}],
             [{"query_type": 0, "query_modifier": 1, "query": {"subqueries": []}}],
             [{"query_type": 0, "query_modifier": 1, "query": {"boost": 1.0}}], [leaf(4, field=5)], [leaf(4, text=5)],
             [leaf(1, field=1, text=1)], [leaf(1, field=1)], [leaf(4)], [leaf(4, field=2)], []]
    parsed = specs(spark, *trees, fields=("body", "basic", "nosuch"), texts=("hello", "hello world"))
    got = {r.qid: r.reason for r in query_rejects(hello, C.flatten_specs(parsed), parsed).collect()}
    assert got == {0: "Invalid query_type", 1: "Invalid query_modifier", 2: "missing field `query_type`",
                   3: "missing field `query_modifier`", 4: "missing field `boost`", 5: "missing field `subqueries`",
                   6: "Invalid field index", 7: "Invalid text index", 8: "Field does not have positions indexed",
                   11: "Invalid field name", 12: "No usable clauses in query"}


def nested(n):
    tree = leaf(4)
    for _ in range(n):
        tree = group(tree)
    return json.dumps({"texts": ["hello [[["], "fields": ["body"], "query": {"boost": 1.0, "subqueries": [tree]}})


def test_too_deep_is_rejected_not_cut(spark, hello):
    df = spark.createDataFrame([(1, nested(41)), (2, nested(40)), (3, "{no json")], "qid long, spec_json string")
    assert [r[0] for r in df.filter("qid < 3").orderBy("qid").select(C.json_depth(F.col("spec_json"))).collect()] == [128, 125]
    parsed = C.parse_specs(df)
    flat = C.flatten_specs(parsed)
    rejects = query_rejects(hello, flat, parsed).collect()
    assert {r.qid: r.reason for r in rejects} == {1: "Query nested too deeply", 3: "No usable clauses in query"}
    assert flat.count() == 41 and flat.agg(F.max("depth")).first()[0] == 41


def test_deep_tree_is_searched(spark, hello):
    """Forty nested groups with a boost of 1 find what their leaf finds."""
    df = spark.createDataFrame([(2, nested(40))], "qid long, spec_json string")
    flat = C.flatten_specs(C.parse_specs(df)).drop("error", "path", "n_fields", "n_texts")
    got = search(hello, flat, 10).collect()
    want = search(hello, C.single_clause(queries(spark, "hello"), "term", "body"), 10).collect()
    assert [(r.doc_id, round(r.score, 6)) for r in got] == [(r.doc_id, round(r.score, 6)) for r in want] and got


def test_fast_field_that_is_not_stored(spark, hello):
    res = search(hello, C.single_clause(queries(spark, "hello"), "term", "body"), 10)
    assert {r.value for r in fast_field(hello, res, "tag").collect()} == {"t0", "t1", ""}
    with pytest.raises(ValueError, match="not stored"):
        fetch(hello, res, ["tag"])


def test_zero_rows(spark, hello):
    stats = {r.field: r for r in hello.stats().collect()}
    assert stats["body"].n_docs == 4 and set(stats) == {"body", "basic", "tag", "_all"}
    s = Schema().register("plain", PLAIN).add_text_field("body", analyzer="plain").add_text_field("none", analyzer="plain")
    idx = build_index(spark, spark.createDataFrame([(0, "x", None)], "doc_id long, body string, none string"), s, term_buckets=2)
    assert {r.field: r.total_tokens for r in idx.stats().collect()}["none"] == 0


def test_highlight_of_repeated_field(spark):
    s = Schema().register("plain", PLAIN).add_text_field("body", analyzer="plain")
    idx = build_index(spark, spark.createDataFrame([(0, ["nothing here", "a hello b"])], "doc_id long, body array<string>"),
                      s, term_buckets=2)
    cl = C.single_clause(queries(spark, "hello"), "term", "body")
    h = highlights(idx, search(idx, cl, 5), cl).first().highlights
    assert [(x.field_name, x.fragment.t, x.fragment.r) for x in h] == [("body", "a hello b", [[2, 7]])]


def test_posting_scan_is_pruned(spark, hello):
    plan = search(hello, C.single_clause(queries(spark, "there"), "term", "body"), 10)._jdf.queryExecution().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "postings" in line]
    assert scans and all("dynamicpruning" in line for line in scans)


def test_user_stems_on_both_sides(spark):
    stems = spark.createDataFrame([("de", t, "lauf") for t in ("laufen", "lauft", "lauf")], "lang string, term string, stem string")
    with pytest.raises(ValueError, match="no stemming rules"):
        Schema().register("st", A.simple(40, "de"))
    s = Schema().register("st", A.simple(40, "de"), stems=stems).add_text_field("body", analyzer="st")
    idx = build_index(spark, spark.createDataFrame([(0, "wir laufen"), (1, "er lauft"), (2, "sie steht")],
                                                   "doc_id long, body string"), s, term_buckets=2)
    r = search(idx, C.single_clause(queries(spark, "laufen", "lauft", "steht"), "term", "body"), 10).collect()
    assert sorted((x.qid, x.doc_id) for x in r) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2)]


def test_long_lexicon_words(spark):
    word = "一二三四五六七八九十"
    lex = spark.createDataFrame([(word,), ("一二",)], "word string")
    df = spark.createDataFrame([(1, f"{word}十 ok")], "id long, text string")
    assert [t.term for t in segment(df, "id", "text", lex).first().toks] == [word, "十", "ok"]


def test_means_divide_by_all_queries(spark):
    per = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 1.0), (2, None, 0.0, 0.0, 0.0)],
                                "qid long, precision double, recall double, dcg double, ndcg double")
    assert E.mean_metrics(per).first().mean_precision == 0.5


def test_dense_ids_of_an_aggregated_frame(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        df = spark.range(60_000).repartition("id").groupBy("id").agg(F.repeat(F.lit("x"), 60).alias("t"))
        out = dense_ids(df, 7)
        row = out.agg(F.count(F.lit(1)), F.countDistinct("doc_id"), F.min("doc_id"), F.max("doc_id")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert tuple(row) == (60_000, 60_000, 7, 60_006)


def raw_index(spark):
    s = Schema().register("raw", A.raw()).register("plain", PLAIN)
    return VersionedIndex.create(spark, s.add_text_field("id", analyzer="raw").add_text_field("body", analyzer="plain"),
                                 term_buckets=2)


def test_unknown_field_on_adds(spark):
    vi = raw_index(spark)
    with pytest.raises(ValueError, match="field not found in schema"):
        vi.commit(adds=spark.createDataFrame([("1", "x", "y")], "id string, body string, nosuch string"))
    assert vi.last_version() == 0


def test_failed_attempt_is_never_read(spark):
    vi = raw_index(spark)
    vi.commit(adds=spark.createDataFrame([("1", "x"), ("2", "y")], "id string, body string"))
    left = spark.createDataFrame([(0,)], "doc_id long")  # as an attempt that died before its commit row
    left.write.parquet(f"{vi.path}/tombstones/version=2/attempt=dead")
    vi.commit(adds=spark.createDataFrame([("3", "z")], "id string, body string"))
    assert sorted(r.id for r in vi.live_docs().collect()) == ["1", "2", "3"]


def test_two_streams_and_replayed_batches(spark, tmp_path):
    from lexiq.streaming.ingest import apply_batch, ingest_files
    vi = raw_index(spark)
    for name, ids in (("a", range(5)), ("b", range(5, 10))):
        spark.createDataFrame([(str(i), "t") for i in ids], "id string, body string").coalesce(1).write.parquet(str(tmp_path / name))
        ingest_files(spark, vi, str(tmp_path / name), "id string, body string")
    assert vi.live_docs().count() == 10
    again = apply_batch(vi, stream_id="s")
    for _ in range(2):
        again(spark.createDataFrame([("99", "t")], "id string, body string"), 0)
    assert vi.live_docs().count() == 11
