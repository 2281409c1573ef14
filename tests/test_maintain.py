"""Batch add / delete / replace and the version log (batch and version tests of the reference)."""

from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.operators.maintain import VersionedIndex
from lexiq.operators.search import search
from lexiq.plans import clauses as C
from lexiq.plans.schema import Schema


def vindex(spark):
    s = Schema().register("raw", A.raw()).register("simple", A.simple(40, None))
    s.add_text_field("id", analyzer="raw").add_text_field("body", analyzer="simple")
    return VersionedIndex.create(spark, s, term_buckets=2)


def adds(spark, rows):
    return spark.createDataFrame(rows, "id string, body string")


def dels(spark, rows):
    return spark.createDataFrame(rows, "field string, term string")


def test_add_delete_sequences(spark):
    vi = vindex(spark)
    v1 = vi.commit(adds=adds(spark, [("1", "first"), ("2", "second")]))
    assert v1 > 0 and vi.live_docs().count() == 2
    v2 = vi.commit(deletes=dels(spark, [("id", "1")]))
    assert v2 > v1 and vi.live_docs().count() == 1
    v3 = vi.commit(adds=adds(spark, [("3", "third"), ("4", "fourth")]), deletes=dels(spark, [("id", "2")]))
    assert v3 > v2 and vi.live_docs().count() == 2
    snap = vi.snapshot()
    q = spark.createDataFrame([(1, "third OR fourth")], "qid long, text string")
    assert search(snap, C.keyword_clauses(q, {"body": 1.0}), 10).count() == 2
    assert vi.commit() == 0  # empty batch: stamp 0, nothing written
    assert vi.last_version() == v3


def test_unknown_field(spark):
    vi = vindex(spark)
    try:
        vi.commit(deletes=dels(spark, [("nosuch", "x")]))
        raise AssertionError("expected an error")
    except ValueError as e:
        assert "field not found in schema" in str(e)


def test_same_batch_deletes_do_not_touch_adds(spark):
    vi = vindex(spark)
    rows = [(str(i), f"doc {i}") for i in range(100)]
    vi.commit(adds=adds(spark, rows), deletes=dels(spark, [("id", str(i)) for i in range(50)]))
    assert vi.live_docs().count() == 100


def test_replace_keeps_one_doc(spark):
    vi = vindex(spark)
    vi.commit(adds=adds(spark, [("doc1", "Initial content")]))
    for text in ("First update", "Second update", "Third update"):
        vi.replace(adds(spark, [("doc1", text)]), "id")
        assert vi.live_docs().count() == 1
    assert vi.live_docs().first().body == "Third update"


def test_versions_and_snapshots(spark):
    vi = vindex(spark)
    versions = [vi.commit(adds=adds(spark, [(f"doc_{i}", f"This is document number {i}")])) for i in range(5)]
    assert versions == sorted(versions) and len(set(versions)) == 5
    assert vi.last_version() == versions[-1]
    assert vi.live_docs(as_of=versions[2]).count() == 3
    copy = vi.snapshot(as_of=versions[-1])
    for i in range(5, 10):
        vi.commit(adds=adds(spark, [(f"doc_{i}", f"This is document number {i}")]))
    assert vi.live_docs().count() == 10
    q = spark.createDataFrame([(1, "document")], "qid long, text string")
    assert search(copy, C.keyword_clauses(q, {"body": 1.0}), 100).count() == 5


def test_stream_ingest_equals_batch(spark, tmp_path):
    from lexiq.streaming.ingest import ingest_files
    src = tmp_path / "changes"
    spark.createDataFrame([(str(i), f"streamed text {i}") for i in range(20)], "id string, body string") \
        .repartition(3).write.parquet(str(src))
    vi = vindex(spark)
    ingest_files(spark, vi, str(src), "id string, body string")
    assert vi.live_docs().count() == 20
    assert vi.last_version() >= 1


def test_attempts_that_look_like_numbers(spark, monkeypatch):
    """A commit's folder is named by its attempt: digits, exponents and leading zeros stay strings."""
    from lexiq.operators import maintain

    class Name:
        def __init__(self, hex_):
            self.hex = hex_

    vi = vindex(spark)
    steps = [("123456789012", "1"), ("12345e678901", "2"), ("000000000012", "3"), ("8adeb0accd5b", "4")]
    for i, (attempt, gone) in enumerate(steps):
        monkeypatch.setattr(maintain.uuid, "uuid4", lambda a=attempt: Name(a + "0" * 20))
        vi.commit(adds=adds(spark, [(str(j), f"text {j}") for j in (10 * i, 10 * i + 1)]), deletes=dels(spark, [("id", str(10 * i - 10))]))
    assert {r.id for r in vi.live_docs().collect()} == {"1", "11", "21", "30", "31"}
    assert {r.id for r in vi.live_docs(as_of=2).collect()} == {"1", "10", "11"}


def test_view_equals_a_rebuild(spark):
    """Searched as the commits left it: no posting is written, statistics and scores are those of a new index."""
    from lexiq.operators.index import build_index
    vi = vindex(spark)
    vi.commit(adds=adds(spark, [(str(i), f"common word{i % 3} text number{i}") for i in range(12)]))
    vi.commit(adds=adds(spark, [("3", "common replaced text"), ("20", "word1 alone")]), deletes=dels(spark, [("id", "3"), ("id", "5")]))
    vi.commit(deletes=dels(spark, [("body", "number7")]))
    view = vi.view()
    live = view.docs().select("doc_id", "id", "body")
    fresh = build_index(spark, live, vi.schema, term_buckets=2)
    assert sorted(view.stats().collect()) == sorted(fresh.stats().collect())
    assert sorted(map(str, view.vocab().select("field", "term", "df").collect())) == sorted(
        map(str, fresh.vocab().select("field", "term", "df").collect()))
    tree = [C.leaf(1, 1, "must", "all", None, None, 2.0), C.leaf(1, 2, "must_not", "term", "body", "word1"),
            C.leaf(2, 1, "should", "one_of", "body", "common word2 replaced"), C.leaf(3, 1, "should", "phrase", "body", "common word0")]
    cl = C.clause_rows(spark, tree)
    for index in (fresh, vi.snapshot()):
        assert [tuple(r) for r in search(view, cl, 5, 6).orderBy("qid", "rank").collect()] == [
            tuple(r) for r in search(index, cl, 5, 6).orderBy("qid", "rank").collect()]
    assert vi.view(as_of=1).num_docs().first()[0] == 12 and view.num_docs().first()[0] == 11


def test_latest_changes_read_only_touched_buckets(spark):
    vi = vindex(spark)
    change = lambda *rows: spark.createDataFrame(list(rows), "key string, ts long")
    one = lambda key: spark.createDataFrame([(key,)], "key string")
    vi.commit(adds=adds(spark, [("a", "x")]), changes=change(*[(f"k{i}", i) for i in range(40)]))
    vi.commit(adds=adds(spark, [("b", "x")]), changes=change(("k3", 99), ("k4", 1), ("new", None)))
    known = vi.last_changes(one("k3"))
    assert {r.key: r.ts for r in known.collect()}["k3"] == 99
    assert len(known.inputFiles()) == 1
    every = {r.key: r.ts for r in vi.last_changes().collect()}
    assert every == {f"k{i}": i for i in range(40)} | {"k3": 99, "new": None}


def test_changes_without_a_time_are_the_oldest(spark, tmp_path):
    from lexiq.streaming.ingest import ingest_files
    vi = vindex(spark)
    schema = "op string, ts long, id string, body string"
    batches = [[("add", None, "1", "first"), ("add", 5, "2", "timed"), ("add", None, "2", "untimed")],
               [("add", None, "1", "again"), ("add", None, "2", "late"), ("add", None, "3", "new")],
               [("add", 1, "1", "timed")]]
    for i, rows in enumerate(batches):
        path = str(tmp_path / f"b{i}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
        ingest_files(spark, vi, path, schema, key_field="id", time="ts")
    assert {r.id: r.body for r in vi.live_docs().collect()} == {"1": "timed", "2": "timed", "3": "new"}
