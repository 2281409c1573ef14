"""Sources and sinks: JSON results by parsed keys, UTF-8 repair, TSV topics and judgements."""

import json

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.operators.index import build_index
from lexiq.operators.rank import to_json_documents
from lexiq.operators.search import search
from lexiq.plans import clauses as C
from lexiq.plans.schema import Schema
from lexiq.sources.corpus import read_judgements, read_topics, repair_utf8


def test_results_json_keys(spark):
    s = Schema().register("raw", A.raw())
    s.add_text_field("body").add_text_field("tags", analyzer="raw", stored=True)
    docs = spark.createDataFrame([(0, "apple pie", ["a", "b"]), (1, "pear", ["c"])],
                                 "doc_id long, body string, tags array<string>")
    idx = build_index(spark, docs, s, term_buckets=2)
    q = spark.createDataFrame([(1, "apple")], "qid long, text string")
    res = search(idx, C.single_clause(q, "one_of", "body"), 10)
    (row,) = to_json_documents(idx, res, ["tags"]).collect()
    doc = json.loads(row.json)
    assert set(doc) == {"score", "highlights", "tags"}
    assert doc["tags"] == "b"          # the last value of a repeated field wins
    assert doc["score"] > 0 and doc["highlights"] == []
    with pytest.raises(ValueError):
        to_json_documents(idx, res, [])


def test_utf8_repair(spark):
    df = spark.createDataFrame([(1, bytearray(b"hello\xff"))], "id int, b binary")
    assert repair_utf8(df, "b", "t").first().t == "hello�"
    with pytest.raises(Exception):
        repair_utf8(df, "b", "t", strict=True).collect()


def test_topics_and_judgements(spark, tmp_path):
    (tmp_path / "topics.tsv").write_text("q1\twhat is spark\nq2\tbm25 scoring\n")
    (tmp_path / "qrels.tsv").write_text("q1\tQ0\td1\t1\nq1\tQ0\td2\t0\n")
    t = read_topics(spark, str(tmp_path / "topics.tsv"))
    j = read_judgements(spark, str(tmp_path / "qrels.tsv"))
    assert {r.qid: r.text for r in t.collect()} == {"q1": "what is spark", "q2": "bm25 scoring"}
    assert sorted((r.qid, r.doc_id, r.grade) for r in j.collect()) == [("q1", "d1", "1"), ("q1", "d2", "0")]


def test_typed_results_with_a_callback(spark):
    """The callback sees the parsed documents batch by batch and makes rows of its own type."""
    from pyspark.sql import types as T

    from lexiq.operators.rank import typed_results
    rows = spark.createDataFrame([(1, 1, '{"score":2.5,"title":"a"}'), (1, 2, '{"score":1.0}'), (2, 1, "{}")],
                                 "qid long, rank long, json string")
    schema = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("title", T.StringType())])

    def model(batches):
        for b in batches:
            yield b.assign(label=b["title"].fillna("none") + ":" + b["score"].fillna(0).astype(str))[["qid", "rank", "label"]]

    got = typed_results(rows, schema, model, "qid long, rank long, label string").orderBy("qid", "rank").collect()
    assert [tuple(r) for r in got] == [(1, 1, "a:2.5"), (1, 2, "none:1.0"), (2, 1, "none:0.0")]


def test_quoted_tsv_in_many_tasks_equals_the_whole_file_reader(spark, tmp_path):
    """Records with tabs, quotes and line ends in their fields, read in splits of some bytes."""
    import random

    from lexiq.sources import corpus
    rng = random.Random(3)
    pieces = ["word", 'a "quoted" one', "two\nlines", "tab\there", 'ends with "', '"', "", "ünï", "x" * 50, "a\n\n\nb", 'mid"dle', "1\r\n2"]
    rows = [(str(i), rng.choice(pieces) + rng.choice(pieces), " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))) for i in range(120)]
    path = str(tmp_path / "docs.tsv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("docid\ttitle\ttext\n")
        for row in rows:
            f.write("\t".join('"' + v.replace('"', '""') + '"' if set(v) & set('"\t\n\r') or not v else v for v in row) + "\n")
        f.write('last\tno"quote\tin "the" middle\n')
    whole = (spark.read.schema(corpus.CORPUS_TSV_SCHEMA).option("sep", "\t").option("header", True).option("multiLine", True)
             .option("quote", '"').option("escape", '"').csv(path))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("97", "1000", before):
            spark.conf.set(key, size)
            got = corpus.read_corpus_tsv(spark, path)
            tidy = lambda rs: sorted((r.docid, (r.title or "").replace("\r\n", "\n"), (r.text or "").replace("\r\n", "\n")) for r in rs)
            assert tidy(got.collect()) == tidy(whole.collect())
            assert len(got.collect()) == 121
    finally:
        spark.conf.set(key, before)
