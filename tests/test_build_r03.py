"""The postings of a build: words analyzed once per batch, files in the order of their terms."""

import sys

from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.functions.folding import fold_map
from lexiq.operators import index as I
from lexiq.plans.schema import Schema


def schema(fold: bool, limit: int = 40, lower: bool = True) -> Schema:
    return Schema().register("a", A.Analyzer("simple", limit=limit, lower=lower, fold=fold)).add_text_field("body", analyzer="a")


def by_expression(docs, s):
    """Postings from the tokens of the analyzer's column expression, as queries are analyzed."""
    toks = I.field_tokens(docs, s, "body").select("doc_id", F.size("toks").alias("len"), F.inline("toks"))
    return sorted((r.doc_id, r.term, r.tf, r.len, tuple(r.positions)) for r in toks.groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.max("len").alias("len"), F.sort_array(F.collect_list("pos")).alias("positions")).collect())


def by_build(docs, s):
    return sorted((r.doc_id, r.term, r.tf, r.len, tuple(r.positions)) for r in I.field_postings(docs, s, "body").collect())


def test_a_build_analyzes_words_as_queries_do(spark):
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    folds = fold_map()
    every = [c for c in every if c < "\u3000" or c.lower() != c or c.upper() != c or ord(c) in folds]
    texts = [" ".join(w for c in every[i:i + 4096] for w in (c, f"A{c}b", f"ΑΣ{c}", f"{c}Σ", f"ß{c}"))
             for i in range(0, len(every), 4096)]
    texts += ["", None, "?!", "ΌΣΟΣ ΟΔΟΣ'Α İstanbul DŽ ǆ ŉ", "x" * 39 + " " + "x" * 40 + " " + "É" * 19 + " " + "É" * 20 + " x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, body string").repartition(4)
    for s in (schema(True), schema(False), schema(False, 6, False)):
        assert by_build(docs, s) == by_expression(docs, s)


def test_the_words_of_a_build_are_analyzed_in_batches(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, body string")
    plan = I.field_postings(docs, schema(True), "body")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "translate" not in plan and "lower(" not in plan


def test_files_of_a_build_are_in_the_order_of_terms(spark, tmp_path, monkeypatch):
    rows = [(None if i == 7 else i % 30, f"w{i % 11} common É{i} {'zz ' * (i % 4)}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, body string")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before, found = spark.conf.get(key), []
    for files in (I.OPEN_FILES, 2):  # as many as the buckets, and fewer
        monkeypatch.setattr(I, "OPEN_FILES", files)
        path = str(tmp_path / f"i{files}")
        index = I.build_index(spark, docs, schema(True), path=path, term_buckets=4, doc_shards=3)
        assert spark.conf.get(key) == before
        raw = spark.read.parquet(f"{path}/postings").select("field", "tb", "term", "doc_id", F.input_file_name().alias("file"),
                                                            F.monotonically_increasing_id().alias("n")).orderBy("n").collect()
        files_of = {}
        for r in raw:
            files_of.setdefault((r.file, r.field), []).append((r.term.encode(), -1 if r.doc_id is None else r.doc_id))
        assert len(files_of) > 8 and all(x == sorted(x) for x in files_of.values())
        found.append(sorted((r.field, r.tb, r.term, str(r.doc_id), r.tf, r.len, tuple(r.positions)) for r in index.postings().collect()))
    assert found[0] == found[1] and len(found[0]) > 100
