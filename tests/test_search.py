"""End-to-end goldens from the reference tests: scores, boolean rules, prefixes, highlights."""

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.operators.highlight import highlights
from lexiq.operators.index import build_index
from lexiq.operators.maintain import delete_by_term
from lexiq.operators.rank import fast_field
from lexiq.operators.search import search, search_hits, top_k
from lexiq.plans import clauses as C
from lexiq.plans.schema import Schema

DOCS = "doc_id long, title string, body string, id string"


def schema(title_analyzer):
    s = Schema().register("t", title_analyzer).register("simple_en", A.simple(40, "en")).register("raw", A.raw())
    s.add_text_field("title", analyzer="t").add_text_field("body", analyzer="simple_en")
    s.add_text_field("id", analyzer="raw", is_fast=True)
    return s


def index(spark, rows, title=A.ngram(1, 4)):
    return build_index(spark, spark.createDataFrame(rows, DOCS), schema(title), term_buckets=2)


def keyword(spark, text, weights):
    return C.keyword_clauses(spark.createDataFrame([(1, text)], "qid long, text string"), weights)


def ids(idx, res):
    return [r.value for r in fast_field(idx, res, "id").orderBy("rank").collect()] if res.count() else []


@pytest.fixture(scope="module")
def weights_idx(spark):
    return index(spark, [(0, "an apple", "", "id1"), (1, "", "an apple", "id2")])


def test_bm25_phrase_golden(spark, weights_idx):
    r = search(weights_idx, keyword(spark, "apple", {"title": 1.0, "body": 1.0}), 10).orderBy("rank").collect()
    assert r[0].doc_id == 0 and r[0].score == pytest.approx(6.886753559112549, abs=1e-5)


def test_bm25_term_golden(spark, weights_idx):
    r = search(weights_idx, keyword(spark, "apple", {"title": 1.0, "body": 100.0}), 10).orderBy("rank").collect()
    assert r[0].doc_id == 1 and r[0].score == pytest.approx(49.19108963012695, abs=1e-5)


def test_match_all_rules(spark):
    idx = index(spark, [(0, "", "fruit", "id1"), (1, "", "fruit", "id2"), (2, "", "vegetable", "id3")])
    r = search(idx, C.clause_rows(spark, [C.leaf(1, 1, "must", "all", None, None)]), 10)
    assert r.count() == 3
    r = search(idx, C.clause_rows(spark, [C.leaf(1, 1, "must", "all", None, None),
                                          C.leaf(1, 2, "must_not", "term", "body", "fruit")]), 10)
    assert ids(idx, r) == ["id3"]
    r = search(idx, C.clause_rows(spark, [C.leaf(1, 1, "must", "all", None, None, boost=2.5)]), 10).collect()
    assert {x.score for x in r} == {2.5}


def test_ngram_phrase_and_structured(spark):
    idx = index(spark, [(0, "Douglas DC-9", "", "1"), (1, "Werfer", "", "2")])
    assert ids(idx, search(idx, keyword(spark, "dc-9", {"title": 1.0}), 10)) == ["1"]
    cl = C.clause_rows(spark, [C.leaf(1, 1, "must", "term", "id", "1"), C.leaf(1, 2, "must", "phrase", "title", "dc-9")])
    assert search(idx, cl, 10).count() == 1


def test_folding(spark):
    idx = index(spark, [(0, "Idées fête", "mères straße", "1")])
    assert search(idx, keyword(spark, "idees fete", {"title": 1.0}), 10).count() == 1
    assert search(idx, keyword(spark, "strasse", {"body": 1.0}), 10).count() == 1


def test_prefix_after_analysis(spark):
    idx = index(spark, [(0, "", "gaszählerstand", "id1")])
    cl = C.clause_rows(spark, [C.leaf(1, 1, "should", "term_prefix", "body", "gaszä")])
    assert search(idx, cl, 10).count() == 1
    assert search(idx, keyword(spark, "gaszä", {"body": 1.0}), 10).count() == 0


def test_delete_by_exact_token(spark):
    idx = index(spark, [(0, "", "Strange thing", "1"), (1, "", "Strange other", "2")])
    assert delete_by_term(idx, "body", "strang").count() == 0
    assert delete_by_term(idx, "body", "strange").count() == 2


def test_thai_edge(spark):
    idx = index(spark, [(0, "ตัวอย่ง", "body", "1")], title=A.edge_ngram(1, 4, 40))
    assert search(idx, keyword(spark, "ย", {"title": 1.0}), 10).count() == 0
    assert search(idx, keyword(spark, "ย่", {"title": 1.0}), 10).count() == 1
    assert delete_by_term(idx, "title", "ต").count() == 1
    assert delete_by_term(idx, "title", "ตั").count() == 0


def _hl(spark, idx, text, field):
    cl = keyword(spark, text, {field: 1.0})
    res = search(idx, cl, 10)
    h = highlights(idx, res, cl).collect()
    assert len(h) == 1
    return [(x.field_name, x.fragment.t, [list(r) for r in x.fragment.r]) for x in h[0].highlights]


def test_highlight_body_word(spark):
    idx = index(spark, [(0, "Example Title", "Example body doing.", "1")])
    assert _hl(spark, idx, "body", "body") == [("body", "Example body doing", [[8, 12]])]


def test_highlight_edge(spark):
    idx = index(spark, [(0, "Create Body", "Example title content.", "1")], title=A.edge_ngram(2, 4, 40))
    assert _hl(spark, idx, "create", "title") == [("title", "Crea", [[0, 2], [0, 3], [0, 4]])]


def test_highlight_ngram(spark):
    idx = index(spark, [(0, "Create Body", "Example title content.", "1")], title=A.ngram(2, 4))
    (name, frag, ranges), = _hl(spark, idx, "create", "title")
    assert name == "title" and frag == "Create Body"
    assert ranges == [[0, 2], [0, 3], [0, 4], [1, 3], [1, 4], [1, 5], [2, 4], [2, 5], [2, 6], [3, 5], [3, 6], [4, 6]]


def test_empty_clause_rules(spark):
    idx = index(spark, [(0, "", "hello world", "1")])
    # Must with empty text matches nothing; Should / MustNot with empty text are dropped
    cl = C.clause_rows(spark, [C.leaf(1, 1, "must", "phrase", "body", ""), C.leaf(1, 2, "must", "phrase", "body", "hello")])
    assert search(idx, cl, 10).count() == 0
    cl = C.clause_rows(spark, [C.leaf(1, 1, "should", "phrase", "body", ""), C.leaf(1, 2, "must_not", "phrase", "body", ""),
                               C.leaf(1, 3, "must", "phrase", "body", "hello")])
    assert search(idx, cl, 10).count() == 1


def test_limit_and_fast_field_errors(spark, weights_idx):
    res = search(weights_idx, keyword(spark, "apple", {"title": 1.0}), 10)
    with pytest.raises(ValueError, match="docsLimit must be greater than 0"):
        top_k(res, 0)
    with pytest.raises(ValueError, match="fast field not found in schema"):
        fast_field(weights_idx, res, "title")
    none = search(weights_idx, keyword(spark, "nonexistent", {"title": 1.0}), 10)
    assert fast_field(weights_idx, none, "id").count() == 0


def test_one_of_weights(spark):
    idx = index(spark, [(0, "", "a b c", "1")])
    cl = C.clause_rows(spark, [C.leaf(1, 1, "should", "one_of", "body", "a b c")])
    one = search_hits(idx, cl).first().score
    per = [search_hits(idx, C.clause_rows(spark, [C.leaf(1, 1, "should", "term", "body", t)])).first().score
           for t in ("a", "b", "c")]
    assert one == pytest.approx(per[0] * (1 - 0.5 / 3) + per[1] * (1 - 1.0 / 3) + per[2] * 0.5)


def test_boolean_matches_set_operations(spark):
    """Metamorphic check: the fold equals intersect / union / except of single-leaf results."""
    from lexiq.plans.catalog import docs_index
    idx = docs_index(spark, "/root/testdata/sf0.001")
    def docs(rows):
        return {r.doc_id for r in search_hits(idx, C.clause_rows(spark, rows)).collect()}
    a = docs([C.leaf(1, 1, "should", "term", "body", "the")])
    b = docs([C.leaf(1, 1, "should", "term", "body", "of")])
    c = docs([C.leaf(1, 1, "should", "term", "body", "and")])
    both = docs([C.leaf(1, 1, "must", "term", "body", "the"), C.leaf(1, 2, "should", "term", "body", "of"),
                 C.leaf(1, 3, "must_not", "term", "body", "and")])
    assert both == (a - c)
    either = docs([C.leaf(1, 1, "should", "term", "body", "the"), C.leaf(1, 2, "should", "term", "body", "of"),
                   C.leaf(1, 3, "must_not", "term", "body", "and")])
    assert either == ((a | b) - c)


def test_query_rejects_from_json_specs(spark):
    import json
    from lexiq.operators.boolean import query_rejects
    idx = index(spark, [(0, "", "hello world", "1")])
    def spec(texts, fields, subs):
        return json.dumps({"texts": texts, "fields": fields, "query": {"subqueries": subs, "boost": 1.0}})
    term = lambda fi, ti, mod=0: {"query": {"field_index": fi, "text_index": ti, "boost": 1.0},
                                  "query_modifier": mod, "query_type": 4}
    rows = [(1, spec(["hello"], ["body"], [term(0, 5)])),
            (2, spec(["hello"], ["nosuch"], [term(0, 0)])),
            (3, spec([], [], [term(0, 0)])),
            (4, spec([""], ["body"], [term(0, 0, 1)])),
            (5, spec(["hello"], ["body"], [term(0, 0)]))]
    js = spark.createDataFrame(rows, "qid long, spec_json string")
    parsed = C.parse_specs(js)
    got = {r.qid: r.reason for r in query_rejects(idx, C.flatten_specs(parsed), parsed).collect()}
    assert got == {1: "Invalid text index", 2: "Invalid field name", 3: "Fields or texts cannot be empty",
                   4: "No usable clauses in query"}


def test_lexicon_segmentation(spark):
    """A lexicon word is found inside a sentence written without spaces (bodyZh / titleZh)."""
    lex = spark.createDataFrame([("我们",), ("的",), ("售货员",), ("很",), ("热情",)], "word string")
    s = Schema().register("zh", A.lexicon(), lex).register("raw", A.raw())
    s.add_text_field("bodyZh", analyzer="zh").add_text_field("titleZh", analyzer="zh").add_text_field("id", analyzer="raw")
    sentence = "我们的售货员很热情"
    docs = spark.createDataFrame([(0, sentence, "", "1"), (1, "", sentence, "2")],
                                 "doc_id long, bodyZh string, titleZh string, id string")
    idx = build_index(spark, docs, s, term_buckets=2)
    from lexiq.operators.index import field_tokens
    toks = field_tokens(docs, s, "bodyZh").filter("doc_id = 0").first().toks
    assert [t.term for t in toks] == ["我们", "的", "售货员", "很", "热情"]
    q = spark.createDataFrame([(1, "售货员")], "qid long, text string")
    assert search(idx, C.keyword_clauses(q, {"bodyZh": 1.0, "titleZh": 1.0}), 10).count() == 2
