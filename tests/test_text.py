"""Folding, edge n-gram limits and lexicon fields, by literal expectations."""

import pytest
from pyspark.sql import functions as F

from lexiq.functions import analyzers as A
from lexiq.functions.folding import fold_col
from lexiq.operators.highlight import highlights
from lexiq.operators.index import build_index
from lexiq.operators.search import search, search_hits
from lexiq.plans import clauses as C
from lexiq.plans.schema import RECORD_FREQS, Schema

FOLDED = {
    "ǽ": "ae", "ǿ": "o", "ŋ": "n", "ǆ": "dz", "ƒ": "f", "ǥ": "g", "ŉ": "n", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d",
    "ø": "o", "ł": "l", "đ": "d", "ħ": "h", "ŧ": "t", "ı": "i", "ȷ": "j", "ĳ": "ij", "ŀ": "l", "ſ": "s", "ƀ": "b", "ɓ": "b",
    "ƈ": "c", "ɗ": "d", "ɛ": "e", "ɠ": "g", "ƙ": "k", "ɲ": "n", "ɔ": "o", "ƥ": "p", "ʠ": "q", "ʂ": "s", "ƭ": "t", "ʋ": "v", "ƴ": "y",
    "ʐ": "z", "ẫ": "a", "ḝ": "e", "ṩ": "s", "ẞ": "SS", "Ǽ": "AE", "Ŋ": "N", "Ǆ": "DZ", "ꜳ": "aa", "ꝏ": "oo", "ﬀ": "ff", "ﬃ": "ffi",
    "ﬆ": "st", "Ａ": "A", "ｚ": "z", "７": "7", "²": "2", "₃": "3", "①": "1", "⒈": "1.", "⒜": "(a)", "ⓩ": "z", "❿": "10", "ª": "a",
    "“": '"', "’": "'", "–": "-", "日": "日", "ж": "ж", "α": "α", "x": "x",
}


def test_folding_table(spark):
    df = spark.createDataFrame([(k, v, f"a{k}b{k}") for k, v in FOLDED.items()], "ch string, want string, twice string")
    rows = df.select("ch", "want", fold_col(F.col("ch")).alias("got"), fold_col(F.col("twice")).alias("twice")).collect()
    assert {r.ch: r.got for r in rows} == FOLDED
    assert all(r.twice == f"a{r.want}b{r.want}" for r in rows)


def edge(spark, text, *args, **kw):
    df = spark.createDataFrame([(text,)], "t string")
    return [(t["pos"], t["term"]) for t in df.select(A.edge_ngram(*args, **kw).expr(F.col("t")).alias("x")).first().x]


def test_edge_ngrams_of_a_grapheme_longer_than_the_limit(spark):
    long = "a" + "́" * 200  # one grapheme of 201 characters that starts before the limit
    assert spark.createDataFrame([(long + "bc",)], "t string").select(
        A.truncate_bytes(F.col("t"), 5, False).alias("x")).first().x == long
    many = "".join(c + "́" * 40 for c in "abcd")
    assert spark.createDataFrame([(many,)], "t string").select(
        A.truncate_bytes(F.col("t"), 100, False).alias("x")).first().x == many[:82]
    assert spark.createDataFrame([("abcdefgh" * 50,)], "t string").select(
        A.truncate_bytes(F.col("t"), 5, False).alias("x")).first().x == "abcde"


def test_exact_limit_stops_only_at_a_boundary(spark):
    """A grapheme that starts exactly at the limit is where the text is cut; one that jumps over it isn't."""
    cut = lambda t, n: spark.createDataFrame([(t,)], "t string").select(A.truncate_bytes(F.col("t"), n, True).alias("x")).first().x
    assert cut("abcdef", 3) == "abc"
    assert cut("éééé", 4) == "éé"
    assert cut("éééé", 3) == "éééé"  # offsets 0, 2, 4, 6: never 3
    assert cut("ab", 5) == "ab"


def test_exact_limit_counts_tokens_before_a_word(spark):
    """Before each word the walk stops only if the tokens so far equal the limit: it may overshoot."""
    assert edge(spark, "ab cd ef", 1, 2, 4, exact_limit=True) == [(0, "a"), (0, "ab"), (1, "c")]
    assert edge(spark, "a b c d", 1, 1, 3) == [(0, "a"), (1, "b")]
    eight = "ab cd"  # five bytes, four tokens: neither limit is met
    assert edge(spark, eight, 1, 2, 5, exact_limit=True) == [(0, "a"), (0, "ab"), (1, "c"), (1, "cd")]
    assert edge(spark, "aaaa bbbb", 1, 4, 9, exact_limit=True) == [(0, "a" * i) for i in range(1, 5)] + [(1, "b" * i) for i in range(1, 5)]


@pytest.fixture(scope="module")
def zh(spark):
    lex = spark.createDataFrame([("售货员",), ("商店",), ("中华人民共和国成立纪念",)], "word string")
    s = Schema().register("zh", A.lexicon(), lexicon=lex).add_text_field("bodyZh", analyzer="zh")
    rows = [(0, "他是 a售货员在商店。工作"), (1, "中华人民共和国成立纪念日 Running"), (2, "no han text here"), (3, None), (4, "售货")]
    return build_index(spark, spark.createDataFrame(rows, "doc_id long, bodyZh string"), s, term_buckets=2)


def found(spark, index, text, kind="term"):
    q = spark.createDataFrame([(1, text)], "qid long, text string")
    cl = C.single_clause(q, kind, "bodyZh")
    return cl, search(index, cl, 10)


def test_lexicon_words_of_any_length_through_a_schema(spark, zh):
    terms = {r.term for r in zh.vocab().filter("field = 'bodyZh'").collect()}
    assert {"售货员", "商店", "中华人民共和国成立纪念", "日", "售", "货", "run", "a"} <= terms and "员" not in terms
    assert [r.doc_id for r in found(spark, zh, "中华人民共和国成立纪念")[1].collect()] == [1]
    assert [r.doc_id for r in found(spark, zh, "售货员在商店", "phrase")[1].collect()] == [0]


def test_lexicon_fields_are_highlighted(spark, zh):
    cl, res = found(spark, zh, "售货员 商店", "one_of")
    h = highlights(zh, res, cl).filter("doc_id = 0").first().highlights[0]
    assert h.field_name == "bodyZh" and h.fragment.t == "他是 a售货员在商店。工作"
    raw = h.fragment.t.encode()
    assert [raw[a:b].decode() for a, b in h.fragment.r] == ["售货员", "商店"]


def test_phrase_on_a_field_without_positions_is_an_error(spark):
    s = Schema().register("plain", A.simple(40, None)).add_text_field("body", analyzer="plain", record=RECORD_FREQS)
    idx = build_index(spark, spark.createDataFrame([(0, "hello there world")], "doc_id long, body string"), s, term_buckets=2)
    q = spark.createDataFrame([(1, "hello"), (2, "hello there")], "qid long, text string")
    with pytest.raises(ValueError, match=r"Field does not have positions indexed: body \(query 2"):
        search(idx, C.single_clause(q, "phrase", "body"), 10)
    assert search_hits(idx, C.single_clause(q.filter("qid = 1"), "phrase", "body")).count() == 1
