"""Prefixes: a term is looked up for the lengths that its first characters may have, and finds all its prefixes."""

from lexiq.operators import search as S

PREFIXES = [("f", "t"), ("f", "thx"), ("f", "thxyz"), ("f", "thxyzab"), ("f", "thxyzabcdefgh"), ("f", "thxyzabcdefgx"), ("f", "éà"),
            ("f", "éàüöñç"), ("g", ""), ("g", "th")]


def generated(plan) -> int:
    """Rows that the explodes of an executed plan gave."""
    n = plan.metrics().apply("numOutputRows").value() if plan.nodeName() == "Generate" else 0
    children = plan.children()
    return n + sum(generated(children.apply(i)) for i in range(children.size()))


def joined(spark, terms, prefixes):
    postings = spark.createDataFrame([(f, t, i) for i, (f, t) in enumerate(terms)], "field string, term string, doc_id long")
    return S.prefix_postings(postings, S.stored(spark.createDataFrame(
        [(q, f, p) for q, (f, p) in enumerate(prefixes)], "qid long, field string, term string"), "prefixes"))


def test_terms_find_all_their_prefixes(spark):
    words = ["", "t", "th", "thx", "thxy", "thxyz", "thxyzabc", "thxyzabcdefghij", "thxyzabcdefgx", "xth", "é", "éà", "éàüöñçe", "éàü"]
    terms = [(f, w) for f in ("f", "g", "h") for w in words + ["thxyz"]]
    for prefixes in (PREFIXES, PREFIXES + PREFIXES[:3], PREFIXES[1:2], PREFIXES[8:9], [("h", "zz")]):
        want = sorted((q, p, t, i) for i, (f, t) in enumerate(terms) for q, (g, p) in enumerate(prefixes) if f == g and t.startswith(p))
        got = joined(spark, terms, prefixes).select("qid", "start", "term", "doc_id").collect()
        assert sorted(tuple(r) for r in got) == want


def test_a_short_prefix_costs_no_lookups_of_long_ones(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan as it ran
    try:
        df = joined(spark, [("f", f"ta{i}") for i in range(100)], [("f", "t")] + [("f", "thxyzabcdefg"[:n]) for n in range(3, 13)])
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(rows) == 100 and {r["start"] for r in rows} == {"t"}
    assert 100 <= generated(plan) <= 200  # a lookup for each of the 11 lengths would be 1,100
