"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: tokens come from ``regexp_extract_all`` +
``unnest``, postings from GROUP BY, phrases from a self-join on positions, BM25 from the
textbook formula. Same rounding (4 places, before ranking) and tie-break (doc_id).
"""

from __future__ import annotations


# Plain letters of the tables' languages and their spelling, written down here on their own.
ACCENTED = "àáâãäåāçćčèéêëēìíîïīñńòóôõöøōùúûüūýÿšžžł"
PLAIN = "aaaaaaaccceeeeeiiiiinnooooooouuuuuyyszzl"


def fold_sql(expr: str) -> str:
    for letter, spelled in (("ß", "ss"), ("æ", "ae"), ("œ", "oe")):
        expr = f"replace({expr}, '{letter}', '{spelled}')"
    return f"translate({expr}, '{ACCENTED}', '{PLAIN}')"


WORD = r"[\p{L}\p{N}]+"
EDGE_WORD = r"[\p{L}\p{N}_\p{M}]+(?:[''’.:][\p{L}\p{N}_\p{M}]+)*"  # quote doubled for SQL
K = 10


def tok(src: str, id_expr: str, text_expr: str, limit: int = 40, lower: bool = True, fold: bool = True) -> str:
    """(id, pos, term) of the simple analyzer."""
    term = "w"
    if lower:
        term = f"lower({term})"
    if fold:
        term = f"CASE WHEN strlen(w) = length(w) THEN {term} ELSE {fold_sql(term)} END"
    return (f"SELECT id, pos, {term} AS term FROM ("
            f"SELECT id, unnest(ws) AS w, unnest(range(0, len(ws))) AS pos FROM ("
            f"SELECT {id_expr} AS id, regexp_extract_all(coalesce({text_expr}, ''), '{WORD}') AS ws FROM {src})"
            f") WHERE strlen(w) < {limit}")


def idx_ctes(src: str = "documents") -> str:
    """Body index of ``documents`` plus the raw-field statistics."""
    return f"""
bt AS ({tok(src, 'doc_id', 'text')}),
bp AS (SELECT term, id AS doc_id, count(*) AS tf, min(pos) AS first_pos FROM bt GROUP BY term, id),
bl AS (SELECT id AS doc_id, count(*) AS len FROM bt GROUP BY id),
bv AS (SELECT term, count(*) AS df FROM bp GROUP BY term),
st AS (SELECT (SELECT count(*) FROM documents) AS n,
              (SELECT count(*) FROM bt) * 1.0 / (SELECT count(*) FROM documents) AS avg_len),
sst AS (SELECT (SELECT count(*) FROM documents WHERE source IS NOT NULL) * 1.0 / (SELECT count(*) FROM documents) AS avg_len),
sv AS (SELECT source AS term, count(*) AS df FROM documents WHERE source IS NOT NULL GROUP BY source)"""


def idf(df: str) -> str:
    return f"ln(1 + (st.n - {df} + 0.5) / ({df} + 0.5))"


def tfn(tf: str, ln: str, avg: str = "st.avg_len") -> str:
    return f"(2.2 * {tf}) / ({tf} + 1.2 * (0.25 + 0.75 * {ln} / {avg}))"


def slots_cte(name: str, src: str, qid_expr: str, text_expr: str) -> str:
    return (f"{name} AS (SELECT id AS qid, pos AS off, term, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS slot, "
            f"count(*) OVER (PARTITION BY id) AS n FROM ({tok(src, qid_expr, text_expr)}))")


def leaf_ctes(kind: str, qt: str, out: str) -> str:
    """CTEs ending in ``{out}(qid, doc_id, s)`` for one leaf kind over the body field."""
    score = f"{idf('v.df')} * {tfn('p.tf', 'l.len')}"
    join = f"FROM {qt} q JOIN bp p ON p.term = q.term JOIN bl l ON l.doc_id = p.doc_id JOIN bv v ON v.term = q.term CROSS JOIN st"
    if kind == "term":
        return f"{out} AS (SELECT q.qid, p.doc_id, sum({score}) AS s {join} WHERE q.slot = 0 GROUP BY q.qid, p.doc_id)"
    if kind == "every_term":
        return f"{out} AS (SELECT q.qid, p.doc_id, sum({score}) AS s {join} GROUP BY q.qid, p.doc_id HAVING count(*) = max(q.n))"
    if kind == "one_of":
        return (f"{out} AS (SELECT q.qid, p.doc_id, sum((1 - 0.5 * (q.slot + 1) / q.n) * {score}) AS s {join} "
                f"GROUP BY q.qid, p.doc_id)")
    if kind == "term_prefix":
        return (f"{out} AS (SELECT DISTINCT q.qid, p.doc_id, 1.0::DOUBLE AS s FROM {qt} q JOIN bp p ON starts_with(p.term, q.term) "
                f"WHERE q.slot = 0)")
    if kind in ("phrase", "phrase_prefix"):
        pre = kind == "phrase_prefix"
        exact_cond = "q.slot < q.n - 1" if pre else "TRUE"
        single = (f"SELECT DISTINCT q.qid, p.doc_id, 1.0::DOUBLE AS s FROM {qt} q JOIN bp p ON starts_with(p.term, q.term) WHERE q.n = 1"
                  if pre else f"SELECT q.qid, p.doc_id, {score} AS s {join} WHERE q.n = 1")
        terms = (f"SELECT q.qid, q.slot, q.off, q.n, q.term FROM {qt} q WHERE q.n > 1 AND {exact_cond}")
        if pre:
            terms += (f" UNION ALL SELECT q.qid, q.slot, q.off, q.n, v.term FROM {qt} q JOIN bv v ON starts_with(v.term, q.term) "
                      f"WHERE q.n > 1 AND q.slot = q.n - 1")
        return f"""{out}_t AS ({terms}),
{out}_m AS (SELECT x.qid, t.id AS doc_id, t.pos - x.off AS start, x.slot, x.n FROM {out}_t x JOIN bt t ON t.term = x.term),
{out}_f AS (SELECT qid, doc_id, count(*) AS freq FROM (SELECT qid, doc_id, start FROM {out}_m GROUP BY qid, doc_id, start
            HAVING count(DISTINCT slot) = max(n)) GROUP BY qid, doc_id),
{out}_i AS (SELECT q.qid, sum({idf('v.df')}) AS sidf FROM {qt} q JOIN bv v ON v.term = q.term CROSS JOIN st
            WHERE q.n > 1 AND {exact_cond} GROUP BY q.qid),
{out} AS (SELECT f.qid, f.doc_id, i.sidf * {tfn('f.freq', 'l.len')} AS s FROM {out}_f f JOIN {out}_i i ON i.qid = f.qid
          JOIN bl l ON l.doc_id = f.doc_id CROSS JOIN st
          UNION ALL {single})"""
    raise ValueError(kind)


def source_leaf(kind: str, qsrc: str, out: str) -> str:
    """A leaf on the raw ``source`` field: the whole query text is one token."""
    if kind in ("phrase_prefix", "term_prefix"):
        return (f"{out} AS (SELECT q.qid, d.doc_id, 1.0::DOUBLE AS s FROM {qsrc} q JOIN documents d "
                f"ON starts_with(d.source, q.text))")
    w = "0.5 * " if kind == "one_of" else ""  # one token of one: weight 1 - 0.5 * 1/1
    return (f"{out} AS (SELECT q.qid, d.doc_id, {w}{idf('v.df')} * {tfn('1', '1', 'sst.avg_len')} AS s FROM {qsrc} q "
            f"JOIN documents d ON d.source = q.text JOIN sv v ON v.term = d.source CROSS JOIN st CROSS JOIN sst)")


def topk(hits: str, k: int = K, qcol: str = "qid") -> str:
    return (f"SELECT {qcol} AS qid, rank, doc_id, score FROM (SELECT {qcol}, doc_id, score, row_number() OVER "
            f"(PARTITION BY {qcol} ORDER BY score DESC, doc_id) AS rank FROM (SELECT {qcol}, doc_id, round(s, 4)::DOUBLE AS score "
            f"FROM {hits})) WHERE rank <= {k}")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c.strip())


BENCH_QT = slots_cte("qt", "benchmark", "item_id", "text")


def leaf_query(kind: str, k: int = K) -> str:
    return with_(idx_ctes(), BENCH_QT, leaf_ctes(kind, "qt", "h")) + "\n" + topk("h", k)


def recipe_ctes(qsrc: str = "qs", qt: str = "qt") -> str:
    parts = [leaf_ctes("phrase_prefix", qt, "r_pp"), leaf_ctes("phrase", qt, "r_ph"), leaf_ctes("every_term", qt, "r_ev"),
             leaf_ctes("one_of", qt, "r_oo"), source_leaf("phrase_prefix", qsrc, "t_pp"), source_leaf("phrase", qsrc, "t_ph"),
             source_leaf("every_term", qsrc, "t_ev"), source_leaf("one_of", qsrc, "t_oo")]
    union = ("rh AS (SELECT qid, doc_id, sum(s) AS s FROM ("
             "SELECT qid, doc_id, 20 * s AS s FROM t_pp UNION ALL SELECT qid, doc_id, 20 * s FROM t_ph UNION ALL "
             "SELECT qid, doc_id, 0.75 * s FROM t_ev UNION ALL SELECT qid, doc_id, 0.5 * s FROM t_oo UNION ALL "
             "SELECT qid, doc_id, s FROM r_pp UNION ALL SELECT qid, doc_id, s FROM r_ph UNION ALL "
             "SELECT qid, doc_id, 0.5 * s FROM r_ev UNION ALL SELECT qid, doc_id, 0.25 * s FROM r_oo) GROUP BY qid, doc_id)")
    return ",\n".join(parts + [union])


QS = "qs AS (SELECT item_id AS qid, text FROM benchmark)"


def recipe_query(k: int = K) -> str:
    return with_(idx_ctes(), BENCH_QT, QS, recipe_ctes()) + "\n" + topk("rh", k)


def keyword_ctes(out: str = "kh") -> str:
    """Keyword search over body (weight 1) and source (weight 10) per whitespace word."""
    return f"""
kw AS (SELECT item_id * 100000 + wi AS wid, item_id AS qid, replace(word, '"', '') AS word FROM (
        SELECT item_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS wi FROM (
          SELECT item_id, regexp_extract_all(coalesce(translate(text, ':?', '  '), ''), '"[^"]*"|[^\\s"]+') AS ws FROM benchmark))
        WHERE word NOT IN ('OR', 'AND')),
{slots_cte('kq', 'kw', 'wid', 'word')},
{leaf_ctes('phrase', 'kq', 'kb')},
kws AS (SELECT w.wid, w.qid, w.word AS text FROM kw w),
{out} AS (SELECT w.qid, x.doc_id, sum(x.s) AS s FROM (
        SELECT qid AS wid, doc_id, s FROM kb
        UNION ALL SELECT q.wid, d.doc_id, 10 * {idf('v.df')} * {tfn('1', '1', 'sst.avg_len')} FROM kws q
          JOIN documents d ON d.source = q.text JOIN sv v ON v.term = d.source CROSS JOIN st CROSS JOIN sst
        ) x JOIN kw w ON w.wid = x.wid GROUP BY w.qid, x.doc_id)"""


def keyword_query(k: int = K) -> str:
    return with_(idx_ctes(), keyword_ctes()) + "\n" + topk("kh", k)


def bool_nested_query() -> str:
    g = """g AS (SELECT qid, doc_id, sum(s) AS gs FROM (SELECT qid, doc_id, 2.0 * s AS s FROM hp
              UNION ALL SELECT qid, doc_id, s FROM ho) GROUP BY qid, doc_id)"""
    src = (f"srcs AS (SELECT d.doc_id, {idf('v.df')} * {tfn('1', '1', 'sst.avg_len')} AS s FROM documents d "
           f"JOIN sv v ON v.term = d.source CROSS JOIN st CROSS JOIN sst WHERE d.source = 'src1')")
    h = """h AS (SELECT g.qid, g.doc_id, 1.5 * g.gs + coalesce(srcs.s, 0) AS s FROM g JOIN documents d ON d.doc_id = g.doc_id
              LEFT JOIN srcs ON srcs.doc_id = g.doc_id WHERE d.lang IS DISTINCT FROM 'fr')"""
    return with_(idx_ctes(), BENCH_QT, leaf_ctes("phrase", "qt", "hp"), leaf_ctes("one_of", "qt", "ho"), g, src, h) \
        + "\n" + topk("h")


def match_all_query() -> str:
    h = """h AS (SELECT b.item_id AS qid, d.doc_id, 2.5::DOUBLE AS s FROM benchmark b CROSS JOIN documents d
              WHERE NOT EXISTS (SELECT 1 FROM qt x JOIN bp p ON p.term = x.term
                                WHERE x.qid = b.item_id AND x.slot = 0 AND p.doc_id = d.doc_id))"""
    return with_(idx_ctes(), BENCH_QT, h) + "\n" + topk("h")


def eval_ctes(res_sql: str, k: int = K, x: str = "") -> str:
    """Per-query metrics ``m{x}`` of ``res_sql`` (qid, rank, doc_id) against phrase-containment qrels."""
    return f"""
{leaf_ctes('phrase', 'qt', 'qp' + x)},
qr{x} AS (SELECT DISTINCT qid, doc_id FROM qp{x}),
jq{x} AS (SELECT DISTINCT qid FROM qr{x}),
res{x} AS ({res_sql}),
per{x} AS (SELECT r.qid, count(*) AS retrieved, sum(CASE WHEN q.doc_id IS NOT NULL THEN 1 ELSE 0 END) AS hits,
               sum(CASE WHEN q.doc_id IS NOT NULL THEN 1.0 / log2(r.rank + 1) ELSE 0 END) AS dcg
        FROM res{x} r LEFT JOIN qr{x} q ON q.qid = r.qid AND q.doc_id = r.doc_id WHERE r.rank <= {k} GROUP BY r.qid),
nr{x} AS (SELECT qid, count(*) AS n_rel FROM qr{x} GROUP BY qid),
ideal{x} AS (SELECT n.qid, sum(1.0 / log2(g.i + 1)) AS idcg FROM nr{x} n JOIN range(1, {k + 1}) g(i) ON g.i <= least({k}, n.n_rel)
          GROUP BY n.qid),
m{x} AS (SELECT j.qid,
        CASE WHEN coalesce(p.retrieved, 0) > 0 THEN p.hits * 1.0 / p.retrieved END AS precision,
        CASE WHEN coalesce(n.n_rel, 0) > 0 THEN coalesce(p.hits, 0) * 1.0 / n.n_rel ELSE 0.0 END AS recall,
        coalesce(p.dcg, 0.0) AS dcg,
        CASE WHEN coalesce(i.idcg, 0) > 0 THEN coalesce(p.dcg, 0.0) / i.idcg ELSE 0.0 END AS ndcg
      FROM jq{x} j LEFT JOIN per{x} p ON p.qid = j.qid LEFT JOIN nr{x} n ON n.qid = j.qid LEFT JOIN ideal{x} i ON i.qid = j.qid)"""


def _one_of_top() -> str:
    return topk("ho")


def eval_query(select: str) -> str:
    return with_(idx_ctes(), BENCH_QT, leaf_ctes("one_of", "qt", "ho"), eval_ctes(_one_of_top())) + "\n" + select


MEANS = ("round((coalesce(sum(precision), 0) / count(*))::DOUBLE, 6) AS mean_precision, round(avg(recall)::DOUBLE, 6) AS mean_recall, "
         "round(avg(dcg)::DOUBLE, 6) AS mean_dcg, round(avg(ndcg)::DOUBLE, 6) AS mean_ndcg")


def compare_query() -> str:
    body = with_(idx_ctes(), BENCH_QT, QS, recipe_ctes(), keyword_ctes(),
                 eval_ctes(topk("kh", 100), 100, "1"), eval_ctes(topk("rh", 100), 100, "2"))
    return (body + f"\nSELECT 'keyword' AS method, {MEANS} FROM m1 UNION ALL SELECT 'recipe' AS method, {MEANS} FROM m2")


def _edge_tokens() -> str:
    return (f"SELECT p_partkey, pos, {fold_sql('lower(substr(w, 1, ln))')} AS term FROM ("
            f"SELECT p_partkey, unnest(ws) AS w, unnest(range(0, len(ws))) AS pos FROM ("
            f"SELECT p_partkey, regexp_extract_all(p_name, '{EDGE_WORD}') AS ws FROM part)) "
            f"CROSS JOIN range(2, 6) b(ln) WHERE ln <= length(w)")


def altered_benchmark() -> str:
    return ("(SELECT item_id, CASE item_id % 3 WHEN 0 THEN array_to_string(w, ' ') "
            "WHEN 1 THEN array_to_string(list_concat(w[1:len(w) - 1], ['qqzzxx']), ' ') "
            "ELSE array_to_string(list_concat(w[1:1], w[3:]), ' ') END AS text "
            "FROM (SELECT item_id, string_split_regex(text, '\\s+') AS w FROM benchmark))")


SUFFIX_STEMS = ("SELECT DISTINCT term, CASE WHEN length(term) >= 7 THEN left(term, length(term) - 2) ELSE term END AS stem "
                f"FROM ({tok('documents', 'doc_id', 'text')})")


def stem_search_query() -> str:
    """Every-term search over stems: documents and queries mapped through the same dictionary."""
    plain = f"bt AS ({tok('documents', 'doc_id', 'text')})"
    stemmed = (f"sd AS ({SUFFIX_STEMS}),\nbt AS (SELECT t.id, t.pos, sd.stem AS term FROM "
               f"({tok('documents', 'doc_id', 'text')}) t JOIN sd ON sd.term = t.term)")
    assert plain in idx_ctes()
    qt = (f"q0 AS ({tok('benchmark', 'item_id', 'text')}),\nqt AS (SELECT q0.id AS qid, pos AS off, "
          "coalesce(sd.stem, q0.term) AS term, row_number() OVER (PARTITION BY q0.id ORDER BY pos) - 1 AS slot, "
          "count(*) OVER (PARTITION BY q0.id) AS n FROM q0 LEFT JOIN sd ON sd.term = q0.term)")
    return with_(idx_ctes().replace(plain, stemmed), qt, leaf_ctes("every_term", "qt", "h")) + "\n" + topk("h")


def lexicon_han_query() -> str:
    """Greedy longest match by recursion over the start of the next token."""
    letters, han = "abcdefghijklmnopqrstuvwxyz", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"
    to_han = lambda e: f"translate({e}, '{letters}', '{han}')"
    return f"""WITH RECURSIVE p AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS ws FROM part),
src AS (SELECT p_partkey, {to_han("array_to_string(ws, '')")} AS t FROM p),
lex AS (SELECT DISTINCT {to_han('w')} AS w FROM (SELECT unnest(ws) AS w FROM p UNION ALL
        SELECT array_to_string(ws[1:2], '') FROM p WHERE p_partkey % 3 = 0)),
runs AS (SELECT DISTINCT t FROM src),
best AS (SELECT r.t, s.i, max(length(lex.w)) AS l FROM runs r JOIN range(1, 200) s(i) ON s.i <= length(r.t)
         JOIN lex ON substr(r.t, s.i, length(lex.w)) = lex.w GROUP BY r.t, s.i),
walk AS (SELECT t, 1::BIGINT AS i, 0::BIGINT AS pos FROM runs
         UNION ALL SELECT w.t, w.i + coalesce(b.l, 1), w.pos + 1 FROM walk w LEFT JOIN best b ON b.t = w.t AND b.i = w.i
         WHERE w.i + coalesce(b.l, 1) <= length(w.t))
SELECT s.p_partkey, w.pos, substr(w.t, w.i, coalesce(b.l, 1)) AS term FROM src s JOIN walk w ON w.t = s.t
LEFT JOIN best b ON b.t = w.t AND b.i = w.i WHERE strlen(substr(w.t, w.i, coalesce(b.l, 1))) < 40"""


#: The documents after the second commit.
REPLACED = "(SELECT doc_id, lang, CASE WHEN lang = 'fr' THEN 'nouveau ' || text ELSE text END AS text FROM documents)"

ORACLE_SQL: dict[str, str] = {
    "tokenize_simple": f"SELECT id AS doc_id, pos, term FROM ({tok('documents', 'doc_id', 'text', fold=False)})",
    # no Han text in this corpus: every chunk is a word run, positions keep gaps of dropped tokens
    "lexicon_segment": f"SELECT id AS doc_id, pos, term FROM ({tok('documents', 'doc_id', 'text', fold=False)})",
    "lexicon_han": lexicon_han_query(),
    "fold_accents": f"SELECT term, count(*) AS n FROM ({tok('documents', 'doc_id', 'text')}) GROUP BY term",
    "drop_long": (f"SELECT d.doc_id, count(t.pos) AS n_kept, coalesce(sum(t.pos), 0)::BIGINT AS pos_sum FROM documents d "
                  f"LEFT JOIN ({tok('documents', 'doc_id', 'text', limit=6, fold=False)}) t ON t.id = d.doc_id GROUP BY d.doc_id"),
    "raw_term": ("SELECT 'source' AS field, source AS term, count(*) AS df FROM documents WHERE source IS NOT NULL GROUP BY source "
                 "UNION ALL SELECT 'lang', lang, count(*) FROM documents WHERE lang IS NOT NULL GROUP BY lang"),
    "ngrams_title": (f"SELECT p_partkey, term, count(*) AS tf FROM (SELECT p_partkey, {fold_sql('lower(substr(p_name, s + 1, ln))')} "
                     f"AS term FROM part CROSS JOIN range(0, 200) a(s) CROSS JOIN range(2, 4) b(ln) "
                     f"WHERE s + ln <= length(p_name)) GROUP BY p_partkey, term"),
    "edge_ngrams_title": _edge_tokens(),
    "postings_tf": with_(idx_ctes()) + "\nSELECT term, doc_id, tf, first_pos FROM bp",
    "doc_length": with_(idx_ctes()) + "\nSELECT d.doc_id, coalesce(bl.len, 0)::BIGINT AS len FROM documents d "
    "LEFT JOIN bl ON bl.doc_id = d.doc_id",
    "stem_user_dictionary": SUFFIX_STEMS,
    "stem_search": stem_search_query(),
    "vocab_df": with_(idx_ctes()) + "\nSELECT term, df FROM bv",
    "corpus_stats": with_(idx_ctes()) + """
SELECT 'body' AS field, st.n AS n_docs, (SELECT count(*) FROM bt) AS total_tokens, round(((SELECT count(*) FROM bt) * 1.0 / st.n)::DOUBLE, 6) AS avg_len FROM st
UNION ALL SELECT 'source', st.n, (SELECT count(*) FROM documents WHERE source IS NOT NULL), round(((SELECT count(*) FROM documents WHERE source IS NOT NULL) * 1.0 / st.n)::DOUBLE, 6) FROM st
UNION ALL SELECT 'lang', st.n, (SELECT count(*) FROM documents WHERE lang IS NOT NULL), round(((SELECT count(*) FROM documents WHERE lang IS NOT NULL) * 1.0 / st.n)::DOUBLE, 6) FROM st""",
    "num_docs": "SELECT count(*) AS num_docs FROM documents",
    "result_size": f"SELECT qid, count(*) AS size FROM ({leaf_query('every_term')}) GROUP BY qid",
    "term_match": leaf_query("term"),
    "every_term": leaf_query("every_term"),
    "one_of_terms": leaf_query("one_of"),
    "phrase": leaf_query("phrase"),
    "term_prefix": leaf_query("term_prefix"),
    "phrase_prefix": leaf_query("phrase_prefix"),
    "phrase_prefix_altered": with_(idx_ctes(), slots_cte("qt", altered_benchmark(), "item_id", "text"),
                                   leaf_ctes("phrase_prefix", "qt", "h")) + "\n" + topk("h"),
    "match_all": match_all_query(),
    "bool_nested": bool_nested_query(),
    "bool_set_operations": with_(idx_ctes(), BENCH_QT, leaf_ctes("one_of", "qt", "ho"), leaf_ctes("phrase", "qt", "hp")) + """
SELECT DISTINCT qid, doc_id FROM (
  SELECT h.qid, h.doc_id FROM ho h JOIN documents d ON d.doc_id = h.doc_id WHERE d.source = 'src1' AND d.lang IS DISTINCT FROM 'fr'
  UNION ALL SELECT qid, doc_id FROM hp)""",
    "empty_must": with_(idx_ctes(), BENCH_QT, leaf_ctes("one_of", "qt", "h"),
                        "h2 AS (SELECT qid * 2 AS qid, doc_id, s FROM h)") + "\n" + topk("h2"),
    "query_rejects": ("SELECT item_id AS qid, CASE WHEN item_id % 7 = 0 THEN 'Invalid query_type' "
                      "WHEN item_id % 7 = 1 THEN 'Invalid query_modifier' "
                      "WHEN item_id % 7 = 2 THEN 'missing field `query_type`' "
                      "WHEN item_id % 7 = 3 THEN 'missing field `query_modifier`' WHEN length(text) > 200 THEN 'Invalid text index' "
                      "ELSE 'Invalid field name' END AS reason FROM benchmark"),
    "keyword_multi_field": keyword_query(),
    "recipe_search": recipe_query(),
    "saved_queries": recipe_query(),
    "saved_queries_deep": with_(idx_ctes(), BENCH_QT, leaf_ctes("one_of", "qt", "h0"),
                                "h AS (SELECT qid, doc_id, 5.0625 * s AS s FROM h0)") + "\n" + topk("h"),
    "saved_queries_forty": with_(idx_ctes(), BENCH_QT, leaf_ctes("one_of", "qt", "h0"),
                                 "h AS (SELECT qid, doc_id, 4.0 * s AS s FROM h0)") + "\n" + topk("h"),
    "topk_per_query": with_(idx_ctes(), slots_cte("qc", "conversations", "conv_id * 1000000 + turn", "text"),
                            leaf_ctes("one_of", "qc", "h")) + "\n" + topk("h", 5),
    "explain_scores": with_(idx_ctes(), BENCH_QT) + "\nSELECT q.qid, p.doc_id, 1::INTEGER AS clause_id, q.term, "
    f"round(sum((1 - 0.5 * (q.slot + 1) / q.n) * {idf('v.df')} * {tfn('p.tf', 'l.len')}), 4)::DOUBLE AS term_score "
    "FROM qt q JOIN bp p ON p.term = q.term JOIN bl l ON l.doc_id = p.doc_id JOIN bv v ON v.term = q.term CROSS JOIN st "
    "GROUP BY q.qid, p.doc_id, q.term",
    "fast_field_search": with_(idx_ctes(), BENCH_QT, leaf_ctes("one_of", "qt", "h")) +
    f"\nSELECT r.qid, r.rank, coalesce(d.source, '') AS value, r.score FROM ({topk('h')}) r JOIN documents d ON d.doc_id = r.doc_id",
    "fetch_fields": with_(idx_ctes(), BENCH_QT, leaf_ctes("phrase", "qt", "h")) +
    f"\nSELECT r.qid, r.rank, r.doc_id, r.score, d.lang, d.source FROM ({topk('h')}) r JOIN documents d ON d.doc_id = r.doc_id",
    "typed_results": with_(idx_ctes(), BENCH_QT, leaf_ctes("phrase", "qt", "h")) +
    f"\nSELECT r.qid, r.rank, r.score, d.source, d.lang FROM ({topk('h')}) r JOIN documents d ON d.doc_id = r.doc_id",
    "results_json": with_(idx_ctes(), BENCH_QT, leaf_ctes("phrase", "qt", "h")) +
    "\nSELECT r.qid, r.rank, r.doc_id, '{\"score\":' || r.score::VARCHAR || ',\"highlights\":[]' "
    "|| coalesce(',\"source\":\"' || d.source || '\"', '') || coalesce(',\"lang\":\"' || d.lang || '\"', '') || '}' AS json "
    f"FROM ({topk('h')}) r JOIN documents d ON d.doc_id = r.doc_id",
    "delete_by_term": "SELECT doc_id FROM documents WHERE source IS DISTINCT FROM 'src1'",
    "batch_replace": ("SELECT doc_id, (CASE WHEN lang = 'fr' THEN 2 ELSE 1 END)::BIGINT AS version, "
                      f"md5(text) AS body_md5 FROM {REPLACED}"),
    "as_of_version": "SELECT doc_id, 1::BIGINT AS version, md5(text) AS body_md5 FROM documents",
    "last_version": ("SELECT 2::BIGINT AS last_version, (SELECT count(*) FROM documents WHERE lang = 'fr') AS n_adds, "
                     "(SELECT count(DISTINCT lang) FROM documents WHERE lang = 'fr') AS n_deletes"),
    "search_versions": " UNION ALL ".join(
        f"SELECT {v} AS at_version, qid, doc_id, round(s, 4)::DOUBLE AS score FROM ({with_(idx_ctes(src), BENCH_QT, leaf_ctes('phrase', 'qt', 'h'))} "
        "SELECT * FROM h)" for v, src in ((1, "documents"), (2, REPLACED))),
    "version_stats": " UNION ALL ".join(
        f"SELECT {v} AS at_version, (SELECT count(*) FROM documents) AS n_docs, count(*) AS total_tokens FROM ({tok(src, 'doc_id', 'text')})"
        for v, src in ((1, "documents"), (2, REPLACED))),
    "stream_changes": ("SELECT doc_id, CASE WHEN doc_id % 5 = 2 THEN 'new' ELSE source END AS body, lang "
                       "FROM documents WHERE doc_id % 5 NOT IN (3, 4)"),
    "stream_ingest": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
    "judged_set": with_(idx_ctes(), BENCH_QT, leaf_ctes("phrase", "qt", "qp")) +
    "\nSELECT qid, count(*) AS n_relevant FROM qp GROUP BY qid",
    "precision_recall": eval_query("SELECT qid, round(precision::DOUBLE, 6) AS precision, round(recall::DOUBLE, 6) AS recall FROM m"),
    "dcg_ndcg": eval_query("SELECT qid, round(dcg::DOUBLE, 6) AS dcg, round(ndcg::DOUBLE, 6) AS ndcg FROM m"),
    "mean_metrics": eval_query(f"SELECT {MEANS} FROM m"),
    "compare_methods": compare_query(),
    "load_corpus_json": "SELECT doc_id, source AS title, length(text) AS n_chars FROM documents",
    "load_tsv": "SELECT doc_id, source AS title, length(text) AS n_chars FROM documents",
    "utf8_repair": "SELECT page_id, url || '�' AS url_fixed FROM pages",
    "copy_fields": with_(f"ct AS ({tok('documents', 'doc_id', 'text')})") +
    "\nSELECT d.doc_id, (1 + count(ct.pos))::BIGINT AS n_tokens, coalesce(1 + max(ct.pos), 0)::BIGINT AS max_pos "
    "FROM documents d LEFT JOIN ct ON ct.id = d.doc_id GROUP BY d.doc_id",
}
