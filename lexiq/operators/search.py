"""Matching, BM25 scoring, boolean folding and top-k for whole tables of queries.

Plan shape for a query batch (see README "Plan"):

1. ``slots``: clause text analyzed with the field's analyzer (small table, checkpointed).
2. ``slot_terms``: exact slots joined to the vocabulary on (field, tb, term) for ``df``;
   statistics (N, avg_len) and idf are attached here. Prefix slots stay prefixes and are
   joined with the terms of the postings, map-side (equi-join on the prefix).
3. Leaves: postings JOIN broadcast(slot terms merged per clause) on (field, tb, term) --
   map-side, dynamic partition pruning reads only the needed term buckets -- then one
   aggregate per (qid, doc_id, clause_id). Postings are bucketed by document, so neither
   this aggregate nor anything below needs an exchange until the top k.
   Phrases: the documents of a clause's rarest slot are its candidates; the other slots'
   postings are joined with them, shard by shard, before positions are compared.
4. Boolean fold: the leaf hits of a (query, document) are one row, folded inside it by
   the query's groups, the deepest first; the depth of a tree adds nothing to the plan.
5. Top-k per qid with ``row_number`` (Spark plans a partial WindowGroupLimit before the
   exchange, so at most k rows per qid per shard move).

Match-all clauses read no postings: documents that another clause of the query hits get the
clause in their row; all others are alike, so the first of them by id, k and as many as the
query has hits, are all that the top k can need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stem import apply_stems, stem_dictionary
from ..plans.schema import RECORD_BASIC, RECORD_POSITIONS
from ..session import BROADCAST_BYTES, bounded_broadcast, materialize, stored
from .index import ALL_FIELD, TextIndex, term_bucket
from .matrix import SCAN_TERMS, best_documents

K1, B = 1.2, 0.75
SMALL_TABLE_ROWS = 2_000_000
#: Postings that the terms of a batch have together, from which on it is scored by products of matrices.
MATRIX_POSTINGS = 1_000_000
PREFIX, HEADS = 12, (0, 1, 3, 6)
POSITIONAL = ("phrase", "phrase_prefix")
KIND_CODES = ("phrase", "phrase_prefix", "term_prefix", "term", "every_term", "one_of", "all")


def _kc(kind: str) -> int:
    return KIND_CODES.index(kind) + 1


def bm25_idf(df: Column, n_docs: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_tf(tf: Column, length: Column, avg_len: Column) -> Column:
    return (F.lit(K1 + 1.0) * tf) / (tf + F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * length / avg_len))


# --- 1. analysis of query text ----------------------------------------------------------

def analyze_clauses(index: TextIndex, clauses: DataFrame) -> DataFrame:
    """slots(qid, clause_id, field, kind, slot, offset, term, n_slots) for leaf clauses."""
    schema = index.schema
    leaves = clauses.filter(~F.col("kind").isin("bool", "all"))
    toks = None
    lex_fields = [n for n in schema.names if schema.analyzer_of(n).kind == "lexicon"]
    for name in schema.names:
        if name in lex_fields:
            continue
        expr = schema.analyzer_of(name).expr(F.col("text"))
        toks = F.when(F.col("field") == name, expr) if toks is None else toks.when(F.col("field") == name, expr)
    empty = F.array().cast("array<struct<pos:int,term:string>>")
    toks = empty if toks is None else toks.otherwise(empty)
    analyzed = leaves.filter(~F.col("field").isin(lex_fields) | F.col("field").isNull()) \
        .select("qid", "clause_id", "field", "kind", toks.alias("toks"))
    if lex_fields:
        from ..functions.lexicon import segment
        for name in lex_fields:
            an = schema.analyzer_of(name)
            part = leaves.filter(F.col("field") == name).withColumn("_k", F.struct("qid", "clause_id"))
            seg = segment(part, "_k", "text", schema.lexicon_of(name), an.max_word_len, an.limit, an.lower)
            seg = seg.select(F.col("doc_id.qid").alias("qid"), F.col("doc_id.clause_id").alias("clause_id"), "toks")
            analyzed = analyzed.unionByName(part.select("qid", "clause_id", "field", "kind").join(
                seg, ["qid", "clause_id"]).select("qid", "clause_id", "field", "kind", "toks"))
    slots = analyzed.select("qid", "clause_id", "field", "kind", F.size("toks").alias("n_slots"),
                            F.posexplode("toks").alias("slot", "t"))
    slots = slots.select("qid", "clause_id", "field", "kind", "n_slots", "slot",
                         F.col("t.pos").alias("offset"), F.col("t.term").alias("term"))
    # stemmed fields: map slot terms through the same rules as the corpus
    stemmed = [n for n in schema.names if schema.analyzer_of(n).lang is not None]
    if stemmed:
        plain = slots.filter(~F.col("field").isin(stemmed))
        for name in stemmed:
            part = slots.filter(F.col("field") == name)
            d = stem_dictionary(part, schema.analyzer_of(name).lang, schema.stems_of(name))
            plain = plain.unionByName(apply_stems(part, bounded_broadcast(d, SMALL_TABLE_ROWS)))
        slots = plain
    # a term query uses the first token only; a one-token phrase is a term query
    slots = slots.filter(~F.col("kind").isin("term", "term_prefix") | (F.col("slot") == 0))
    n_eff = F.when(F.col("kind").isin("term", "term_prefix"), F.least(F.col("n_slots"), F.lit(1))) \
        .otherwise(F.col("n_slots"))
    slots = slots.withColumn("n_slots", n_eff)
    return slots


def slot_counts(index: TextIndex, clauses: DataFrame) -> DataFrame:
    """(qid, clause_id, n_slots) for every leaf; zero means the text analyzed to nothing."""
    s = analyze_clauses(index, clauses).groupBy("qid", "clause_id").agg(F.max("n_slots").alias("n"))
    leaves = clauses.filter(F.col("kind") != "bool").select("qid", "clause_id", "kind")
    n_slots = F.when(F.col("kind") == "all", F.lit(1)).otherwise(F.coalesce("n", F.lit(0)))
    return leaves.join(s, ["qid", "clause_id"], "left").select("qid", "clause_id", n_slots.alias("n_slots"))


# --- 2. slot terms with statistics -------------------------------------------------------

def slot_terms(index: TextIndex, slots: DataFrame) -> DataFrame:
    """Exact terms of the slots with df, idf and avg_len attached, and one row for every prefix slot, whose
    term is the prefix (``prefix_postings`` finds the terms)."""
    prefix_slot = (F.col("kind") == "term_prefix") | \
        ((F.col("kind") == "phrase_prefix") & (F.col("slot") == F.col("n_slots") - 1))
    s = slots.withColumn("is_prefix", prefix_slot)
    vocab = index.vocab()
    exact = s.filter(~F.col("is_prefix")).withColumn("tb", term_bucket(F.col("term"), index.term_buckets))
    exact = vocab.join(bounded_broadcast(exact, SMALL_TABLE_ROWS), ["field", "tb", "term"], "inner")
    exact = exact.unionByName(s.filter(F.col("is_prefix")), allowMissingColumns=True)
    # one row per field: bounded by the schema, broadcast without a count
    stats = F.broadcast(index.stats().select("field", "n_docs", "avg_len"))
    return (exact.join(stats, "field", "inner")
            .withColumn("idf", bm25_idf(F.col("df").cast("double"), F.col("n_docs").cast("double"))))


def prefix_postings(postings: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``postings`` (field, term, ...) joined with the prefixes that their terms start with: rows of the stored table
    ``prefixes`` (field, term, ...), whose term becomes ``start``.

    Only the query side is broadcast, however many terms a prefix has. A term's first characters tell which lengths
    of prefixes it is looked up for, up to PREFIX characters, in an equi-join on the prefix itself: its first h tell
    of the prefixes that are at least h long and shorter than the next of HEADS, so that few lookups find nothing."""
    head = lambda h: F.substr("term", F.lit(1), F.lit(h)).alias("head")
    p = prefixes.withColumn("plen", F.least(F.char_length("term"), F.lit(PREFIX)))
    shapes = p.select("field", "plen").distinct().collect()  # fields x (PREFIX + 1) at most
    x = postings.filter(F.col("field").isin(sorted({r["field"] for r in shapes})))
    found = []
    for h, longer in zip(HEADS, (*HEADS[1:], PREFIX + 1)):
        if any(h <= r["plen"] < longer for r in shapes):
            found.append(f"plens{h}")
            heads = p.filter((F.col("plen") >= h) & (F.col("plen") < longer)).groupBy("field", head(h)).agg(F.collect_set("plen").alias(found[-1]))
            x = x.withColumn("head", head(h)).join(bounded_broadcast(heads, SMALL_TABLE_ROWS), ["field", "head"], "left").drop("head")
    lengths = F.concat(F.array().cast("array<int>"), *[F.coalesce(c, F.array().cast("array<int>")) for c in found])
    x = x.withColumn("plen", F.explode(lengths)).drop(*found).withColumn("prefix", F.substr("term", F.lit(1), F.col("plen")))
    p = p.withColumn("prefix", F.substr("term", F.lit(1), F.col("plen"))).withColumnRenamed("term", "start")
    return (x.join(bounded_broadcast(p, SMALL_TABLE_ROWS), ["field", "plen", "prefix"], "inner")
            .filter(F.startswith(F.col("term"), F.col("start"))).drop("plen", "prefix"))


# --- 3/4. leaf hits ----------------------------------------------------------------------

def _record_of(index: TextIndex) -> Column:
    """1 if the field scores with tf = 1 (basic record option)."""
    basic = [f.name for f in index.schema.fields if f.record == RECORD_BASIC]
    return F.col("field").isin(basic) if basic else F.lit(False)


def is_positional() -> Column:
    return F.col("kind").isin(*POSITIONAL) & (F.col("n_slots") > 1)


def leaf_hits(index: TextIndex, terms: DataFrame, explain: bool = False) -> DataFrame:
    """(qid, hit_doc, clause_id, score) before the clause boost; ``terms`` is a stored table.

    Only columns under a name of their own show the planner that all parts have the same document shards, so
    that it unites them without an exchange; the fold gives ``doc_id`` back its name once it has grouped."""
    part = F.when(is_positional(), "phrase").when(F.col("is_prefix"), "prefix").otherwise("term")
    has = {r["part"] for r in terms.select(part.alias("part")).distinct().collect()}
    parts = [f(index, terms, explain) for name, f in (("term", term_hits), ("prefix", prefix_hits), ("phrase", phrase_hits)) if name in has]
    if not parts:  # no term is in the vocabulary
        parts = [term_hits(index, terms.limit(0), explain)]
    parts = [p.withColumnRenamed("doc_id", "hit_doc") for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merged_terms(terms: DataFrame) -> DataFrame:
    """Slot terms of all leaves but prefixes and phrases of several slots, merged per (qid, field, term, clause): a term used by
    several slots of a clause is one row with the summed weight and the number of slots it fills."""
    kind = F.col("kind")
    weight = F.when(kind == "one_of", F.lit(1.0) - F.lit(0.5) * (F.col("slot") + 1) / F.col("n_slots")) \
        .otherwise(F.lit(1.0))
    code = F.array_position(F.array(*[F.lit(k) for k in KIND_CODES]), F.col("kind")).cast("int")
    return (terms.filter(~is_positional() & ~F.col("is_prefix"))
            .groupBy("qid", "field", "term", "clause_id")
            .agg(F.max(code).alias("kc"), F.max("n_slots").alias("n_slots"),
                 F.sum(weight).alias("coef"), F.count(F.lit(1)).alias("n_fill"),
                 F.max("idf").alias("idf"), F.max("avg_len").alias("avg_len")))


def term_hits(index: TextIndex, terms: DataFrame, explain: bool = False) -> DataFrame:
    """Hits of all leaves but prefixes and phrases of several slots: one aggregate per (qid, doc_id, clause_id) over
    postings joined map-side with the query terms, the BM25 scores of a clause's slots summed."""
    per_term = merged_terms(terms)
    # The terms are read back from a table: with a known size and a filter, the planner prunes the
    # posting partitions (field, tb) by the broadcast terms, so only their buckets are read.
    pt = stored(per_term.withColumn("tb", term_bucket(F.col("term"), index.term_buckets)), "slot-terms")
    pt = bounded_broadcast(pt.filter(F.col("n_fill") > 0), SMALL_TABLE_ROWS)
    x = index.postings().select("field", "tb", "term", "doc_id", "tf", "len").join(pt, ["field", "tb", "term"], "inner")
    x = x.withColumn("tf", F.when(_record_of(index), F.lit(1)).otherwise(F.col("tf")))
    # integer kind codes keep every aggregation buffer fixed-width (hash aggregate, codegen)
    kc = F.col("kc")
    row_score = F.col("coef") * F.col("idf") * bm25_tf(F.col("tf").cast("double"), F.col("len").cast("double"), F.col("avg_len"))
    extra = [F.collect_list(F.struct("term", row_score.alias("row_score"))).alias("explain")] if explain else []
    agg = x.groupBy("qid", "doc_id", "clause_id").agg(
        F.max("kc").alias("kc"), F.max("n_slots").alias("n_slots"), F.sum("n_fill").alias("n_fill"),
        F.sum(row_score).alias("s"), *extra)
    agg = agg.filter((kc != _kc("every_term")) | (F.col("n_fill") == F.col("n_slots")))
    return agg.withColumnRenamed("s", "score").select(
        "qid", "doc_id", "clause_id", "score", *(["explain"] if explain else []))


def prefix_hits(index: TextIndex, terms: DataFrame, explain: bool = False) -> DataFrame:
    """Hits of prefixes that are no part of a phrase of several slots: each scores 1."""
    prefixes = stored(terms.filter(~is_positional() & F.col("is_prefix")).select("qid", "clause_id", "field", "term").distinct(), "prefixes")
    x = prefix_postings(index.postings().select("field", "term", "doc_id"), prefixes)
    extra = [F.collect_set(F.struct("term", F.lit(1.0).alias("row_score"))).alias("explain")] if explain else []
    return x.groupBy("qid", "doc_id", "clause_id").agg(F.lit(1.0).alias("score"), *extra)


def phrase_hits(index: TextIndex, terms: DataFrame, explain: bool = False) -> DataFrame:
    """Hits of phrases and phrase prefixes of several slots.

    A clause with an exact slot that no vocabulary term fills has no hits. For the others, the exact slot
    with the fewest documents gives the candidates; the postings of all slots, with positions, are
    semi-joined with them, and the shifted position sets are intersected in the row (phrase
    frequency = number of common starts). The vocabulary tells how many candidates there are at
    most: a bounded number is broadcast, so that only postings of their documents meet the slots;
    more are joined in their document shards by hash tables, of which none is larger than that on average.
    """
    of_clause = Window.partitionBy("qid", "clause_id")
    rarest = F.min(F.when(~F.col("is_prefix"), F.struct("df", "slot"))).over(of_clause)["slot"]
    slots = (terms.filter(is_positional()).withColumn("filled", F.size(F.collect_set("slot").over(of_clause)))
             .filter(F.col("filled") == F.col("n_slots")).withColumn("lead", F.col("slot") == rarest)
             .select("qid", "field", "tb", "term", "clause_id", "slot", "offset", "is_prefix", "idf", "avg_len", "n_slots", "df", "lead"))
    slots = stored(slots, "slots")  # read back with a filter: the posting partitions are pruned
    lead = bounded_broadcast(slots.filter("lead AND NOT is_prefix").select("field", "tb", "term", "qid", "clause_id"), SMALL_TABLE_ROWS)
    cand = (index.postings().select("field", "tb", "term", "doc_id").join(lead, ["field", "tb", "term"])
            .select("qid", "doc_id", "clause_id"))
    most = slots.filter("lead").agg(F.sum("df")).first()[0] or 0
    postings = index.postings().select("field", "tb", "term", "doc_id", "len", "positions")
    if most <= SMALL_TABLE_ROWS:
        cand = stored(cand, "candidates")
        postings = postings.join(bounded_broadcast(cand.select("doc_id").distinct(), SMALL_TABLE_ROWS), "doc_id", "left_semi")
        cand = bounded_broadcast(cand, SMALL_TABLE_ROWS)
    elif isinstance(index, TextIndex) and most <= SMALL_TABLE_ROWS * index.doc_shards:
        # a hash table for every shard: neither postings nor candidates are exchanged or sorted
        postings = postings.join(cand.select("doc_id").hint("shuffle_hash"), "doc_id", "left_semi")
        cand = cand.hint("shuffle_hash")
    of_slot = ["qid", "clause_id", "slot", "offset", "is_prefix", "idf", "avg_len", "n_slots"]
    cols = [F.col("doc_id").alias("hit"), "len", "positions", *of_slot]
    exact = bounded_broadcast(slots.filter("n_slots > 1 AND NOT is_prefix").select("field", "tb", "term", *of_slot), SMALL_TABLE_ROWS)
    y = postings.join(exact, ["field", "tb", "term"], "inner").select(*cols)
    prefixes = slots.filter("is_prefix").select("field", "term", *of_slot)
    if prefixes.limit(1).count():
        y = y.unionByName(prefix_postings(postings.drop("tb"), prefixes).select(*cols))
    y = y.join(cand.withColumnRenamed("doc_id", "hit"), ["qid", "hit", "clause_id"], "left_semi").withColumnRenamed("hit", "doc_id")
    pos = y.groupBy("qid", "doc_id", "clause_id").agg(
        F.max("n_slots").alias("n_slots"), F.max("len").alias("len"), F.max("avg_len").alias("avg_len"),
        F.collect_list(F.struct("slot", "offset", "is_prefix", "idf", "positions")).alias("lst"))
    pos = pos.withColumn("ds", F.array_distinct(F.transform("lst", lambda e: e["slot"])))
    # every slot must be there
    pos = pos.filter(F.size("ds") == F.col("n_slots"))
    # positions of each distinct slot, shifted by the slot offset (a prefix slot may hold several terms)
    pos = pos.withColumn("sh", F.transform(
        "ds", lambda d: F.array_distinct(F.flatten(F.transform(
            F.filter(F.col("lst"), lambda e: e["slot"] == d),
            lambda e: F.transform(e["positions"], lambda p: p - e["offset"]))))))
    starts = F.aggregate(F.slice(F.col("sh"), 2, F.greatest(F.size("sh") - 1, F.lit(1))), F.col("sh")[0],
                         lambda acc, a: F.array_intersect(acc, a))
    sum_idf = F.aggregate(F.filter("lst", lambda e: ~e["is_prefix"]), F.lit(0.0), lambda a, e: a + e["idf"])
    pos = pos.withColumn("freq", F.size(starts)).filter(F.col("freq") > 0)
    pos = pos.withColumn("score", sum_idf * bm25_tf(F.col("freq").cast("double"), F.col("len").cast("double"),
                                                    F.col("avg_len")))
    if explain:
        pos = pos.withColumn("explain", F.array(F.struct(F.lit("").alias("term"), F.col("score").alias("row_score"))))
    return pos.select("qid", "doc_id", "clause_id", "score", *(["explain"] if explain else []))


# --- 4. boolean fold ---------------------------------------------------------------------

#: Modifiers inside a row.
MUST, SHOULD, MUST_NOT = 0, 1, 2


def modifier_code() -> Column:
    m = F.col("modifier")
    return F.when(m == "must", MUST).when(m == "should", SHOULD).when(m == "must_not", MUST_NOT)


def query_trees(clauses: DataFrame) -> DataFrame:
    """(qid, groups, alls): a query's groups, children before parents and the root (0) last, and the
    hits that its match-all clauses are for every document. A query's tree fits a row: it came from one."""
    n_must = clauses.groupBy("qid", F.col("parent_id").alias("clause_id")).agg(
        F.sum(F.when(F.col("modifier") == "must", 1).otherwise(0)).cast("int").alias("n_must"))
    root = clauses.select("qid").distinct().select(
        "qid", F.lit(0).alias("clause_id"), F.lit(-1).alias("parent_id"), F.lit(0).alias("depth"), F.lit(SHOULD).alias("mod"),
        F.lit(1.0).alias("boost"))
    groups = clauses.filter(F.col("kind") == "bool").select(
        "qid", "clause_id", "parent_id", "depth", modifier_code().alias("mod"), "boost").unionByName(root)
    # a group without children can't match
    groups = groups.join(n_must, ["qid", "clause_id"]).groupBy("qid").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("depth")).alias("order"), F.col("clause_id").alias("id"), F.col("parent_id").alias("p"),
        F.col("mod").alias("m"), "boost", "n_must"))).alias("groups"))
    alls = clauses.filter(F.col("kind") == "all").groupBy("qid").agg(F.collect_list(F.struct(
        F.col("parent_id").alias("p"), modifier_code().alias("m"), F.col("boost").alias("s"))).alias("alls"))
    none = F.array().cast("array<struct<p:int,m:int,s:double>>")
    return groups.join(alls, "qid", "left").select("qid", "groups", F.coalesce("alls", none).alias("alls"))


def fold_row(hits: Column, groups: Column) -> Column:
    """Score of a document, null if the query doesn't match it. ``hits``: (parent, modifier, score) of the
    clauses that hit it. A group matches when every Must child matches, no MustNot child does, and it has a Must
    child or some Should child matches; its score is the sum of its Must and Should children's times its boost."""
    def step(acc, g):
        kids = F.filter(acc, lambda h: h["p"] == g["id"])
        rest = F.filter(acc, lambda h: h["p"] != g["id"])
        n_must = F.size(F.filter(kids, lambda h: h["m"] == MUST))
        ok = ((n_must == g["n_must"]) & ~F.exists(kids, lambda h: h["m"] == MUST_NOT)
              & ((g["n_must"] > 0) | F.exists(kids, lambda h: h["m"] == SHOULD)))
        score = F.aggregate(kids, F.lit(0.0), lambda a, h: a + h["s"]) * g["boost"]
        return F.when(ok, F.concat(rest, F.array(F.struct(g["p"].alias("p"), g["m"].alias("m"), score.alias("s"))))) \
            .otherwise(rest)

    return F.aggregate(groups, hits, step, lambda acc: F.get(F.filter(acc, lambda h: h["p"] == -1), F.lit(0))["s"])


def rows_of_hits(clauses: DataFrame, hits: DataFrame) -> DataFrame:
    """(qid, doc_id, hits): the leaf hits of a document in one row."""
    info = bounded_broadcast(clauses.filter("kind <> 'bool'").select("qid", "clause_id", "parent_id", modifier_code().alias("m"),
                                                                     "boost"), SMALL_TABLE_ROWS)
    return hits.join(info, ["qid", "clause_id"]).groupBy("qid", "hit_doc").agg(F.collect_list(F.struct(
        F.col("parent_id").alias("p"), "m", (F.col("score") * F.col("boost")).alias("s"))).alias("hits")).withColumnRenamed(
        "hit_doc", "doc_id")


def folded(rows: DataFrame, trees: DataFrame) -> DataFrame:
    """(qid, doc_id, score) of the documents that match, from ``rows_of_hits``."""
    score = fold_row(F.concat("hits", "alls"), F.col("groups"))
    return (rows.join(bounded_broadcast(trees, SMALL_TABLE_ROWS), "qid").select("qid", "doc_id", score.alias("score"))
            .filter(F.col("score").isNotNull()))


def fold(clauses: DataFrame, hits: DataFrame) -> DataFrame:
    """(qid, doc_id, score) of the documents that match, from the hits of leaves but match-all.
    Documents that only match-all clauses hit are not among them, see ``rest_of_documents``."""
    shape = clauses.agg(F.max("depth").alias("depth"), F.max((F.col("kind") == "all").cast("int")).alias("all")).first()
    if shape["depth"] is None or shape["depth"] > 1 or shape["all"]:
        return folded(rows_of_hits(clauses, hits), stored(query_trees(clauses), "trees"))
    info = bounded_broadcast(clauses.select("qid", "clause_id", modifier_code().alias("m"), "boost"), SMALL_TABLE_ROWS)
    rows = hits.join(info, ["qid", "clause_id"]).select("qid", "hit_doc", "m", (F.col("score") * F.col("boost")).alias("score"))
    if single_leaf_batch(clauses):
        # every query is one top-level must/should leaf: the fold is the identity (x boost)
        return rows.select("qid", F.col("hit_doc").alias("doc_id"), "score")
    needs = bounded_broadcast(clauses.groupBy("qid").agg(F.sum((F.col("modifier") == "must").cast("int")).alias("n_must")),
                              SMALL_TABLE_ROWS)
    count = lambda code: F.sum((F.col("m") == code).cast("int"))
    return (rows.groupBy("qid", "hit_doc").agg(
        count(MUST).alias("must"), count(SHOULD).alias("should"), count(MUST_NOT).alias("must_not"),
        F.sum(F.when(F.col("m") != MUST_NOT, F.col("score")).otherwise(0.0)).alias("score"))
        .join(needs, "qid").filter((F.col("must") == F.col("n_must")) & (F.col("must_not") == 0)
                                   & ((F.col("n_must") > 0) | (F.col("should") > 0)))
        .select("qid", F.col("hit_doc").alias("doc_id"), "score"))


def single_leaf_batch(clauses: DataFrame) -> bool:
    """True when every query is a single top-level Must/Should leaf (one small aggregate)."""
    bad = (F.col("kind") == "bool") | (F.col("modifier") == "must_not") | (F.col("depth") != 1)
    per_q = clauses.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.max(bad.cast("int")).alias("b"))
    r = per_q.agg(F.max("n").alias("n"), F.max("b").alias("b")).first()
    return r is not None and r["n"] == 1 and r["b"] == 0


def rest_of_documents(index: TextIndex, trees: DataFrame, rows: DataFrame, k: int | None) -> DataFrame:
    """(qid, doc_id, score) of documents that only match-all clauses hit, of the queries that match
    them at all. They have one score, so with ``k`` only the first k by id are given: as ids that the
    query hits are not among them, the first k and as many as it hits are looked at, not all documents.
    ``rows`` is a stored table with the (qid, doc_id) that other clauses hit."""
    score = fold_row(F.col("alls"), F.col("groups"))
    const = trees.filter(F.size("alls") > 0).select("qid", score.alias("score")).filter(F.col("score").isNotNull())
    if k is None:  # documents x queries is the result
        every = const.select("qid", "score").crossJoin(index.docs().select("doc_id"))
        return every.join(rows.select("qid", "doc_id"), ["qid", "doc_id"], "left_anti").select("qid", "doc_id", "score")
    taken = rows.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    first = (const.join(taken, "qid", "left").withColumn("most", F.coalesce("n", F.lit(0)) + k)
             .select("qid", "score", F.explode(F.sequence(F.lit(0).cast("long"), F.col("most") - 1)).alias("ord")))
    ids = index.ids()
    return (first.join(ids, "ord").select("qid", "doc_id", "score")
            .join(rows.select("qid", "doc_id"), ["qid", "doc_id"], "left_anti"))


# --- 5. top-k ----------------------------------------------------------------------------

def top_k(hits: DataFrame, k: int, round_digits: int | None = None) -> DataFrame:
    """Best ``k`` docs per qid, score descending, ties by doc_id."""
    if k is None or k < 1:
        raise ValueError("docsLimit must be greater than 0")
    h = hits if round_digits is None else hits.withColumn("score", F.round("score", round_digits))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return (h.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("qid", F.col("rank").cast("long").alias("rank"), "doc_id", "score"))


def flatten_should_groups(clauses: DataFrame) -> DataFrame:
    """Lift the leaves of Should groups whose children are all Should leaves into the
    group's parent (boosts multiplied). Same matches and scores: such a group matches when
    any child does and adds the children's summed score; one fold level less."""
    kids = clauses.groupBy("qid", F.col("parent_id").alias("clause_id")).agg(
        F.max(((F.col("modifier") != "should") | (F.col("kind") == "bool")).cast("int")).alias("bad"))
    lift = (clauses.filter((F.col("kind") == "bool") & (F.col("modifier") == "should"))
            .join(kids, ["qid", "clause_id"], "inner").filter(F.col("bad") == 0)
            .select("qid", F.col("clause_id").alias("g"), F.col("parent_id").alias("g_parent"),
                    F.col("depth").alias("g_depth"), F.col("boost").alias("g_boost")))
    lift = materialize(lift)
    cols = clauses.columns
    out = (clauses.join(bounded_broadcast(lift.withColumnRenamed("g", "parent_id"), SMALL_TABLE_ROWS),
                        ["qid", "parent_id"], "left")
           .withColumn("parent_id", F.coalesce("g_parent", "parent_id"))
           .withColumn("depth", F.coalesce("g_depth", "depth"))
           .withColumn("boost", F.col("boost") * F.coalesce("g_boost", F.lit(1.0)))
           .select(*cols))
    gone = bounded_broadcast(lift.select("qid", F.col("g").alias("clause_id")), SMALL_TABLE_ROWS)
    return out.join(gone, ["qid", "clause_id"], "left_anti")


def without_lone_groups(clauses: DataFrame) -> DataFrame:
    """A group with one child, that is no MustNot, matches when the child does: the child takes its place, its
    modifier and its boost (multiplied). A chain of such groups vanishes, however deep."""
    kids = clauses.groupBy("qid", F.col("parent_id").alias("clause_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max("modifier").alias("only"))
    lone = stored(clauses.filter("kind = 'bool'").join(kids, ["qid", "clause_id"]).filter("n = 1 AND only <> 'must_not'")
                  .select("qid", "clause_id", "parent_id", "depth", "modifier", "boost"), "lone-groups")
    if lone.limit(1).count() == 0:
        return clauses
    # of a query, the deepest first: one pass takes a clause up through all of them. They fit a row: they came from one
    chain = lone.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("depth")).alias("order"), F.col("clause_id").alias("id"), "parent_id", "depth", "modifier", "boost"))).alias("chain"))

    def up(acc, g):
        return F.when(acc["parent_id"] == g["id"], F.struct(
            g["parent_id"].alias("parent_id"), g["depth"].alias("depth"), g["modifier"].alias("modifier"),
            (acc["boost"] * g["boost"]).alias("boost"))).otherwise(acc)

    place = F.aggregate("chain", F.struct("parent_id", "depth", "modifier", "boost"), up)
    placed = (clauses.join(bounded_broadcast(lone.select("qid", "clause_id"), SMALL_TABLE_ROWS), ["qid", "clause_id"], "left_anti")
              .join(bounded_broadcast(chain, SMALL_TABLE_ROWS), "qid", "left")
              .withColumn("place", F.when(F.col("chain").isNotNull(), place)))
    for c in ("parent_id", "depth", "modifier", "boost"):
        placed = placed.withColumn(c, F.coalesce(F.col("place")[c], F.col(c)))
    return placed.select(*clauses.columns)


def without_positions(index: TextIndex, slots: DataFrame) -> DataFrame:
    """(qid, clause_id, field) of phrases of several slots on fields that keep no positions."""
    bare = [f.name for f in index.schema.fields if f.record < RECORD_POSITIONS]
    return slots.filter(is_positional() & F.col("field").isin(bare)).select("qid", "clause_id", "field").distinct()


def flat_clauses(clauses: DataFrame) -> DataFrame:
    """A clause table without groups that can be done without."""
    return materialize(flatten_should_groups(materialize(without_lone_groups(materialize(clauses)))))


def clause_terms(index: TextIndex, clauses: DataFrame) -> DataFrame:
    """The stored ``slot_terms`` of a clause table."""
    slots = analyze_clauses(index, clauses)
    if any(f.record < RECORD_POSITIONS for f in index.schema.fields):
        slots = materialize(slots)
        bad = without_positions(index, slots).orderBy("qid", "clause_id").first()
        if bad is not None:
            raise ValueError(f"Field does not have positions indexed: {bad['field']} (query {bad['qid']}, clause {bad['clause_id']})")
    return stored(slot_terms(index, slots), "terms")


def search_hits(index: TextIndex, clauses: DataFrame, k: int | None = None, explain: bool = False) -> DataFrame:
    """(qid, doc_id, score) of the documents that match a clause table: all, or with ``k`` all that may
    be among the first k. ``explain``: the hits of every leaf but match-all with the scores of their terms."""
    clauses = flat_clauses(clauses)
    return hits_of_terms(index, clauses, clause_terms(index, clauses), k, explain)


def hits_of_terms(index: TextIndex, clauses: DataFrame, terms: DataFrame, k: int | None, explain: bool = False) -> DataFrame:
    """``search_hits`` of ``flat_clauses`` and their ``clause_terms``."""
    hits = leaf_hits(index, terms, explain=explain)
    if explain:
        return hits.withColumnRenamed("hit_doc", "doc_id")
    if clauses.filter("kind = 'all'").limit(1).count() == 0:
        return fold(clauses, hits)
    trees = stored(query_trees(clauses), "trees")
    free = trees.filter(F.size("alls") > 0).select("qid")
    rows = rows_of_hits(clauses, hits)
    with_all = stored(rows.join(bounded_broadcast(free), "qid", "left_semi"), "hits")
    out = folded(with_all, trees).unionByName(rest_of_documents(index, trees, with_all, k))
    if trees.filter(F.size("alls") == 0).limit(1).count():
        out = out.unionByName(folded(rows.join(bounded_broadcast(free), "qid", "left_anti"), trees))
    return out


def search(index: TextIndex, clauses: DataFrame, k: int, round_digits: int | None = None) -> DataFrame:
    """results(qid, rank, doc_id, score). A phrase on a field without positions is an error, as in
    ``query_rejects``, which finds such queries beforehand."""
    if k is None or k < 1:
        raise ValueError("docsLimit must be greater than 0")
    clauses = flat_clauses(clauses)
    terms = clause_terms(index, clauses)
    if round_digits is not None and isinstance(index, TextIndex) and sums_of_leaves(clauses):
        seen = terms.filter(~is_positional() & ~F.col("is_prefix")).agg(F.sum("df")).first()[0] or 0
        if seen >= MATRIX_POSTINGS:
            found = matrix_search(index, clauses, terms, k, round_digits)
            if found is not None:
                return found
    return top_k(hits_of_terms(index, clauses, terms, k), k, round_digits)


def sums_of_leaves(clauses: DataFrame) -> bool:
    """Whether every clause is a top-level Should leaf with a positive boost: a query's score is the sum of its leaves'."""
    plain = (F.col("depth") == 1) & (F.col("parent_id") == 0) & (F.col("modifier") == "should") & ~F.col("kind").isin("bool", "all") & (F.col("boost") > 0)
    return clauses.filter(~F.coalesce(plain, F.lit(False))).limit(1).count() == 0


def matrix_search(index: TextIndex, clauses: DataFrame, terms: DataFrame, k: int, digits: int) -> DataFrame | None:
    """results(qid, rank, doc_id, score) of a batch of ``sums_of_leaves``. Prefixes and phrases are found as in other batches and
    their scores added, if they are a bounded number; None if they are more."""
    boost = bounded_broadcast(clauses.groupBy("qid", "clause_id").agg(F.sum("boost").alias("boost")), SMALL_TABLE_ROWS)
    other = stored(terms.filter(is_positional() | F.col("is_prefix")), "other-terms")
    extra = None
    if other.limit(1).count():
        extra = leaf_hits(index, other).join(boost, ["qid", "clause_id"]).groupBy("qid", "hit_doc").agg(F.sum(F.col("score") * F.col("boost")).alias("score"))
        extra = stored(extra.select("qid", F.col("hit_doc").alias("doc_id"), "score"), "extra")
        size = extra.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("doc_id").cast("string")) + 16).alias("bytes")).first()
        if size["n"] > SMALL_TABLE_ROWS or (size["bytes"] or 0) > BROADCAST_BYTES:
            return None
        extra = extra if size["n"] else None
    fields = sorted(r["field"] for r in terms.select("field").distinct().collect())
    # terms of several fields are told apart by the number of the field
    number = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field")).cast("string")
    key = F.concat(number, F.lit(" "), F.col("term")) if len(fields) > 1 else F.col("term")
    every = F.col("kc") == _kc("every_term")
    weights = (merged_terms(terms).join(boost, ["qid", "clause_id"])
               .select("qid", F.when(every, F.col("clause_id")).otherwise(0).alias("unit"), F.when(every, F.col("n_slots")).otherwise(0).alias("need"),
                       key.alias("key"), (F.col("coef") * F.col("idf") * F.col("boost")).alias("weight"), F.when(every, F.col("n_fill")).otherwise(0).alias("fill")))
    if extra is not None:  # a row, that weighs nothing, for queries without another
        weights = weights.unionByName(extra.select("qid", F.lit(0).alias("unit"), F.lit(0).alias("need"), F.lit("").alias("key"), F.lit(0.0).alias(
            "weight"), F.lit(0).cast("long").alias("fill")).distinct())
    weights = (weights.groupBy("qid", "unit", "key").agg(F.max("need").alias("need"), F.sum("weight").alias("weight"), F.sum("fill").alias("fill")))
    postings = index.postings().select("field", "tb", "term", "doc_id", "tf", "len").filter(F.col("field").isin(fields + [ALL_FIELD] * (extra is not None)))
    used = stored(terms.filter(~is_positional() & ~F.col("is_prefix")).select("field", "tb", "term").distinct(), "scan-terms")
    if used.count() <= SCAN_TERMS:
        if extra is not None:  # every document is in its shard, for scores that are added
            used = used.unionByName(used.sparkSession.range(1).select(
                F.lit(ALL_FIELD).alias("field"), term_bucket(F.lit(""), index.term_buckets).alias("tb"), F.lit("").alias("term")))
        postings = postings.join(bounded_broadcast(used, SMALL_TABLE_ROWS), ["field", "tb", "term"], "left_semi")
    stats = F.broadcast(index.stats().select("field", "avg_len"))  # one row per field
    tf = F.when(_record_of(index), F.lit(1)).otherwise(F.col("tf")).cast("double")
    postings = postings.join(stats, "field").select("doc_id", F.when(F.col("field") == ALL_FIELD, "").otherwise(key).alias("key"), F.coalesce(bm25_tf(
        tf, F.col("len").cast("double"), F.col("avg_len")), F.lit(0.0)).alias("factor"))
    spark = index.spark
    conf = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # the planner doesn't see that batches need the shards
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    out = None
    try:
        for found in best_documents(index, postings, weights, extra, k, digits):
            part = stored(top_k(found, k, digits), "results")
            out = part if out is None else out.unionByName(part)
    finally:
        spark.conf.set(conf, before)
    return out
