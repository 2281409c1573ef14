"""Highlights (R9) for ranked results only (late materialization).

For each hit and each stored field that has query terms, the field text is re-tokenized
with byte offsets, the tokens are cut greedily into windows of at most ``max_chars`` bytes
(a new window starts when a token would end past the window start + ``max_chars``), each
window is scored by the summed weight ``1 / (1 + df)`` of its query-term tokens, and the
best window becomes the fragment: text from its first token start to its last token end,
with the byte ranges of the matching tokens relative to the fragment (sorted, overlaps
kept). Only the top-k documents are re-tokenized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.analyzers import WORD_PATTERN, Analyzer, _ngrams, _normalize, _edge_ngrams
from ..functions.lexicon import segment_offsets
from ..functions.stem import apply_stems, stem_dictionary
from ..session import bounded_broadcast, materialize, stored
from .index import TextIndex
from .search import analyze_clauses

DEFAULT_MAX_CHARS = 150


def _tokens_with_offsets(df: DataFrame, an: Analyzer, text_col: str) -> DataFrame:
    """(keys..., pos, term, start, end) with UTF-8 byte offsets."""
    keys = [c for c in df.columns if c != text_col]
    t = F.coalesce(F.col(text_col), F.lit(""))
    if an.kind == "simple":
        pat = r"([^\p{L}\p{N}]*)(" + WORD_PATTERN + ")"
        x = df.select(*keys, F.posexplode(F.arrays_zip(F.regexp_extract_all(t, F.lit(pat), 1).alias("sep"),
                                                       F.regexp_extract_all(t, F.lit(pat), 2).alias("w")))
                      .alias("pos", "z"))
        w = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = x.withColumn("end", F.sum(F.octet_length("z.sep") + F.octet_length("z.w")).over(w).cast("int"))
        x = x.withColumn("start", (F.col("end") - F.octet_length("z.w")).cast("int"))
        x = x.filter(F.octet_length("z.w") < an.limit)
        norm = _normalize(F.array(F.struct(F.col("pos").cast("int").alias("pos"), F.col("z.w").alias("term"))),
                          an.lower, an.fold)
        return x.select(*keys, "pos", norm[0]["term"].alias("term"), "start", "end")
    if an.kind == "raw":
        return df.select(*keys, F.lit(0).alias("pos"), t.alias("term"), F.lit(0).alias("start"),
                         F.octet_length(t).alias("end"))
    if an.kind == "edge_ngram":
        toks = _edge_ngrams(t, an.min_gram, an.max_gram, an.limit, an.exact_limit)
        x = df.select(*keys, F.inline(toks))
        # the edge tokenizer reports offsets 0..bytes(prefix) for every gram
        x = x.select(*keys, "pos", "term", F.lit(0).alias("start"), F.octet_length("term").alias("end"))
        norm = _normalize(F.array(F.struct("pos", "term")), an.lower, an.fold)
        return x.select(*keys, "pos", norm[0]["term"].alias("term"), "start", "end")
    if an.kind == "ngram":
        n = F.char_length(t)
        starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
        x = df.select(*keys, t.alias("_t"), F.explode(F.filter(starts, lambda s: s < n)).alias("s"))
        x = x.select(*keys, "_t", "s", F.explode(F.sequence(F.lit(an.min_gram), F.lit(an.max_gram))).alias("ln"))
        x = x.filter(F.col("s") + F.col("ln") <= F.char_length("_t"))
        if an.prefix_only:
            x = x.filter(F.col("s") == 0)
        gram = F.substr(F.col("_t"), F.col("s") + 1, F.col("ln"))
        x = x.select(*keys, F.lit(0).alias("pos"), gram.alias("term"),
                     F.octet_length(F.substr(F.col("_t"), F.lit(1), F.col("s"))).alias("start"),
                     (F.octet_length(F.substr(F.col("_t"), F.lit(1), F.col("s"))) + F.octet_length(gram)).alias("end"))
        norm = _normalize(F.array(F.struct("pos", "term")), an.lower, an.fold)
        return x.select(*keys, "pos", norm[0]["term"].alias("term"), "start", "end")
    raise ValueError(f"highlighting is not available for analyzer kind {an.kind}")


def _lexicon_tokens(df: DataFrame, index: TextIndex, name: str) -> DataFrame:
    """(qid, doc_id, value, pos, term, start, end) of a lexicon field."""
    an = index.schema.analyzer_of(name)
    keyed = df.select(F.struct("qid", "doc_id", "value").alias("key"), "text")
    toks = segment_offsets(keyed, "key", "text", index.schema.lexicon_of(name), an.max_word_len, an.limit, an.lower)
    return toks.select("doc_id.*", "pos", "term", "start", "end")


def highlights(index: TextIndex, results: DataFrame, clauses: DataFrame,
               max_chars: int = DEFAULT_MAX_CHARS) -> DataFrame:
    """(qid, doc_id, highlights array<struct<field_name, fragment<t, r>>>) for ranked hits."""
    schema = index.schema
    slots = analyze_clauses(index, clauses).select("qid", "field", "term").distinct()
    vocab = index.vocab().select("field", "term", "df")
    weights = vocab.join(bounded_broadcast(slots), ["field", "term"], "inner").withColumn("wt", 1.0 / (1.0 + F.col("df")))
    weights = bounded_broadcast(weights.select("qid", "field", "term", "wt"))
    hits = bounded_broadcast(materialize(results.select("qid", "doc_id").distinct()))
    docs = index.docs()
    parts = []
    for name in schema.stored:
        if name not in docs.columns:
            continue
        an = schema.analyzer_of(name)
        # the values of a repeated field are looked at one by one; the best fragment of all is kept
        values = F.col(name) if isinstance(docs.schema[name].dataType, ArrayType) else F.array(F.col(name))
        d = (docs.select("doc_id", name).join(hits, "doc_id")
             .select("qid", "doc_id", F.posexplode(values).alias("value", "text")))
        toks = _lexicon_tokens(d, index, name) if an.kind == "lexicon" else _tokens_with_offsets(d, an, "text")
        if an.lang is not None:  # stemmed field: same dictionary rules as the index
            toks = apply_stems(toks, bounded_broadcast(stored(
                stem_dictionary(toks, an.lang, schema.stems_of(name)), "stems")))
        toks = toks.withColumn("field", F.lit(name)).join(weights, ["qid", "field", "term"], "left") \
            .fillna(0.0, ["wt"])
        per = toks.groupBy("qid", "doc_id", "value").agg(F.sort_array(F.collect_list(
            F.struct("start", "end", "pos", "wt"))).alias("tk"), F.max("wt").alias("any_wt"))
        per = per.filter(F.col("any_wt") > 0).join(d, ["qid", "doc_id", "value"])
        best = _best_fragment(per, name, max_chars)
        parts.append(best.groupBy("qid", "doc_id").agg(F.max_by("h", F.struct("score", -F.col("value"))).alias("h")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("qid", "doc_id").agg(F.collect_list("h").alias("highlights"))


def _best_fragment(per: DataFrame, name: str, max_chars: int) -> DataFrame:
    init = F.struct(F.lit(-1).alias("cs"), F.lit(-1).alias("ce"), F.lit(0.0).alias("csc"),
                    F.lit(-1).alias("bs"), F.lit(-1).alias("be"), F.lit(0.0).alias("bsc"))

    def step(a, t):
        new_win = (a["cs"] < 0) | (t["end"] - a["cs"] > max_chars)
        better = a["csc"] > a["bsc"]
        bs = F.when(new_win & better, a["cs"]).otherwise(a["bs"])
        be = F.when(new_win & better, a["ce"]).otherwise(a["be"])
        bsc = F.when(new_win & better, a["csc"]).otherwise(a["bsc"])
        cs = F.when(new_win, t["start"]).otherwise(a["cs"])
        csc = F.when(new_win, t["wt"]).otherwise(a["csc"] + t["wt"])
        return F.struct(cs.alias("cs"), F.greatest(F.when(new_win, t["end"]).otherwise(a["ce"]), t["end"]).alias("ce"),
                        csc.alias("csc"), bs.alias("bs"), be.alias("be"), bsc.alias("bsc"))

    def finish(a):
        last_better = a["csc"] > a["bsc"]
        return F.struct(F.when(last_better, a["cs"]).otherwise(a["bs"]).alias("s"),
                        F.when(last_better, a["ce"]).otherwise(a["be"]).alias("e"), a["csc"].alias("csc"),
                        a["bsc"].alias("bsc"))

    win = per.withColumn("win", F.aggregate("tk", init, step, finish))
    frag_bytes = F.substring(F.col("text").cast("binary"), F.col("win.s") + 1, F.col("win.e") - F.col("win.s"))
    ranges = F.transform(
        F.filter("tk", lambda t: (t["wt"] > 0) & (t["start"] >= F.col("win.s")) & (t["end"] <= F.col("win.e"))),
        lambda t: F.array(t["start"] - F.col("win.s"), t["end"] - F.col("win.s")))
    frag = F.struct(frag_bytes.cast("string").alias("t"), F.array_sort(ranges).alias("r"))
    score = F.greatest("win.csc", "win.bsc")
    return win.select("qid", "doc_id", "value", score.alias("score"), F.struct(F.lit(name).alias("field_name"), frag.alias("fragment")).alias("h"))
