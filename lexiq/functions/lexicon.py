"""T9 lexicon segmentation (re-aimed): greedy longest match against a user ``lexicon(word)`` table.

Text splits into runs of Han characters and runs of other letters and digits; the latter are one token
each. Han runs are looked at once per distinct run: its substrings of two characters up to the longest
lexicon word are equi-joined with the lexicon, and the run is walked from left to right inside its row,
taking the longest match at each start (a single character if there is none). Documents without Han
text are tokenized in their row and never exploded. Then the usual chain: drop long tokens,
lower-case; English stemming is applied by the caller as for any stemmed field.

The walk of a run takes steps in proportion to its length, and copies the starts found so far at each:
runs end at any mark or space, so they are short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast, stored

# A Han run, or a run of other letters and digits, and what stands before it.
CHUNK_PATTERN = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"
SEPARATED_PATTERN = r"([^\p{L}\p{N}]*)(" + CHUNK_PATTERN + ")"
LEXICON_BROADCAST_ROWS = 5_000_000


def walked_runs(runs: DataFrame, lexicon: DataFrame, max_word_len: int | None = None) -> DataFrame:
    """(run, words) of the distinct Han ``runs`` (run): their tokens in order."""
    if max_word_len is None:
        max_word_len = max(2, lexicon.agg(F.max(F.char_length("word"))).first()[0] or 0)
    runs = runs.withColumn("n", F.char_length("run"))
    found = (runs.select("run", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
             .filter("i + 2 <= n").select("run", "i", F.explode(F.sequence(
                 F.lit(2), F.least(F.lit(max_word_len), F.col("n") - F.col("i")))).alias("l"))
             .select("run", "i", "l", F.substr("run", F.col("i") + 1, F.col("l")).alias("w")))
    lex = bounded_broadcast(lexicon.select(F.col("word").alias("w")).distinct(), LEXICON_BROADCAST_ROWS)
    best = (found.join(lex, "w", "left_semi").groupBy("run", "i").agg(F.max("l").alias("l"))
            .groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("i", "l"))).alias("best")))

    def step(acc: Column, i: Column) -> Column:
        length = F.coalesce(F.try_element_at(F.col("best"), i), F.lit(1))
        word = F.struct(i.alias("i"), length.alias("l"))
        return F.when(i < acc["next"], acc).otherwise(F.struct((i + length).alias("next"), F.concat(
            acc["words"], F.array(word)).alias("words")))

    start = F.struct(F.lit(0).alias("next"), F.array().cast("array<struct<i:int,l:int>>").alias("words"))
    empty = F.create_map().cast("map<int,int>")
    walk = F.aggregate(F.sequence(F.lit(0), F.col("n") - 1), start, step, lambda acc: acc["words"])
    return (runs.join(best, "run", "left").withColumn("best", F.coalesce("best", empty)).select("run", walk.alias("w"))
            .select("run", F.transform("w", lambda x: F.substr(F.col("run"), x["i"] + 1, x["l"])).alias("words")))


def _parts(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, max_word_len: int | None) -> DataFrame:
    """(doc_id, parts array<struct<sep, words>>) for every row of ``df``: what stands before a run, and its tokens."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(SEPARATED_PATTERN), 1).alias("sep"),
                          F.regexp_extract_all(text, F.lit(SEPARATED_PATTERN), 2).alias("chunk"))
    base = df.select(F.col(id_col).alias("doc_id"), zipped.alias("z"), text.rlike(r"\p{IsHan}").alias("han"))
    plain = base.filter(~F.col("han")).select("doc_id", F.transform("z", lambda x: F.struct(
        x["sep"].alias("sep"), F.array(x["chunk"]).alias("words"))).alias("parts"))
    chunks = base.filter("han").select("doc_id", F.posexplode("z").alias("ci", "x")).select(
        "doc_id", "ci", "x.sep", "x.chunk", F.col("x.chunk").rlike(r"^\p{IsHan}").alias("is_run"))
    runs = chunks.filter("is_run").select(F.col("chunk").alias("run")).distinct()
    walked = stored(walked_runs(stored(runs, "runs"), lexicon, max_word_len), "walked")
    words = F.coalesce("words", F.array("chunk"))
    parts = (chunks.join(walked, chunks["chunk"] == walked["run"], "left").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("ci", "sep", words.alias("words")))).alias("parts"))
        .select("doc_id", F.transform("parts", lambda p: F.struct(p["sep"].alias("sep"), p["words"].alias("words"))).alias("parts")))
    return plain.unionByName(parts)


def segment(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, max_word_len: int | None = None,
            limit: int = 40, lower: bool = True) -> DataFrame:
    """(doc_id, toks array<struct<pos:int, term:string>>) for every row of ``df``; ids are unique."""
    words = _parts(df, id_col, text_col, lexicon, max_word_len).select(
        "doc_id", F.flatten(F.transform("parts", lambda p: p["words"])).alias("w"))
    toks = words.select("doc_id", F.transform("w", lambda w, i: F.struct(i.cast("int").alias("pos"), w.alias("term"))).alias("toks"))
    toks = toks.select("doc_id", F.filter("toks", lambda t: F.octet_length(t["term"]) < limit).alias("toks"))
    return toks.select("doc_id", F.transform("toks", lambda t: F.struct(
        t["pos"].alias("pos"), (F.lower(t["term"]) if lower else t["term"]).alias("term"))).alias("toks"))


def segment_offsets(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, max_word_len: int | None = None,
                    limit: int = 40, lower: bool = True) -> DataFrame:
    """(doc_id, pos, term, start, end), a row per token, with the byte range of the token in the text."""
    rows = _parts(df, id_col, text_col, lexicon, max_word_len).select("doc_id", F.posexplode("parts").alias("ci", "p")).select(
        "doc_id", "ci", "p.sep", F.posexplode("p.words").alias("k", "w"))
    upto = Window.partitionBy("doc_id").orderBy("ci", "k")
    here = F.octet_length("w") + F.when(F.col("k") == 0, F.octet_length("sep")).otherwise(0)
    rows = rows.withColumn("end", F.sum(here).over(upto.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).withColumn(
        "pos", F.row_number().over(upto) - 1)
    return rows.filter(F.octet_length("w") < limit).select(
        "doc_id", "pos", (F.lower("w") if lower else F.col("w")).alias("term"), (F.col("end") - F.octet_length("w")).alias("start"), "end")
