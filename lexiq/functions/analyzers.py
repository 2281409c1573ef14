"""Text analyzers (T1-T12) as Spark column expressions.

Every analyzer turns one string column into ``array<struct<pos:int, term:string>>``;
the same expression serves the corpus (index build) and query text (slots), so both
sides are analyzed identically. Everything is built from JVM-side functions
(regexp_extract_all, transform, filter, substr, translate), so no Python runs per row.
Stemming (T5) is a dictionary join applied after analysis (see ``functions.stem``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .folding import fold_col, fold_lines

# Token patterns.
# T1 simple splitter: maximal runs of letters and digits.
WORD_PATTERN = r"[\p{L}\p{N}]+"
# T7 edge n-gram word split: one character for scripts written without spaces,
# otherwise letters/digits/marks joined by in-word punctuation.
UNICODE_WORD_PATTERN = (
    r"[\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsHan}\p{IsHiragana}]\p{M}*"
    r"|[\p{L}\p{N}_\p{M}]+(?:['’.:][\p{L}\p{N}_\p{M}]+)*"
)
GRAPHEME_PATTERN = r"\X"

DEFAULT_LIMIT = 40

# The languages that an analyzer may name.
SUPPORTED_LANGUAGES = (
    "ar", "hy", "eu", "ca", "da", "nl", "en", "et", "fi", "fr", "de", "el", "hi", "hu", "id",
    "ga", "it", "lt", "ne", "no", "pt", "ro", "ru", "sr", "es", "sv", "ta", "tr", "yi",
)


@dataclass(frozen=True)
class Analyzer:
    """Declarative analyzer chain.

    kind: ``simple`` (T1 + T2 + T3 [+ T4] [+ T5]), ``ngram`` (T6), ``edge_ngram`` (T7),
    ``raw`` (T8) or ``lexicon`` (T9, segmentation against a user lexicon table).
    """

    kind: str = "simple"
    limit: int = DEFAULT_LIMIT
    lower: bool = True
    fold: bool = False
    lang: str | None = None
    min_gram: int = 1
    max_gram: int = 1
    prefix_only: bool = False
    exact_limit: bool = False
    max_word_len: int | None = None  # lexicon: longest word tried, in characters; None takes the lexicon's longest

    def __post_init__(self):
        if self.kind not in ("simple", "ngram", "edge_ngram", "raw", "lexicon"):
            raise ValueError(f"unknown analyzer kind: {self.kind}")
        if self.lang is not None and self.lang not in SUPPORTED_LANGUAGES:
            raise ValueError(f"{self.lang} is an unsupported language")
        if self.kind in ("ngram", "edge_ngram"):
            if self.min_gram < 1 or self.max_gram < self.min_gram:
                raise ValueError("ngram tokenizer: invalid min/max gram")

    def expr(self, text: Column) -> Column:
        """``array<struct<pos:int, term:string>>`` for one text value."""
        if self.kind == "simple":
            toks = _normalize(_simple(text, self.limit), self.lower, False)
            return _fold_words(toks) if self.fold else toks
        elif self.kind == "ngram":
            toks = _ngrams(text, self.min_gram, self.max_gram, self.prefix_only)
        elif self.kind == "edge_ngram":
            toks = _edge_ngrams(text, self.min_gram, self.max_gram, self.limit, self.exact_limit)
        elif self.kind == "raw":
            return F.when(text.isNull(), F.array()).otherwise(
                F.array(F.struct(F.lit(0).alias("pos"), text.alias("term"))))
        else:  # lexicon: segmentation happens as a join, see functions.lexicon
            raise ValueError("lexicon analyzer is applied with functions.lexicon.segment")
        return _normalize(toks, self.lower, self.fold)


def default() -> Analyzer:
    """The analyzer every field may name without registering it."""
    return Analyzer("simple", limit=DEFAULT_LIMIT, lower=True, fold=False)


def simple(limit: int = DEFAULT_LIMIT, lang: str | None = None, fold: bool = True) -> Analyzer:
    """Registered simple analyzer: split, drop long, lower, fold, stem(lang)."""
    return Analyzer("simple", limit=limit, lower=True, fold=fold, lang=lang)


def ngram(min_gram: int, max_gram: int, prefix_only: bool = False) -> Analyzer:
    return Analyzer("ngram", min_gram=min_gram, max_gram=max_gram, prefix_only=prefix_only,
                    lower=True, fold=True)


def edge_ngram(min_gram: int, max_gram: int, limit: int, exact_limit: bool = False) -> Analyzer:
    return Analyzer("edge_ngram", min_gram=min_gram, max_gram=max_gram, limit=limit,
                    exact_limit=exact_limit, lower=True, fold=True)


def raw() -> Analyzer:
    return Analyzer("raw", lower=False, fold=False)


def lexicon(limit: int = DEFAULT_LIMIT, max_word_len: int | None = None) -> Analyzer:
    return Analyzer("lexicon", limit=limit, lower=True, fold=False, lang="en",
                    max_word_len=max_word_len)


# --- building blocks -------------------------------------------------------------

def _tok(pos: Column, term: Column) -> Column:
    return F.struct(pos.cast("int").alias("pos"), term.alias("term"))


def _simple(text: Column, limit: int) -> Column:
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), 0)
    toks = F.transform(words, lambda w, i: _tok(i, w))
    # The length test runs before lower-casing, on UTF-8 bytes; survivors keep positions
    return F.filter(toks, lambda t: F.octet_length(t["term"]) < F.lit(limit))


def _normalize(toks: Column, lower: bool, fold: bool) -> Column:
    if not lower and not fold:
        return toks

    def norm(t):
        term = t["term"]
        if lower:
            term = F.lower(term)
        if fold:
            # folding only changes non-ASCII text: skip it when chars == bytes
            term = F.when(F.char_length(term) == F.octet_length(term), term).otherwise(fold_col(term))
        return _tok(t["pos"], term)

    return F.transform(toks, norm)


def _fold_words(toks: Column) -> Column:
    """Tokens without line breaks, folded as the lines of one text. What a lambda takes is evaluated once."""
    def folded(ts):
        text = F.array(F.array_join(F.transform(ts, lambda t: t["term"]), "\n"))
        return F.transform(text, lambda x: F.when(F.char_length(x) == F.octet_length(x), ts).otherwise(
            F.zip_with(ts, fold_lines(x), lambda t, term: _tok(t["pos"], term))))[0]

    return F.transform(F.array(toks), folded)[0]


def _int_range(lo: Column, hi: Column) -> Column:
    """[lo, hi] ascending, empty when hi < lo (``sequence`` would count down)."""
    return F.filter(F.sequence(lo, F.greatest(hi, lo)), lambda i: i <= hi)


def _ngrams(text: Column, min_gram: int, max_gram: int, prefix_only: bool) -> Column:
    """N-grams over the whole string (spaces included), all at position 0."""
    t = F.coalesce(text, F.lit(""))
    n = F.char_length(t)
    starts = _int_range(F.lit(0), F.lit(0) if prefix_only else n - 1)
    starts = F.filter(starts, lambda s: s < n)
    lens = F.sequence(F.lit(min_gram), F.lit(max_gram))
    return F.flatten(F.transform(
        starts,
        lambda s: F.transform(F.filter(lens, lambda ln: s + ln <= n),
                              lambda ln: _tok(F.lit(0), F.substr(t, s + 1, ln))),
    ))


def truncate_bytes(text: Column, limit: int, exact_limit: bool) -> Column:
    """Keep the graphemes that start before byte ``limit``.

    With ``exact_limit`` the reference quirk is kept: the cut happens only if a
    grapheme starts exactly at byte ``limit``; otherwise the whole text stays.
    """
    t = F.coalesce(text, F.lit(""))
    if not exact_limit:
        # graphemes of a short beginning will do if they reach the limit without its last one, which may be cut
        some = F.substr(t, F.lit(1), F.lit(limit + 64))
        last = F.coalesce(F.try_element_at(F.regexp_extract_all(some, F.lit(GRAPHEME_PATTERN), 0), F.lit(-1)), F.lit(""))
        t = F.when(F.octet_length(some) - F.octet_length(last) >= limit, some).otherwise(t)
    gs = F.regexp_extract_all(t, F.lit(GRAPHEME_PATTERN), 0)
    init = F.struct(F.lit(0).alias("off"), F.lit(False).alias("stop"), F.lit("").alias("acc"))

    def step(acc, g):
        stop_now = (acc["off"] == F.lit(limit)) if exact_limit else (acc["off"] >= F.lit(limit))
        cut = acc["stop"] | stop_now
        return F.when(cut, F.struct(acc["off"].alias("off"), F.lit(True).alias("stop"),
                                    acc["acc"].alias("acc"))) \
            .otherwise(F.struct((acc["off"] + F.octet_length(g)).alias("off"),
                                F.lit(False).alias("stop"), F.concat(acc["acc"], g).alias("acc")))

    return F.aggregate(gs, init, step, lambda a: a["acc"])


def _edge_ngrams(text: Column, min_gram: int, max_gram: int, limit: int, exact_limit: bool) -> Column:
    """Grapheme prefixes of every word; position = word index (short words count)."""
    cut = truncate_bytes(text, limit, exact_limit)
    words = F.regexp_extract_all(cut, F.lit(UNICODE_WORD_PATTERN), 0)

    def word_tokens(w, i):
        gs = F.regexp_extract_all(w, F.lit(GRAPHEME_PATTERN), 0)
        top = F.least(F.lit(max_gram), F.size(gs))
        return F.transform(_int_range(F.lit(min_gram), top),
                           lambda k: F.struct(
                               i.cast("int").alias("pos"),
                               F.array_join(F.slice(gs, F.lit(1), k), "").alias("term")))

    per_word = F.transform(words, word_tokens)
    if exact_limit:
        # quirk: before each word, stop only if the tokens so far equal `limit` exactly
        counts = F.transform(per_word, lambda a: F.size(a))
        init = F.struct(F.lit(0).alias("n"), F.lit(False).alias("stop"),
                        F.array().cast("array<boolean>").alias("keep"))

        def step(acc, c):
            stop = acc["stop"] | (acc["n"] == F.lit(limit))
            return F.struct((acc["n"] + c).alias("n"), stop.alias("stop"),
                            F.concat(acc["keep"], F.array(~stop)).alias("keep"))

        keep = F.aggregate(counts, init, step, lambda a: a["keep"])
        kept = F.filter(per_word, lambda a, j: F.get(keep, j))
        return F.flatten(kept)
    return F.slice(F.flatten(per_word), 1, limit)
