"""T5 stemming as a dictionary join.

The dictionary ``(term, stem)`` is built by a job over the *distinct* terms only
(``mapInPandas``); the per-term rule set is a small Python helper implementing the
published English (Porter2 / Snowball) algorithm. Other languages take a user-supplied
``(lang, term, stem)`` table through the same join.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the published English (Porter2) algorithm.
_VOWELS = "aeiouy"
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI_ENDING = "cdeghkmnrt"
_STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("entli", "ent"), ("izer", "ize"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("aliti", "al"), ("alli", "al"), ("fulness", "ful"), ("ousli", "ous"),
    ("ousness", "ous"), ("iveness", "ive"), ("iviti", "ive"), ("biliti", "ble"), ("bli", "ble"),
    ("fulli", "ful"), ("lessli", "less"), ("logi", "log"), ("ogi", "og"), ("li", ""),
)
_STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""), ("ative", ""),
)
_STEP4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate",
    "iti", "ous", "ive", "ize", "ion",
)
_EXCEPTIONS1 = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
    "bias": "bias", "andes": "andes",
}
_EXCEPTIONS2 = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
_R1_PREFIXES = ("gener", "commun", "arsen")


def _is_vowel(w: str, i: int) -> bool:
    return w[i] in _VOWELS


def _region_after_vc(w: str, start: int) -> int:
    for i in range(start + 1, len(w)):
        if not _is_vowel(w, i) and _is_vowel(w, i - 1):
            return i + 1
    return len(w)


def _short_syllable_end(w: str) -> bool:
    n = len(w)
    if n == 2:
        return _is_vowel(w, 0) and not _is_vowel(w, 1)
    if n >= 3:
        return (not _is_vowel(w, n - 3) and _is_vowel(w, n - 2) and not _is_vowel(w, n - 1)
                and w[-1] not in "wxY")
    return False


def stem_english(word: str) -> str:
    """Porter2 English stemmer for one lower-case token."""
    if len(word) <= 2:
        return word
    w = word.lstrip("'")
    if w in _EXCEPTIONS1:
        return _EXCEPTIONS1[w]
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = "".join("Y" if (ch == "y" and i > 0 and w[i - 1] in _VOWELS) else ch for i, ch in enumerate(w))
    r1 = next((len(p) for p in _R1_PREFIXES if w.startswith(p)), None)
    if r1 is None:
        r1 = _region_after_vc(w, 0)
    r2 = _region_after_vc(w, r1) if r1 < len(w) else len(w)

    # step 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-3] + ("i" if len(w) > 4 else "ie")
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if any(_is_vowel(w, i) for i in range(len(w) - 2)):
            w = w[:-1]
    if w in _EXCEPTIONS2:
        return w.replace("Y", "y")
    # step 1b
    for suf in ("eedly", "eed"):
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                w = w[: -len(suf)] + "ee"
            break
    else:
        for suf in ("ingly", "edly", "ing", "ed"):
            if w.endswith(suf):
                stem = w[: -len(suf)]
                if any(_is_vowel(stem, i) for i in range(len(stem))):
                    w = stem
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(_DOUBLES):
                        w = w[:-1]
                    elif r1 >= len(w) and _short_syllable_end(w):
                        w += "e"
                break
    # step 1c
    if len(w) > 2 and w[-1] in "yY" and not _is_vowel(w, len(w) - 2):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in sorted(_STEP2, key=lambda p: -len(p[0])):
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if w.endswith("logi"):
                        w = w[:-1]
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in _LI_ENDING:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 3
    for suf, rep in sorted(_STEP3, key=lambda p: -len(p[0])):
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[: -len(suf)]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 4
    for suf in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break
    # step 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and w.endswith("ll"):
            w = w[:-1]
    return w.replace("Y", "y")


_STEMMERS = {"en": stem_english}


def has_rules(lang: str) -> bool:
    return lang in _STEMMERS


def _stem_batches(lang: str):
    fn = _STEMMERS[lang]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"term": pdf["term"], "stem": [fn(t) if t is not None else None for t in pdf["term"]]})

    return run


def stem_dictionary(terms: DataFrame, lang: str, user_dict: DataFrame | None = None) -> DataFrame:
    """``(term, stem)`` for the distinct ``term`` values of ``terms``.

    English uses the built-in rules; any other language needs ``user_dict`` with
    columns ``(lang, term, stem)``; terms missing from it stay unchanged.
    """
    distinct = terms.select("term").distinct()
    if user_dict is not None:
        d = user_dict.filter(F.col("lang") == lang).groupBy("term").agg(F.min("stem").alias("stem"))
        return distinct.join(d, "term", "left").select(
            "term", F.coalesce("stem", "term").alias("stem"))
    if not has_rules(lang):
        raise ValueError(f"no stemming rules for {lang}: give a dictionary")
    return distinct.mapInPandas(_stem_batches(lang), "term string, stem string")


def apply_stems(tokens: DataFrame, dictionary: DataFrame, term_col: str = "term") -> DataFrame:
    """Replace ``term_col`` by its stem (equi-join; AQE splits hot terms in a shuffle join)."""
    d = dictionary.withColumnRenamed("term", "__t").withColumnRenamed("stem", "__s")
    return (tokens.join(d, tokens[term_col] == d["__t"], "left")
            .withColumn(term_col, F.coalesce(F.col("__s"), F.col(term_col)))
            .drop("__t", "__s"))
