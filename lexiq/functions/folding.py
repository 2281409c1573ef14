"""Accent folding (T4) as a column expression.

A character folds to its ASCII spelling. The table is made by rules over the Latin blocks: the
Unicode compatibility decomposition without combining marks, each of whose characters is folded in turn
(so a letter with a stroke and an accent folds as the letter with the stroke); else the letter that the
character's Unicode name says it is a variant of; else a fixed value of the lists below. What has no
ASCII spelling by these stays as it is.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters whose name is not that of the ASCII letters they are spelled with.
NAMED_LETTERS = {
    "ß": "ss", "ẞ": "SS", "þ": "th", "Þ": "TH", "ð": "d", "Ð": "D", "ŋ": "n", "Ŋ": "N", "ĸ": "q", "ſ": "s",
    "ə": "a", "Ə": "A", "ǝ": "e", "Ǝ": "E", "ɑ": "a", "Ɑ": "A", "ƕ": "hv", "Ƕ": "HV", "ƿ": "w", "Ƿ": "W",
    "ȝ": "z", "Ȝ": "Z", "ı": "i", "ȷ": "j", "ɩ": "i", "Ɩ": "I", "Ʀ": "R", "ʀ": "R", "ȣ": "ou", "Ȣ": "OU",
    "ŉ": "n",
}
# Marks that n-grams of whole strings may hold.
MARKS = {
    "«": '"', "»": '"', "“": '"', "”": '"', "„": '"', "″": '"', "‶": '"',
    "‘": "'", "’": "'", "‚": "'", "‛": "'", "′": "'", "‵": "'", "‹": "'", "›": "'",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "⁻": "-", "₋": "-",
    "⁄": "/", "‸": "^", "⁎": "*", "⁏": ";", "⁒": "%", "⁓": "~",
}
# Names of two letters that are spelled so.
DIGRAPHS = frozenset("AA AE AO AU AV AY DZ FF FI FL HV IJ LJ LL NJ OE OO QP DB TZ VY LS LZ TC TS ST UE".split())
_NAME = re.compile(r"LATIN (SMALL|CAPITAL) (?:LETTER|LIGATURE) (?:SMALL CAPITAL )?(.+?)(?: WITH .+| DIGRAPH.*)?$")
_VARIANTS = re.compile(r"^(?:DOTLESS |TURNED |REVERSED |OPEN |CLOSED |INSULAR |LONG |SIDEWAYS |BARRED |AFRICAN |TAILLESS "
                       r"|MIDDLE-WELSH |TOP HALF |BOTTOM HALF )+")
# Unicode blocks: Latin-1 and its extensions A, B and additional, IPA, phonetic, sub- and superscripts, enclosed
# letters and digits, extensions C and D, ligatures, fullwidth forms.
_FOLD_RANGES = ((0x00AA, 0x024F), (0x0250, 0x02AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2070, 0x209C),
                (0x2184, 0x2184), (0x2460, 0x24FF), (0x2776, 0x2793), (0x2C60, 0x2C7F), (0xA722, 0xA7CA), (0xA7F2, 0xA7FF),
                (0xAB30, 0xAB6B), (0xFB00, 0xFB06), (0xFF01, 0xFF5E))


def spelling(ch: str) -> str | None:
    """The ASCII spelling of a character, or None."""
    if ch.isascii():
        return ch
    if ch in NAMED_LETTERS or ch in MARKS:
        return NAMED_LETTERS.get(ch) or MARKS[ch]
    name = unicodedata.name(ch, "")
    if "CIRCLED" in name and unicodedata.numeric(ch, None) is not None:
        return str(int(unicodedata.numeric(ch)))
    # a modifier apostrophe or a middle dot in a decomposition counts as a mark
    parts = [c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c) and c not in "ʼ·"]
    if parts != [ch]:
        folded = [spelling(c) for c in parts]
        return "".join(folded) if folded and all(x is not None for x in folded) else None
    found = _NAME.match(name)
    if not found:
        return None
    letters = _VARIANTS.sub("", found[2])
    if not (len(letters) == 1 and "A" <= letters <= "Z") and letters not in DIGRAPHS:
        return None
    return letters if found[1] == "CAPITAL" else letters.lower()


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Characters that fold to one, what these fold to, and (character, spelling) of those that fold to more."""
    chars = dict.fromkeys(chain((chr(c) for lo, hi in _FOLD_RANGES for c in range(lo, hi + 1)), NAMED_LETTERS, MARKS))
    known = {c: s for c in chars if (s := spelling(c)) is not None and s != c}
    one = {c: s for c, s in known.items() if len(s) == 1}
    return "".join(one), "".join(one.values()), tuple((c, s) for c, s in known.items() if len(s) > 1)


def fold_map() -> dict[int, str]:
    """What the characters fold to, by code point: ``fold_col`` for ``str.translate``."""
    src, dst, longer = fold_tables()
    spelled = dict(longer)
    return {ord(c): spelled.get(d, d) for c, d in zip(src, dst)} | {ord(c): s for c, s in longer}


def _ascii(c: Column) -> Column:
    return F.char_length(c) == F.octet_length(c)


def _spelled(single: Column) -> Column:
    """A text after its one-character foldings with the longer spellings; the pattern costs a test per character and
    spelling, so a text that is ASCII by now does without."""
    longer = fold_tables()[2]
    table = F.create_map(*[F.lit(x) for pair in longer for x in pair])
    spelled = F.array_join(F.transform(F.split(single, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    return F.when(~_ascii(single) & single.rlike("[" + "".join(ch for ch, _ in longer) + "]"), spelled).otherwise(single)


def fold_col(c: Column) -> Column:
    """The folded text. Only a text that holds a character with a longer spelling is taken apart."""
    src, dst, _ = fold_tables()
    return F.transform(F.array(F.translate(c, src, dst)), _spelled)[0]


def fold_lines(c: Column) -> Column:
    """The folded lines of a text, whose characters are translated at once."""
    src, dst, _ = fold_tables()
    return F.transform(F.array(F.translate(c, src, dst)), lambda single: F.when(_ascii(single), F.split(single, "\n")).otherwise(
        F.transform(F.split(single, "\n"), _spelled)))[0]
