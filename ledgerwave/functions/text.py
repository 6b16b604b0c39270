"""Text cleaning as native column expressions (no Python UDF)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Words that are fused away (or blanked) inside account labels,
# in the order in which they are applied.
LABEL_STOP_WORDS = ["e", "de", "do", "dos", "da", "das", "por"]

# Characters deleted from account labels.
LABEL_PUNCTUATION = r",.\()/&"

# Characters deleted from tax ids.
TAX_ID_PUNCTUATION = "./-"

# Latin-1 signs and ligatures with a conventional ASCII spelling
# that is not simply the undecorated letter.
ASCII_SPELLING = {
    "\u00a0": " ", "¡": "!", "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=",
    "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "ª": "a", "«": "<<",
    "¬": "!", "\u00ad": "", "®": "(r)", "¯": "-", "°": "deg", "±": "+-",
    "²": "2", "³": "3", "´": "'", "µ": "u", "¶": "P", "·": "*",
    "¸": ",", "¹": "1", "º": "o", "»": ">>", "¼": " 1/4 ", "½": " 1/2 ",
    "¾": " 3/4 ", "¿": "?", "Æ": "AE", "Ð": "D", "×": "x", "Ø": "O",
    "Þ": "Th", "ß": "ss", "æ": "ae", "ð": "d", "÷": "/", "ø": "o", "þ": "th",
}

# Latin blocks whose letters are folded: Latin-1, Extended-A/B, Additional.
_LATIN = [range(0xA0, 0x250), range(0x1E00, 0x1F00)]


def _undecorated(ch: str) -> str:
    """Compatibility-decomposed form of one character, combining marks removed."""
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


@lru_cache(maxsize=None)
def _fold_tables(ascii_spelling: bool) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(from, to) for one-letter folds and pairs for the longer ones. Combining
    marks come last in ``from`` and have no counterpart: they are deleted."""
    single, longer = {}, {}
    for code in (c for block in _LATIN for c in block):
        ch = chr(code)
        folded = ASCII_SPELLING.get(ch) if ascii_spelling else None
        folded = _undecorated(ch) if folded is None else folded
        if folded == ch:
            continue
        (single if len(folded) == 1 else longer)[ch] = folded
    marks = "".join(chr(c) for c in range(0x10000) if unicodedata.combining(chr(c)))
    return "".join(single) + marks, "".join(single.values()), tuple(sorted(longer.items()))


def _fold(c: Column, ascii_spelling: bool, raw: Column | None) -> Column:
    source, target, longer = _fold_tables(ascii_spelling)
    folded = F.translate(c, source, target)
    # Few texts hold a letter with a longer spelling. For those, one loop over
    # the pairs; a chain of calls would swell the generated code for all rows.
    pairs = F.lit([[ch, text] for ch, text in longer])
    spelled = F.aggregate(pairs, folded, lambda text, p: F.replace(text, p[0], p[1]))
    has_longer = c.rlike("[" + "".join(ch for ch, _ in longer) + "]")
    # Pure ASCII text (one byte per character) needs no work at all. Testing the
    # raw text saves computing ``c`` once more.
    raw = c if raw is None else raw
    return (
        F.when(F.octet_length(raw) == F.char_length(raw), c)
        .when(has_longer, spelled)
        .otherwise(folded)
    )


def strip_accents(c: Column, raw: Column | None = None) -> Column:
    """Remove diacritics by compatibility decomposition; case is kept.

    ``raw`` may name the column ``c`` was derived from, if being ASCII carries
    over from it to ``c``.
    """
    return _fold(c, False, raw)


def transliterate(c: Column, raw: Column | None = None) -> Column:
    """Remove diacritics and spell Latin-1 signs and ligatures in ASCII."""
    return _fold(c, True, raw)


def tax_id_digits(c: Column) -> Column:
    """Tax id without its punctuation; stays text, leading zeros matter."""
    return F.translate(c, TAX_ID_PUNCTUATION, "")


def _drop_words(c: Column, words: Iterable[str], by: str) -> Column:
    # With every run of blanks down to one, a word and its blanks are a plain
    # string. One pass per word: each pass sees the result of the one before,
    # so a single alternation would not give the same text.
    c = F.regexp_replace(c, r"\s+", " ")
    for word in words:
        c = F.replace(c, F.lit(f" {word} "), F.lit(by))
    return F.translate(c, " ", "_")


def label_slug(label: Column) -> Column:
    """Account label as a key; stop words vanish with both blanks around them."""
    c = transliterate(F.lower(F.trim(label)), label)
    return _drop_words(F.translate(c, LABEL_PUNCTUATION, ""), LABEL_STOP_WORDS, "")


def label_slug_spaced(label: Column) -> Column:
    """Account label as a key; stop words leave one separator behind."""
    label = F.coalesce(label, F.lit(""))
    c = transliterate(F.lower(label), label)
    c = F.translate(c, LABEL_PUNCTUATION, "")
    return F.lower(_drop_words(c, LABEL_STOP_WORDS, " "))


def text_pattern(c: Column) -> Column:
    """Lower-case ASCII snake text."""
    c = strip_accents(F.regexp_replace(F.lower(c), r"^\s+|\s+$", ""))
    return F.regexp_replace(F.regexp_replace(c, r"[^\x00-\x7F]", ""), r"\s+", "_")
