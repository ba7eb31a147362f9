"""Text columns: stripping, ASCII folding, substring matching, display defaults."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern import fixed_values as V

LETTER_BREAK = "[^A-Za-z]+"


def strip(col: Column) -> Column:
    """Remove Unicode white space from both ends (a plain ``trim`` removes blanks only)."""
    return F.btrim(col, F.lit(V.WHITESPACE))


def fold(col: Column) -> Column:
    """Lower-case A-Z only, leaving accented letters alone."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def match_pattern(text: Column) -> Column:
    """LIKE pattern for a substring search; ``%`` and ``_`` stay wildcards, a backslash is ordinary."""
    return F.concat(F.lit("%"), F.replace(fold(text), F.lit("\\"), F.lit("\\\\")), F.lit("%"))


def topic_matches(col: Column, text: str) -> Column:
    """True where ``text`` occurs in ``col``, ignoring ASCII case. An empty text matches all."""
    folded = "".join(c.lower() if c in string.ascii_uppercase else c for c in text)
    return fold(col).like("%" + folded.replace("\\", "\\\\") + "%")


def or_default(col: Column, default: str) -> Column:
    """``default`` for a missing or empty value."""
    return F.coalesce(F.nullif(col.cast("string"), F.lit("")), F.lit(default))


def truncated(col: Column, chars: int = V.ERROR_CHARS) -> Column:
    return F.left(col, F.lit(chars))


def forward_slashes(col: Column) -> Column:
    return F.translate(col, "\\", "/")


def contains_any(col: Column, terms: Sequence[str]) -> Column:
    """OR of plain substring tests."""
    hit = F.lit(False)
    for term in terms:
        hit = hit | col.contains(term)
    return hit


def is_rate_limited(message: Column, markers: Sequence[str] = V.RATE_LIMIT_MARKERS) -> Column:
    """Whether an error message asks for a retry."""
    return contains_any(F.lower(message), markers)


def _word_pattern(terms: Sequence[str]) -> str:
    """Any of the terms as a whole run of a-z. A plain word boundary would treat accents differently
    from one regex dialect to the next."""
    return "[^a-z](" + "|".join(re.escape(t) for t in terms) + ")(?=[^a-z])"


def scannable(col: Column) -> Column:
    """Lower-case text with a blank at both ends, which the word tests below expect."""
    return F.concat(F.lit(" "), F.lower(col), F.lit(" "))


def has_word(scanned: Column, terms: Sequence[str]) -> Column:
    """Whether any of the lower-case terms is a word of the text; one scan, no word list is built."""
    return scanned.rlike(_word_pattern(terms)) if terms else F.lit(False)


def words_found(scanned: Column, terms: Sequence[str]) -> Column:
    """The terms that are words of the text, each once."""
    return F.array_distinct(F.regexp_extract_all(scanned, F.lit(_word_pattern(terms)), F.lit(1)))
