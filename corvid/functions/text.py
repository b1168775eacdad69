"""Text scalar functions and predicates as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must match the reference semantics):
# Python's str.split() separators — the Unicode whitespace set — as one regex class.
WHITESPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
              r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+")
# Line breaks of a Hadoop text line reader.
LINE_BREAK = r"\r\n|\n|\r"
# Leading and trailing characters that are not ASCII letters.
NON_ALPHA_ENDS = r"^[^a-zA-Z]+|[^a-zA-Z]+$"
# Endings that make one word an inflection of another, in this order.
INFLECTION_ENDINGS = ["'s", "s", "es", "ing", "ed", "d"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text) -> Column:
    """Lines of a text value as a text-file reader sees them: one trailing line
    break does not start a new line and an empty text has no line."""
    t = _c(text)
    body = F.regexp_replace(t, r"(\r\n|\n|\r)\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK))


def tokens(text) -> Column:
    """``str.split()``: split on any Unicode whitespace, drop empty tokens."""
    return F.filter(F.split(_c(text), WHITESPACE), lambda t: t != "")


def to_lower_case(s) -> Column:
    return F.lower(_c(s))


def strip_non_alpha(s) -> Column:
    """Trim non-[a-zA-Z] characters at both ends; the middle is kept."""
    return F.regexp_replace(_c(s), NON_ALPHA_ENDS, "")


def _is_ascii_letter(c: Column) -> Column:
    """One character (as a string) in a..z; compared by code point."""
    return (c >= F.lit("a")) & (c <= F.lit("z"))


def normalize_word(s) -> Column:
    """Lower case, then strip: the form every count and match works on.

    Most tokens already begin and end with a letter; for those the strip is
    the identity, so the regex runs only on the rest (same result, and the
    common case stays a few generated comparisons)."""
    low = to_lower_case(s)
    clean = _is_ascii_letter(F.substring(low, 1, 1)) & _is_ascii_letter(F.substring(low, -1, 1))
    return F.when(clean, low).otherwise(strip_non_alpha(low))


def is_inflection_of(s1, s2, normalized: bool = False) -> Column:
    """After normalising both: s1 == s2, or s2 is s1 plus one of the endings.
    ``normalized=True`` skips the normalisation for inputs already normalised."""
    a, b = (_c(s1), _c(s2)) if normalized else (normalize_word(s1), normalize_word(s2))
    return (a == b) | b.isin(*[F.concat(a, F.lit(e)) for e in INFLECTION_ENDINGS])


def same_word(s1, s2, normalized: bool = False) -> Column:
    """Symmetric closure of ``is_inflection_of``."""
    if not normalized:
        s1, s2 = normalize_word(s1), normalize_word(s2)
    return is_inflection_of(s1, s2, True) | is_inflection_of(s2, s1, True)


def sentence_count(text) -> Column:
    return F.size(split_lines(text))


def word_count(text) -> Column:
    return F.size(tokens(text))
