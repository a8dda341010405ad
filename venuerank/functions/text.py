"""Column expressions for tags, snippets, profiles and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNIPPET_CHARS = 120
SNIPPETS_PER_PROFILE = 20
BLANKS = " \t\n\r\x0b\x0c"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(BLANKS))


def tags(categories: Column) -> Column:
    """Comma-separated tags as an array, trimmed, blanks removed."""
    return F.filter(F.transform(F.split(categories, ","), strip), lambda tag: tag != "")


def has_any_tag(categories: Column, wanted: list[str]) -> Column:
    """True when a whole tag, ignoring case, is in `wanted`; null categories have none."""
    lowered = F.transform(tags(categories), F.lower)
    return F.coalesce(F.arrays_overlap(lowered, F.array(*[F.lit(w) for w in wanted])), F.lit(False))


def contains_ignoring_case(value: Column, needle: str) -> Column:
    return F.lower(value).contains(needle.lower())


def snippet(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    return F.substring(text, 1, chars)


def profile_text(categories: Column, snippets: Column | None = None) -> Column:
    """Categories three times, for weight, then the snippets."""
    category = strip(F.coalesce(categories, F.lit("")))
    parts = [category, category, category]
    if snippets is not None:
        parts.append(F.array_join(snippets, " "))
    return strip(F.concat_ws(" ", *parts))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def _terms(words: Column) -> Column:
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.concat(words, bigrams)


def unigrams_and_bigrams(text: Column) -> Column:
    """Words of a text, then its pairs of neighbouring words."""
    # the lambda binds the words, which are read four times, so the text is searched once
    return F.flatten(F.transform(F.array(tokens(text)), _terms))


def single_line(value: Column) -> Column:
    """Text safe for line-based bulk loads: no backslash, and blanks for tab and line ends."""
    return F.translate(F.coalesce(value, F.lit("")), "\t\n\r\\", "   ")
