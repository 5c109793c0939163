"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's one-argument trim removes only the space character; postings also carry tabs, newlines
# and no-break spaces. The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
HTML_TAG = r"<[^>]+>"
# The warehouse's \s: no vertical tab and no Unicode spaces.
INNER_WHITESPACE = r"[\t\n\f\r ]+"


def utrim(column: Column) -> Column:
    """Trim white space of every kind, not only blanks; looks at the edges, not at the whole text."""
    return F.btrim(column, F.lit(WHITESPACE))


def blank_to_null(column: Column) -> Column:
    return F.nullif(utrim(column), F.lit(""))


def tidy_upper(column: Column) -> Column:
    return F.upper(utrim(column))


def clean_html(column: Column) -> Column:
    """Tags to blanks, white-space runs to one blank, trimmed; NULL becomes the empty string."""
    text = F.regexp_replace(F.coalesce(column, F.lit("")), HTML_TAG, " ")
    return utrim(F.regexp_replace(text, INNER_WHITESPACE, " "))


def slug(column: Column) -> Column:
    """File label of a city: lower case, blanks to hyphens."""
    return F.replace(F.lower(column), F.lit(" "), F.lit("-"))


def snippet(column: Column, length: int = 240) -> Column:
    """One-line preview for sample exports and failure reports."""
    one_line = F.replace(F.coalesce(column, F.lit("")), F.lit("\n"), F.lit(" "))
    return F.substring(utrim(one_line), 1, length)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, however often the body's own lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dedupe_ignoring_case(words: Column) -> Column:
    """Trim, drop empties and keep the first spelling of every word, in order.

    Two sorts instead of a search per word: by key and place, where the first of each key is kept,
    then by place.
    """
    spellings = F.filter(F.transform(words, utrim), lambda w: w != "")
    keyed = F.transform(spellings, lambda w, i: F.struct(F.lower(w).alias("key"), i.alias("place"), w.alias("word")))
    firsts = _bind(
        F.array_sort(keyed),
        lambda found: F.filter(
            found, lambda x, i: ~F.coalesce(F.get(found, i - 1)["key"] == x["key"], F.lit(False))
        ),
    )
    by_place = F.array_sort(F.transform(firsts, lambda x: F.struct(x["place"].alias("place"), x["word"].alias("word"))))
    return F.transform(by_place, lambda x: x["word"])
