"""Title expressions: lookup key, name without year, year, substring grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsim.functions.text import strip

# Fixed pattern: a title ends in " - YYYY" (four digits, any digit script).
YEAR_SUFFIX = r"(?U)\s*-\s*\d{4}\s*$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def title_key(title: str | Column) -> Column:
    """``lower(strip(title))``; a missing title becomes the text ``nan``
    as in the source system's string conversion (X2)."""
    return F.lower(strip(F.coalesce(_c(title), F.lit("nan"))))


def normalise_query(q: str | Column) -> Column:
    """Query text as compared with title keys: stripped, lower-cased."""
    return F.lower(strip(F.coalesce(_c(q), F.lit(""))))


def name_only(key: str | Column) -> Column:
    """Key without the trailing `` - YYYY``."""
    return strip(F.regexp_replace(_c(key), YEAR_SUFFIX, ""))


def year(title: str | Column) -> Column:
    """Year at the end of a title, or null."""
    y = F.regexp_extract(strip(_c(title)), r"(?U)-\s*(\d{4})\s*$", 1)
    return F.when(y != "", y)


def display_with_year(title: str | Column) -> Column:
    """``Name (YYYY)`` when the title ends in a year, else the stripped title."""
    t = strip(_c(title))
    y = year(t)
    name = F.regexp_replace(t, YEAR_SUFFIX, "")
    return F.when(y.isNotNull(), F.concat(name, F.lit(" ("), y, F.lit(")"))).otherwise(t)


def _substr_of(s: Column, k: int):
    # one-argument lambda: transform() reads a second argument as the index
    return lambda i: F.substring(s, i, k)


# Lengths of the substrings that the lookup index holds: without a gap, as a
# number of seven digits would be looked up by five of them, which a tenth of a
# thousandth of all numbers share however many there are.
GRAM_LENGTHS = (1, 2, 3, 4, 5, 6, 7, 8)


def _grams_of_length(s: Column, k: int) -> Column:
    starts = F.when(F.length(s) >= k, F.sequence(F.lit(1), F.length(s) - k + 1)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, _substr_of(s, k))


def substring_grams(s: str | Column, lengths: Sequence[int] = GRAM_LENGTHS) -> Column:
    """Distinct substrings of ``s`` of the given lengths (the n-gram keys of
    the title lookup index).  Any substring query of length >= k contains a
    k-gram, so an equi-join on grams finds every candidate exactly."""
    return F.array_distinct(F.concat(*[_grams_of_length(_c(s), k) for k in lengths]))


def query_grams(q: str | Column, lengths: Sequence[int] = GRAM_LENGTHS) -> Column:
    """Lookup keys of a query string: its grams of the greatest indexed
    length that fits.  A title containing the query contains all of them."""
    q = _c(q)
    out = F.array().cast("array<string>")
    for k in sorted(lengths):
        out = F.when(F.length(q) >= k, F.array_distinct(_grams_of_length(q, k))).otherwise(out)
    return out
