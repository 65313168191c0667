"""Genre expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsim.functions.text import strip

# Fixed separators of a multi-valued genre string: comma, bar, slash.
GENRE_SPLIT = "[,|/]"
# Fixed pseudo-genre that means "no filter" in the menu.
ALL_GENRES = "All"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def genre_pieces(genre: str | Column) -> Column:
    """Trimmed pieces of a genre string; empty pieces are kept."""
    return F.transform(F.split(_c(genre), GENRE_SPLIT), strip)


def primary_genre(genre: str | Column) -> Column:
    """First comma-separated piece, trimmed."""
    return strip(F.element_at(F.split(_c(genre), ","), 1))


def genre_filter_key(pattern: str | Column) -> Column:
    """Normalised filter: null for "no filter" (null, empty, ``All``),
    otherwise the lower-cased regex."""
    p = _c(pattern)
    return F.when(p.isNull() | (p == "") | (p == ALL_GENRES), F.lit(None).cast("string")) \
        .otherwise(F.lower(p))


def pattern_valid(pattern: str | Column) -> Column:
    """Whether ``pattern`` compiles as a regex (null, no filter, does).  Spark
    treats the check as non-deterministic: use it in a filter or projection,
    not in a join condition."""
    p = _c(pattern)
    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), p)
    return p.isNull() | compiled.isNotNull()


def genre_matches(genre: str | Column, pattern: str | Column) -> Column:
    """Case-insensitive regex containment of ``pattern`` in the genre
    string; a missing genre never matches (F6)."""
    g = _c(genre)
    return F.coalesce(F.regexp_like(F.lower(g), _c(pattern)), F.lit(False))
