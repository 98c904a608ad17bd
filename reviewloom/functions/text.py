"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: one star per rating point.
STAR = "⭐"


def strip_all(value: Column) -> Column:
    """Remove all surrounding whitespace, Unicode included.

    A trim set is linear in the text; an anchored ``\\s+$`` pattern is quadratic in the
    length of an inner run of blanks.
    """
    return F.btrim(value, F.lit(WHITESPACE))


def is_blank(value: Column) -> Column:
    """True for null and for text of whitespace only."""
    return F.coalesce(strip_all(value) == F.lit(""), F.lit(True))


def embed_text(title: Column, body: Column) -> Column:
    """Title, space, body; null counts as empty."""
    return strip_all(
        F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))
    )


def head(value: Column, chars: int) -> Column:
    """The first ``chars`` code points, for display."""
    return F.substring(value, 1, chars)


def shorten(value: Column, width: int) -> Column:
    """A cell as a table preview shows it: at most ``width`` characters, marked if cut."""
    if width < 4:
        return head(value, width)
    cut = F.concat(F.substring(value, 1, width - 3), F.lit("..."))
    return F.when(F.length(value) > width, cut).otherwise(value)


def stars(rating: Column) -> Column:
    return F.repeat(F.lit(STAR), rating)


def content_id(*parts: Column) -> Column:
    """SHA-256 over the parts. All but the last carry a length, so no two lists collide."""
    framed = []
    for part in parts[:-1]:
        framed += [F.length(part).cast("string"), F.lit(":"), part]
    return F.sha2(F.concat(*framed, parts[-1]), 256)
