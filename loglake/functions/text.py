"""Text columns: cleaning, tokens, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a metric name or tag may hold (A-Z, a-z, 0-9, and . / _ -; Java tests
# \w by table, three times faster than the ranges spelled out), whitespace as Python's str.split
# sees it, and the separators between search tokens.
DISALLOWED = r"[^\w./-]"
WHITESPACE_CHARS = (
    " \t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
TOKEN_BREAK = r"[^\p{L}\p{N}_]+"


def clean_name(c: Column) -> Column:
    """Drop every character a metric name may not hold."""
    return F.regexp_replace(c, DISALLOWED, "")


def clean_text(c: Column) -> Column:
    """Spaces to underscores, then ``clean_name``."""
    return clean_name(F.replace(c, F.lit(" "), F.lit("_")))


def squeeze_spaces(c: Column) -> Column:
    """Runs of whitespace to one space, none at the ends."""
    return F.trim(F.regexp_replace(c, WHITESPACE, " "))


def split_spaces(c: Column) -> Column:
    """Words between runs of whitespace, as ``squeeze_spaces`` and a split would give."""
    return F.split(F.btrim(c, F.lit(WHITESPACE_CHARS)), WHITESPACE)


def join_tokens(c: Column, separator: str = " ") -> Column:
    return F.array_join(c, separator)


def loghost_from_path(path: Column) -> Column:
    """Base name of a path up to its first dot."""
    return F.regexp_extract(path, r"([^/.]*)[^/]*$", 1)


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def none_to_text(c: Column) -> Column:
    """Any value as text; null stays null."""
    return c.cast("string")


def split_tokens(c: Column) -> Column:
    """Lower-case tokens; may hold empty strings at the ends. Cheap form for membership tests."""
    return F.split(F.lower(c), TOKEN_BREAK)


def tokens(c: Column) -> Column:
    """Lower-case search tokens in text order."""
    return F.array_remove(split_tokens(c), "")


def keyword_field(c: Column, limit: int | Column) -> Column:
    """Exact-match copy of a text, kept only up to ``limit`` characters."""
    return F.when(F.length(c) <= limit, c)
