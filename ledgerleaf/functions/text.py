"""Whitespace, blank and length handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

#: The characters ``str.split()`` and ``str.strip()`` treat as whitespace in
#: Python.  As a pattern: Java's Unicode ``\s`` plus U+001C..U+001F.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """NULL becomes ``''``; whitespace runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), SPACE_RUN, " "))


def strip(c: Column | str) -> Column:
    """Trim both ends, keep inner whitespace."""
    return F.btrim(col(c), F.lit(SPACES))


def strip_all(texts: Column | str) -> Column:
    """Trim every element and drop those that are then empty; order is kept."""
    return F.filter(F.transform(col(texts), strip), lambda x: x != "")


def first_and_last(texts: Column | str) -> tuple[Column, Column]:
    """(first or ``''``, last when there is more than one else ``''``)."""
    a = col(texts)
    first = F.when(F.size(a) > 0, F.element_at(a, 1)).otherwise("")
    last = F.when(F.size(a) > 1, F.element_at(a, -1)).otherwise("")
    return first, last


def to_int(c: Column | str) -> Column:
    """Integer value of text, NULL for anything else.

    The pattern keeps bad text away from the cast, which raises and catches an exception
    per bad value; text and pattern are evaluated once.
    """
    return F.regexp_substr(col(c), F.lit(r"^\s*[+-]?\d+\s*$")).try_cast("int")


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and all-whitespace text; never NULL."""
    return F.coalesce(F.ltrim(col(c), F.lit(SPACES)), F.lit("")) == ""


def too_long(c: Column | str, limit: int) -> Column:
    """True when the text has more than ``limit`` characters; never NULL."""
    return F.coalesce(F.char_length(col(c)), F.lit(0)) > limit


def filled_share(fields: Iterable[Column | str]) -> Column:
    """Number of non-blank fields, as an integer."""
    total = F.lit(0)
    for f in fields:
        total = total + F.when(is_blank(f), 0).otherwise(1)
    return total


def standard_phone(c: Column | str) -> Column:
    """Digits with an optional leading ``+``; NULL becomes ``''``."""
    t = clean_text(c)
    digits = F.regexp_replace(t, "[^0-9]", "")
    return F.when(t.startswith("+") & (digits != ""), F.concat(F.lit("+"), digits)).otherwise(digits)


def match_key(name: Column | str, city: Column | str) -> Column:
    """Key that brings together records of one real-world listing; NULL for a blank name."""
    n = F.lower(clean_text(name))
    return F.when(n != "", F.concat(n, F.lit("|"), F.lower(clean_text(city))))
