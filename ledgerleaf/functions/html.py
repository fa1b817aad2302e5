"""Entities, and native patterns for flat markup: elements that hold text and no same-named child.

Anything nested goes through :mod:`ledgerleaf.functions.markup`.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, functions as F

from .text import col

#: What numbers mean that name no character of their own, as in the standard.
REPLACED = dict(zip(
    (0x80, *range(0x82, 0x8d), 0x8e, *range(0x91, 0x9d), 0x9e, 0x9f),
    "\u20ac\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\u017d"
    "\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\u017e\u0178",
)) | {0x00: "\ufffd", 0x0d: "\r"}
#: Pieces of a text: an entity, or a run without one.
PIECE = r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]++|&"


def _tables() -> tuple[str, str]:
    """Names of entities by first letter, and of those that need no semicolon by length, as JSON."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, char in html5.items():
        by_letter.setdefault(name[0], {})[name] = char
    return json.dumps(by_letter), "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))


NAMES, OPEN_NAMES = _tables()


def character(code: Column) -> Column:
    """The character of a code point; what lies beyond them is the replacement character."""
    valid = (code < 0xD800) | code.between(0xE000, 0x10FFFF)
    unit = F.when(valid, code).otherwise(0xFFFD)
    return F.decode(F.unhex(F.lpad(F.hex(unit), 8, "0")), "UTF-32")


def _numeric(entity: Column) -> Column:
    """A decimal or hexadecimal reference; those to no character at all are empty."""
    digits = F.regexp_extract(entity, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
    base16 = F.lower(F.substring(entity, 3, 1)) == "x"
    some = F.nullif(digits, F.lit(""))
    value = F.when(base16, F.conv(some, 16, 10)).otherwise(F.conv(some, 10, 10)).cast("long")
    code = F.when(F.length(digits) > 9, 0x110000).otherwise(F.coalesce(value, F.lit(0)))
    special = F.from_json(F.lit(json.dumps({str(k): v for k, v in REPLACED.items()})), "map<string,string>")
    nothing = (code.between(1, 8) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F) | code.between(0xFDD0, 0xFDEF) | (code == 0xB)
               | ((code % 0x10000 >= 0xFFFE) & (code <= 0x10FFFF)))
    return F.coalesce(F.try_element_at(special, code.cast("string")), F.when(nothing, F.lit("")).otherwise(character(code)))


def _named(entity: Column) -> Column:
    """A named reference, or as much of one as has a name that needs no semicolon; else as it stands."""
    names = F.from_json(F.lit(NAMES), "map<string,map<string,string>>")

    def meaning(name: Column) -> Column:
        return F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)

    whole = F.substring(entity, F.lit(2), F.length(entity))
    begin = F.regexp_extract(whole, f"^(?:{OPEN_NAMES})", 0)
    rest = F.substring(whole, F.length(begin) + 1, F.length(whole))
    return F.coalesce(meaning(whole), F.when(begin != "", F.concat(meaning(begin), rest)), entity)


def unescape(c: Column | str) -> Column:
    """Text with all entities decoded once: named ones, with or without semicolon, and code points."""
    text = col(c)
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    decoded = F.transform(pieces, lambda p: F.when(~p.startswith("&") | (p == "&"), p).when(
        p.startswith("&#"), _numeric(p)).otherwise(_named(p)))
    return F.when(F.instr(text, "&") > 0, F.array_join(decoded, "")).otherwise(text)


def first_text(html: Column | str, tag: str) -> Column:
    """Text of the first ``<tag>`` without attributes; NULL when there is none or it is empty."""
    found = F.regexp_extract(col(html), f"<{tag}>([^<]*)</{tag}>", 1)
    return unescape(F.nullif(found, F.lit("")))


def link_pattern(parent: str) -> str:
    return f'<{parent}><a href="([^"]*)">([^<]*)</a></{parent}>'


def link_texts(html: Column | str, parent: str = "li") -> Column:
    """Texts of all links that are the only child of ``<parent>``, in page order."""
    found = F.regexp_extract_all(col(html), F.lit(link_pattern(parent)), F.lit(2))
    return F.transform(found, unescape)


def link_targets(html: Column | str, parent: str = "li") -> Column:
    found = F.regexp_extract_all(col(html), F.lit(link_pattern(parent)), F.lit(1))
    return F.transform(found, unescape)
