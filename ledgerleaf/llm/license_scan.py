"""Licence findings in texts: identifier tags, notice phrases and licence expressions.

An Aho-Corasick automaton runs once over the words of a text and finds every phrase and every
identifier tag.  The expression after a tag is parsed by the shunting-yard method and evaluated.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_column

# The phrases whose places are counted, and the label of each.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices, with the label and how sure each makes it.
NOTICES = {
    "permission is hereby granted free of charge": ("mit", 0.8),
    "the mit license": ("mit", 0.8),
    "licensed under the apache license": ("apache-2", 0.8),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu general public license": ("gpl", 0.7),
    "gnu lesser general public license": ("lgpl", 0.8),
    "gnu affero general public license": ("agpl", 0.8),
    "mozilla public license": ("mpl-2", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "bsd license": ("bsd", 0.7),
    "boost software license": ("bsl-1", 0.8),
    "eclipse public license": ("epl", 0.8),
    "creative commons attribution": ("cc-by", 0.7),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.8),
    "creative commons attribution sharealike": ("cc-by-sa", 0.8),
    "released into the public domain": ("public-domain", 0.8),
    "all rights reserved": ("proprietary", 0.5),
}
TAG = "spdx license identifier"
BASE_SURE = 0.9
#: Identifiers of expressions that have a label of their own above.
ALIASES = {
    "apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "gpl-2.0": "gpl-2", "gpl-2.0-only": "gpl-2",
    "gpl-2.0-or-later": "gpl-2", "gpl-3.0": "gpl-3", "gpl-3.0-only": "gpl-3", "gpl-3.0-or-later": "gpl-3",
    "mpl-2.0": "mpl-2", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd",
}
#: Labels whose texts may be used without further duties on the user's side.
PERMISSIVE = frozenset({"mit", "apache-2", "bsd", "bsl-1", "isc", "cc0-1.0", "unlicense", "zlib", "cc-by", "public-domain"})

LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
TAG_LINE = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: the longest leading expression of the tokens in postfix order, or None."""
    out: list[str] = []
    held: list[str] = []
    operand_next = True
    for token in tokens:
        if operand_next and token == "(":
            held.append(token)
        elif operand_next and token not in PRECEDENCE and token != ")":
            out.append(token)
            operand_next = False
        elif not operand_next and token in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand_next = True
        elif not operand_next and token == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            break
    if operand_next or "(" in held:
        return None
    return out + held[::-1]


def evaluate(order: list[str]) -> tuple[str, set[str], bool]:
    """Canonical text, labels, and whether some permitted choice meets the expression.

    ``or`` is met by either side, ``and`` by both; ``with`` names an exception, which gives no
    label and takes no permission away.
    """
    stack: list[tuple[str, set[str], bool]] = []
    for token in order:
        if token not in PRECEDENCE:
            label = ALIASES.get(token, token)
            stack.append((token, {label}, label in PERMISSIVE))
            continue
        b, a = stack.pop(), stack.pop()
        if token == "with":
            stack.append((f"{a[0]} with {b[0]}", a[1], a[2]))
        else:
            permitted = (a[2] or b[2]) if token == "or" else (a[2] and b[2])
            stack.append((f"({a[0]} {token} {b[0]})", a[1] | b[1], permitted))
    return stack[0]


def parse_expression(text: str) -> tuple[str, set[str], bool] | None:
    """The licence expression at the start of ``text`` (lower case), or None if there is none.

    Brackets that are never closed make it none; what follows a whole expression is not read.
    """
    order = postfix(TOKEN.findall(text))
    return evaluate(order) if order else None


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase, label in BASE.items():
        found.add_word(f" {phrase} ", (phrase, label, BASE_SURE, True))
    for phrase, (label, sure) in NOTICES.items():
        if phrase not in BASE:
            found.add_word(f" {phrase} ", (phrase, label, sure, False))
    found.add_word(f" {TAG} ", (TAG, None, 1.0, False))
    found.make_automaton()
    return found


def scan(text: str, found) -> tuple:
    """One text's row: see :func:`license_scan`."""
    low = text.encode("utf-8", "replace").translate(LETTERS)
    split = low.split()
    line = (b" " + b" ".join(split) + b" ").decode("latin-1")
    starts, base, labels, sure, tagged = [], set(), set(), 0.0, False
    for end, (phrase, label, how_sure, counts) in found.iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        sure = max(sure, how_sure)
        if counts:
            base.add(label)
            starts.append(end - len(phrase) - 1)
    expression = permitted = None
    if tagged:
        parsed = [p for p in map(parse_expression, TAG_LINE.findall(text.lower())) if p]
        if parsed:
            expression, permitted, sure = " and ".join(p[0] for p in parsed), all(p[2] for p in parsed), 1.0
            labels.update(*(p[1] for p in parsed))
    first = line.count(" ", 0, min(starts) + 1) - 1 if starts else None
    last = line.count(" ", 0, max(starts) + 1) - 1 if starts else None
    return len(split), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), sure, expression, permitted


FIELDS = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expression", pa.string()), ("permitted", pa.bool_()),
])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with what its whole text says of licences.

    ``n_words`` words; ``n_base`` places of the base phrases, ``first_word`` and ``last_word`` the
    smallest and largest of them (else null); ``base_labels`` and ``labels`` distinct, sorted and
    comma-joined; ``score`` how sure the surest finding is, 0 without one; ``expression`` the tags'
    expressions in canonical form and ``permitted`` whether they leave a permissive choice (both
    null without a valid tag).  Null texts are empty; repeated rows and null ids give their own
    rows; other columns are not read.
    """

    @F.arrow_udf(
        "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
        "score double, expression string, permitted boolean"
    )
    def scanned(texts: pa.Array) -> pa.Array:
        found = automaton()
        rows = [scan(t.as_py(), found) for t in texts]
        columns = zip(*rows) if rows else [[] for _ in FIELDS]
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FIELDS)], fields=list(FIELDS))

    return docs.select("doc_id", scanned(text_column()).alias("found")).select("doc_id", "found.*")
