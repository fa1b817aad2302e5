"""JSON access, canonical form and content fingerprints."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .text import col, to_int


def json_text(c: Column | str, path: str) -> Column:
    """Unquoted text at ``path``; NULL when the key is missing or JSON null."""
    return F.get_json_object(col(c), path)


def json_int(c: Column | str, path: str, strict: bool = False) -> Column:
    """Integer at ``path``.  ``strict`` fails on bad text (ANSI cast); otherwise NULL."""
    return text_int(json_text(c, path), strict)


def text_int(text: Column | str, strict: bool = False) -> Column:
    return col(text).cast("int") if strict else to_int(text)


def bad_int(c: Column | str, path: str) -> Column:
    """True where a value is present but is no integer."""
    t = json_text(c, path)
    return t.isNotNull() & to_int(t).isNull()


def variant(c: Column | str) -> Column:
    """The document as a variant, NULL for text that is no JSON; strings may have any length."""
    return F.from_json(col(c), "variant", {"maxStringLen": str((1 << 31) - 1)})


def get_default(v: Column, path: str, default: str = "") -> Column:
    """Text at ``path`` of a variant: missing key gives ``default``, JSON null stays NULL."""
    missing = F.try_variant_get(v, path, "variant").isNull()
    return F.coalesce(F.try_variant_get(v, path, "string"), F.when(missing, F.lit(default)))


def variant_kind(v: Column, text: Column) -> Column:
    """Type of a variant in one word: null, object, list, str, int, float or bool.

    ``text`` is its JSON, whose first character tells all but the two kinds of number.
    """
    first = F.substring(text, 1, 1)
    return (
        F.when(first == "{", "object")
        .when(first == "[", "list")
        .when(first == '"', "str")
        .when(first == "n", "null")
        .when(first.isin("t", "f"), "bool")
        .when(text.isNotNull(), F.when(F.schema_of_variant(v) == "BIGINT", "int").otherwise("float"))
    )


def sorted_struct(c: Column, dtype: T.DataType) -> Column:
    """The struct with fields in name order at every level (NULL stays NULL)."""
    if isinstance(dtype, T.StructType):
        parts = [
            sorted_struct(c.getField(f.name), f.dataType).alias(f.name)
            for f in sorted(dtype.fields, key=lambda f: f.name)
        ]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.ArrayType) and _holds_struct(dtype.elementType):
        return F.transform(c, lambda e: sorted_struct(e, dtype.elementType))
    return c


def _holds_struct(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) or (
        isinstance(dtype, T.ArrayType) and _holds_struct(dtype.elementType))


def canonical_json(c: Column, dtype: T.StructType) -> Column:
    """Sorted-key JSON with NULL fields kept, so ``{a: null}`` and ``{}`` stay apart."""
    return F.to_json(sorted_struct(c, dtype), {"ignoreNullFields": "false"})


def canonical_variant(v: Column) -> Column:
    """Sorted-key JSON of an open-shaped document: variant objects keep keys in order."""
    return F.to_json(v)


def content_hash(c: Column, dtype: T.StructType | None = None) -> Column:
    """32 hex digits over the canonical JSON of a struct, or over plain text."""
    return F.md5(canonical_json(c, dtype) if dtype is not None else c)


@F.pandas_udf(T.StringType())
def spaced_json_md5(docs: pd.Series) -> pd.Series:
    """MD5 of ``json.dumps(doc, sort_keys=True)`` for JSON text; NULL for text that is none.

    Only for matching digests that another tool stored in that byte form; equality
    inside our own tables uses :func:`content_hash`, which stays in the JVM.
    """
    def digest(doc: str | None) -> str | None:
        try:
            return hashlib.md5(json.dumps(json.loads(doc), sort_keys=True).encode()).hexdigest()
        except (TypeError, ValueError, RecursionError):
            return None

    return docs.map(digest, na_action="ignore")
