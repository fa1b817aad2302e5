"""Listing pages to entry rows.

Pages are cut by the column functions of :mod:`ledgerleaf.functions.markup`; nothing leaves the
JVM, from the markup to the record layout.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerleaf import schemas
from ledgerleaf.functions import json as J, markup as M, text as X


@dataclass(frozen=True)
class EntryRules:
    """What to take from a page.

    Selectors are ``tag.class`` steps joined by spaces, outermost first; either part of a
    step may be missing.  ``entry`` is a single step.  A text rule yields the first text directly inside a matching
    element, an attribute rule the first value present, ``parts`` every text below it.
    """

    entry: str
    texts: dict[str, str] = field(default_factory=dict)
    attrs: dict[str, tuple[str, str]] = field(default_factory=dict)
    parts: dict[str, str] = field(default_factory=dict)

    def row_type(self) -> T.StructType:
        t = T.StructType().add("html", "string")
        for name in (*self.texts, *self.attrs):
            t = t.add(name, "string")
        for name in self.parts:
            t = t.add(name, T.ArrayType(T.StringType()))
        return t


#: The selectors of the directory listing.
LISTING = EntryRules(
    entry="div.hit",
    texts={
        "name": "h2 a.hitlnk_name",
        "subtitle": "div.subline",
        "category": "div.category",
        "phone": "div.phoneblock span",
        "opening_hours": "div.hitlnk_times",
    },
    attrs={"url": ("h2 a.hitlnk_name", "href")},
    parts={"address_texts": "address"},
)


#: Columns that were built before: the expression of a rule set is long and the same for each batch.
_BUILT: dict[tuple[str, str], Column] = {}


def entries_column(html: str, rules: EntryRules) -> Column:
    """The entries of a page in document order, as an array of ``rules.row_type()``.

    A NULL page has none, and no page fails.
    """
    known = (html, repr(rules))
    if known not in _BUILT:
        _BUILT[known] = _entries(F.col(html), rules)
    return _BUILT[known]


def _entries(html: Column, rules: EntryRules) -> Column:
    def entry(block: Column) -> Column:
        return F.struct(
            M.outer(block).alias("html"),
            *[M.first_text(block, selector).alias(name) for name, selector in rules.texts.items()],
            *[M.first_attribute(block, selector, attr).alias(name) for name, (selector, attr) in rules.attrs.items()],
            *[M.texts_below(block, selector).alias(name) for name, selector in rules.parts.items()],
        )

    page = F.coalesce(html.cast("string"), F.lit(""))
    return M.let(M.tokens(page), lambda t: F.transform(M.blocks(t, rules.entry), entry))


def page_entries(pages: DataFrame, rules: EntryRules, html: str = "html") -> DataFrame:
    """One row per entry: the page's other columns, ``entry_pos`` and the rule columns."""
    names = [c for c in pages.columns if c != html]
    read = pages.select(*names, entries_column(html, rules).alias("_entries"))
    # An outer explode, as Catalyst would read every page twice to skip the empty ones before.
    split = read.select(*names, F.posexplode_outer("_entries").alias("entry_pos", "entry")).where(F.col("entry").isNotNull())
    taken = [F.col("entry").getField(f.name).alias(f.name) for f in rules.row_type().fields]
    return split.select(*names, "entry_pos", *taken)


def listing_items(pages: DataFrame, rules: EntryRules = LISTING) -> DataFrame:
    """Pages (source_id, run_id, page_number, html) to items ready for `ingest`.

    Texts are cleaned, the address is its first and last text, and the hash covers the
    whole content, page number and markup included.
    """
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.PAGES.fields if f.name != "url"]
    found = page_entries(pages.select(*columns), rules)
    parts = found.withColumn("address_texts", X.strip_all("address_texts"))
    street, city = X.first_and_last("address_texts")
    content = F.struct(
        X.clean_text("name").alias("name"),
        X.clean_text("subtitle").alias("subtitle"),
        X.clean_text("category").alias("category"),
        F.struct(street.alias("street"), city.alias("city")).alias("address"),
        X.clean_text("phone").alias("phone"),
        X.clean_text("opening_hours").alias("opening_hours"),
        F.col("page_number"),
        F.col("html"),
    )
    return items_from_struct(parts.withColumn("raw_content", content))


ITEM_COLUMNS = [
    "source_id", "run_id", "page_number", "entry_pos", "url",
    "raw_content", "raw_json", "hash", "address_error",
]


def items_from_struct(df: DataFrame, *keep: str) -> DataFrame:
    """Items whose content already has the fixed shape (address NULL counts as failed)."""
    content = F.col("raw_content")
    return df.select(
        "source_id", "run_id", "page_number", "entry_pos", "url", "raw_content",
        F.lit(None).cast("string").alias("raw_json"),
        J.content_hash(content, schemas.RAW_CONTENT).alias("hash"),
        F.when(content["address"].isNull(), ADDRESS_ERROR["null"]).alias("address_error"),
        *keep,
    )


#: What is recorded when the address is no object, by JSON type.
ADDRESS_ERROR = {
    "null": "'NoneType' object has no attribute 'get'",
    "str": "'str' object has no attribute 'get'",
    "list": "'list' object has no attribute 'get'",
    "int": "'int' object has no attribute 'get'",
    "float": "'float' object has no attribute 'get'",
    "bool": "'bool' object has no attribute 'get'",
}


def items_from_json(df: DataFrame, json_col: str = "raw_json") -> DataFrame:
    """Items whose content arrives as JSON text of open shape.

    Missing keys become ``''`` while JSON nulls stay NULL; the hash covers every key of
    the document, known or not.  Text that is no JSON gets a NULL hash and is rejected.
    """
    doc = df.withColumn("_v", J.variant(json_col))
    doc = doc.withColumns({
        "_text": J.canonical_variant(F.col("_v")),
        "_address": F.try_variant_get("_v", "$.address", "variant"),
    })
    v, whole, address = F.col("_v"), F.col("_text"), F.col("_address")
    kind = F.when(whole.startswith("{"), J.variant_kind(address, F.to_json(address))).otherwise(
        J.variant_kind(v, whole)
    )
    message = F.create_map(*[F.lit(x) for kv in ADDRESS_ERROR.items() for x in kv])
    content = F.struct(
        J.get_default(v, "$.name").alias("name"),
        J.get_default(v, "$.subtitle").alias("subtitle"),
        J.get_default(v, "$.category").alias("category"),
        F.struct(
            J.get_default(v, "$.address.street").alias("street"),
            J.get_default(v, "$.address.city").alias("city"),
        ).alias("address"),
        J.get_default(v, "$.phone").alias("phone"),
        J.get_default(v, "$.opening_hours").alias("opening_hours"),
        F.try_variant_get(v, "$.page_number", "int").alias("page_number"),
        J.get_default(v, "$.html").alias("html"),
    )
    return doc.select(
        "source_id", "run_id", "page_number", "entry_pos", "url",
        content.alias("raw_content"),
        F.col(json_col).alias("raw_json"),
        F.md5(whole).alias("hash"),
        F.try_element_at(message, kind).alias("address_error"),
    )
