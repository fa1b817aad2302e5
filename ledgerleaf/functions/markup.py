"""Nested markup by column functions.

A page is cut into tokens: comments, tags, text-only elements and texts, which together are the
page.  One pass over them keeps the open elements, nearest first, and notes where those that match
a selector begin and end, so an element is a slice of the tokens and its outer markup their
concatenation.  A page of any kind is read: end tags without a start are passed over, elements
without an end last until what holds them ends.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from .html import unescape

#: Fixed values of the markup rules: elements without content, elements a sibling of the
#: same name closes, containers that a stray inline end tag cannot close, and elements
#: whose content is text only.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
SELF_CLOSING = ("p", "li", "td", "th", "tr", "option", "dt", "dd")
CONTAINERS = ("div", "table", "td", "th", "tr", "ul", "ol", "section", "article", "main", "body", "html")
RAW = ("script", "style", "textarea", "title")

#: Loops are possessive, over single characters or bounded, so that no page overflows the stack.
#: A tag ends outside quotes, or at its first ``>`` if it has very many attributes.
QUOTED = r"""</?[a-z][^\s/>]*+(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+){0,200}+(?:>|\z)"""
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)|<[!?][^>]*+(?:>|\z)"
    rf"|<({'|'.join(RAW)})\b[^>]*+>.*?(?:</\1\b[^>]*+>?|\z)"
    rf"|{QUOTED}|</?[a-z][^>]*+(?:>|\z)"
    r"|.+?(?=</?[a-z]|<[!?]|\z)"
)
TAG_NAME = r"(?i)^</?([a-z][^\s/>]*+)"
RAW_TEXT = r"(?is)^<[^>]*+>(.*?)(?:</[a-z]+\b[^<>]*+>?)?$"
ATTRIBUTE = r"""[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']*+))?+"""

STACK = "array<struct<name:string,start:int,hit:boolean,holds:boolean>>"
SPANS = "array<struct<start:int,inner:int,last:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def tokens(html: Column) -> Column:
    """A page as an array of ``markup, name, closes, classes, text`` and the rules of its name, read once for all selectors.

    ``text`` is the decoded text of a text or text-only element, NULL for other tokens; ``classes``
    are those of a start tag.
    """

    def token(markup: Column) -> Column:
        is_tag = F.rlike(markup, F.lit(r"(?i)^</?[a-z]"))
        name = F.when(is_tag, tag_name(markup)).otherwise(F.lit(""))
        content = F.regexp_extract(markup, RAW_TEXT, 1)

        def fields(n: Column) -> Column:
            shown = F.when((n == "") & ~F.rlike(markup, F.lit("^<[!?]")), markup).when(n.isin(*RAW), content)
            classes = F.when(is_tag, F.split(attribute(markup, "class"), r"\s+"))
            return F.struct(
                markup.alias("markup"), n.alias("name"), markup.startswith("</").alias("closes"),
                F.coalesce(classes, F.array().cast("array<string>")).alias("classes"),
                n.isin(*VOID, *RAW).alias("alone"), n.isin(*CONTAINERS).alias("holds"), n.isin(*SELF_CLOSING).alias("ends_sibling"),
                F.when(n.isin("script", "style"), shown).otherwise(let(shown, unescape)).alias("text"),
            )

        return let(name, fields)

    return F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), token)


def tag_name(token: Column) -> Column:
    """Lower-cased name of a tag or text-only element; empty for texts and comments."""
    return F.lower(F.regexp_extract(token, TAG_NAME, 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of a start tag's attribute, decoded; the first of repeated ones, NULL for none."""
    inside = F.regexp_replace(F.regexp_replace(tag, r"(?i)^<[a-z][^\s/>]*+", ""), r"/?>$", "")
    found = F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(0))
    mine = F.get(F.filter(found, lambda a: F.lower(F.regexp_extract(a, r"^[^\s=]++", 0)) == name.lower()), 0)

    bare = let(F.regexp_replace(mine, r"(?s)^[^\s=]++(\s*+=\s*+)?", ""), lambda text: F.when(
        F.rlike(text, F.lit("^[\"']")), F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text))
    return F.when(F.instr(F.lower(tag), name.lower()) > 0, let(bare, unescape))


def _step(selector: str) -> tuple[str, list[str]]:
    tag, *classes = selector.split(".")
    return tag.lower(), classes


def _matches(selector: str, token: Column) -> Column:
    """Whether a start tag satisfies one ``tag.class`` step."""
    tag, classes = _step(selector)
    hit = (token["name"] == tag) if tag else (token["name"] != "")
    return reduce(lambda a, c: a & F.array_contains(token["classes"], c), classes, hit & ~token["closes"])


def scan(found: Column, selector: str) -> Column:
    """``spans, text``: matching elements of a token array by position, and their first direct text.

    A span has the places of an element's start tag, of the last token inside it and of its last
    token, counted from 1; spans are in document order, nested ones included.  The pass costs a
    step per token and, for each start and end tag, the depth of the open elements.
    """
    # the names of the open elements lie beside them, for a plain search
    def state(at: Column, names: Column, stack: Column, spans: Column, text: Column) -> Column:
        return F.struct(at.alias("at"), names.alias("names"), stack.alias("stack"), spans.alias("spans"), text.alias("text"))

    def ended(elements: Column, inner: Column, last: Callable[[Column], Column]) -> Column:
        return F.transform(F.filter(elements, lambda e: e["hit"]), lambda e: F.struct(
            e["start"].alias("start"), inner.alias("inner"), last(e).alias("last")))

    def merge(acc: Column, kind: Column) -> Column:
        at, stack, spans, text, name = acc["at"] + 1, acc["stack"], acc["spans"], acc["text"], kind["name"]
        names, deep = acc["names"], F.size(acc["names"])
        top, hit = F.get(stack, 0), _matches(selector, kind)
        first = F.when(text.isNull() & F.coalesce(top["hit"], F.lit(False)), at).otherwise(text)

        def close(n: Column) -> Column:
            # a container's end tag ends all within it; another stops at the nearest container
            crossed = F.exists(F.slice(stack, 1, n - 1), lambda e: e["holds"])
            ends = F.when((n > 0) & (kind["holds"] | ~crossed), n).otherwise(0)
            return let(ends, lambda k: state(
                at, F.slice(names, k + 1, deep), F.slice(stack, k + 1, deep),
                F.concat(spans, ended(F.slice(stack, 1, k), at - 1, lambda e: F.when(e["name"] == name, at).otherwise(at - 1))), text))

        alone = F.when(hit, F.concat(spans, F.array(F.struct(at.alias("start"), at.alias("inner"), at.alias("last"))))).otherwise(spans)
        inside = F.when(kind["text"].isNull(), text).when(text.isNull() & hit, at).otherwise(first)
        siblings = F.when(kind["ends_sibling"] & F.coalesce(top["name"] == name, F.lit(False)), 1).otherwise(0)
        pushed = F.struct(name.alias("name"), at.alias("start"), hit.alias("hit"), kind["holds"].alias("holds"))
        return (
            F.when(name == "", state(at, names, stack, spans, F.when(kind["text"].isNotNull(), first).otherwise(text)))
            .when(kind["closes"], let(F.array_position(names, name).cast("int"), close))
            .when(kind["alone"], state(at, names, stack, alone, inside))
            .otherwise(let(siblings, lambda k: state(
                at, F.array_prepend(F.slice(names, k + 1, deep), name), F.array_prepend(F.slice(stack, k + 1, deep), pushed),
                F.concat(spans, ended(F.slice(stack, 1, k), at - 1, lambda e: at - 1)), text)))
        )

    def finish(acc: Column) -> Column:
        rest = ended(acc["stack"], acc["at"], lambda e: acc["at"])
        return F.struct(F.array_sort(F.concat(acc["spans"], rest)).alias("spans"), acc["text"].alias("text"))

    zero = state(F.lit(0), F.array().cast("array<string>"), F.array().cast(STACK), F.array().cast(SPANS), F.lit(None).cast("int"))
    none = F.struct(F.array().cast(SPANS).alias("spans"), F.lit(None).cast("int").alias("text"))
    return F.when(F.exists(found, lambda t: _matches(selector, t)), F.aggregate(found, zero, merge, finish)).otherwise(none)


def blocks(found: Column, selector: str) -> Column:
    """Token arrays of the elements that match one step, nested ones included."""
    return F.transform(scan(found, selector)["spans"], lambda s: F.slice(found, s["start"], s["last"] - s["start"] + 1))


def _insides(found: Column, selector: str, outermost: bool = False) -> Column:
    """Token arrays of what the matching elements hold."""
    spans = scan(found, selector)["spans"]
    if outermost:
        none = F.struct(F.lit(0).alias("end"), F.array().cast(SPANS).alias("kept"))
        spans = F.aggregate(spans, none, lambda acc, s: F.when(s["start"] > acc["end"], F.struct(
            s["last"].alias("end"), F.array_append(acc["kept"], s).alias("kept"))).otherwise(acc), lambda acc: acc["kept"])
    # a text-only element holds its content, which is one token with it
    return F.transform(spans, lambda s: F.when(s["inner"] == s["start"], F.slice(found, s["start"], 1)).otherwise(
        F.slice(found, s["start"] + 1, s["inner"] - s["start"])))


def _first(found: Column, steps: list[str], last: Callable[[Column, str], Column]) -> Column:
    """``last`` of the first element, in document order, that gives one."""
    if len(steps) == 1:
        return last(found, steps[0])
    tried = F.transform(_insides(found, steps[0]), lambda t: _first(t, steps[1:], last))
    return F.get(F.filter(tried, lambda x: x.isNotNull()), 0)


def first_text(found: Column, selector: str) -> Column:
    """The first text directly inside an element that matches; steps are joined by spaces."""
    return _first(found, selector.split(), lambda t, step: let(
        scan(t, step)["text"], lambda at: F.when(at.isNotNull(), F.get(t, at - 1)["text"])))


def first_attribute(found: Column, selector: str, name: str) -> Column:
    """The first value of an attribute on an element that matches."""
    return _first(found, selector.split(), lambda t, step: F.get(F.filter(F.transform(
        scan(t, step)["spans"], lambda s: attribute(F.get(t, s["start"] - 1)["markup"], name)), lambda x: x.isNotNull()), 0))


def texts_below(found: Column, selector: str) -> Column:
    """Every text below the matching elements, not counting the first token's element itself."""
    def within(each: Column, step: str) -> Column:
        return F.flatten(F.transform(each, lambda t: _insides(t, step, outermost=True)))

    inside = reduce(within, selector.split(), F.array(F.slice(found, 2, F.size(found))))
    return F.filter(F.transform(F.flatten(inside), lambda t: t["text"]), lambda x: x.isNotNull())


def outer(block: Column) -> Column:
    """The markup of tokens."""
    return F.array_join(F.transform(block, lambda t: t["markup"]), "")
