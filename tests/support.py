"""Builders and readers that test modules import."""

from __future__ import annotations

from pyspark.sql import DataFrame


def content(name="A", street="S", city="C", page=1, html="<div/>", category="", phone="1", hours="",
            subtitle=""):
    """A raw_content value."""
    return (name, subtitle, category, (street, city), phone, hours, page, html)


def listing(*entries, extra: str = "") -> str:
    """A directory page with the given (name, street, city) entries."""
    hits = "".join(
        f'<div class="hit clearfix"><h2><a class="hitlnk_name" href="/d/{n}">{n}</a></h2>'
        f'<div class="subline">sub\n {n}</div><div class="category">Cat</div>'
        f"<address>\n {s}<br> {c} </address>"
        f'<div class="phoneblock"><span>0{i} 12</span></div><div class="hitlnk_times">Mo&#8211;Fr</div></div>'
        for i, (n, s, c) in enumerate(entries)
    )
    return f"<html><body><div class='list'>{hits}{extra}</div></body></html>"


def collected(df: DataFrame, *order: str) -> list[tuple]:
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]
