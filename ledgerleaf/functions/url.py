"""URL parts, domain restriction and listing-page addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .text import col, to_int


def host(url: Column | str) -> Column:
    """Host, or NULL for text that is no URL (bad input never fails the job)."""
    return F.try_parse_url(col(url), F.lit("HOST"))


def query_param(url: Column | str, name: str) -> Column:
    return F.try_parse_url(col(url), F.lit("QUERY"), F.lit(name))


def fragment(url: Column | str) -> Column:
    return F.try_parse_url(col(url), F.lit("REF"))


def page_param(url: Column | str, name: str = "page") -> Column:
    return to_int(query_param(url, name))


def in_domain(url: Column | str, *domains: str) -> Column:
    """Host equals one of the domains or is a subdomain of it; false for non-URLs."""
    names = "|".join(re.escape(d.lower()) for d in domains)
    return F.coalesce(F.lower(host(url)).rlike(rf"(^|\.)({names})$"), F.lit(False))


def page_url(page: Column | str, start_url: Column | str, template: Column | str) -> Column:
    """Page 1 is the start URL, page n fills the ``%d`` of ``template``."""
    p = col(page)
    start = F.lit(start_url) if isinstance(start_url, str) else start_url
    if isinstance(template, str):
        filled = F.format_string(template, p)
    else:
        filled = F.replace(template, F.lit("%d"), p.cast("string"))
    return F.when(p == 1, start).otherwise(filled)


def url_sequence(spark: SparkSession, last_page: int, start_url: str, template: str) -> DataFrame:
    """(page, url) for pages 1..last_page."""
    pages = spark.range(1, last_page + 1).select(F.col("id").cast("int").alias("page"))
    return pages.select("page", page_url("page", start_url, template).alias("url"))
