"""Pages, URLs and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerleaf.functions import html as H, json as J, text as X, url as U
from ledgerleaf.operators import extract
from ledgerleaf.operators.dedup import take_until_stop
from ledgerleaf.sources.pages import parse_failed

from .base import SQL_SPACE, query

LINK = """'<li><a href="([^"]*)">([^<]*)</a></li>'"""
HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"


#: Fixed values, spelled out for the SQL alone: the entities of the pages, ampersand last.
ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&"),
)


def unescaped(sql: str) -> str:
    for entity, char in ENTITIES:
        sql = f"replace({sql}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return sql


def cleaned(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '{SQL_SPACE}+', ' ', 'g'))"


@query("page_title", f"""
    select page_id, {unescaped("nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '')")} as title
    from pages""")
def page_title(t):
    return t.pages.select("page_id", H.first_text("html", "title").alias("title"))


def links_sql(group: int, name: str) -> str:
    return f"""
    with l as (select page_id, regexp_extract_all(html, {LINK}, {group}) as l from pages),
         e as (select page_id, l, unnest(range(1, len(l) + 1)) as i from l)
    select page_id, cast(i - 1 as int) as pos, {unescaped("l[i]")} as {name} from e"""


@query("page_entries", links_sql(2, "entry"))
def page_entries(t):
    return t.pages.select("page_id", F.posexplode(H.link_texts("html")).alias("pos", "entry"))


@query("page_links", links_sql(1, "url"))
def page_links(t):
    return t.pages.select("page_id", F.posexplode(H.link_targets("html")).alias("pos", "url"))


#: The pages' navigation entries, as a rule set for the markup reader.
NAV_RULES = extract.EntryRules(
    entry="li", texts={"name": "a"}, attrs={"url": ("a", "href")}, parts={"parts": "a"}
)


@query("parsed_entries", f"""
    with l as (select page_id, regexp_extract_all(html, {LINK}, 0) as h, regexp_extract_all(html, {LINK}, 1) as u,
                      regexp_extract_all(html, {LINK}, 2) as n from pages),
         e as (select page_id, h, u, n, unnest(range(1, len(n) + 1)) as i from l)
    select page_id, cast(i - 1 as int) as entry_pos, h[i] as html, {unescaped("n[i]")} as name,
           {unescaped("u[i]")} as url, {unescaped("n[i]")} as parts from e""")
def parsed_entries(t):
    rows = extract.page_entries(t.pages.select("page_id", "html"), NAV_RULES)
    return rows.withColumn("parts", F.array_join("parts", " "))


ARTICLE_RULES = extract.EntryRules(entry="div.ad", texts={"text": "div.ad"})


@query("parsed_blocks", f"""
    select page_id, cast(0 as int) as entry_pos, regexp_extract(html, '<div class="ad">[^<]*</div>') as html,
           {unescaped("regexp_extract(html, '<div class=.ad.>([^<]*)</div>', 1)")} as text
    from pages where html like '%<div class="ad">%'""")
def parsed_blocks(t):
    return extract.page_entries(t.pages.select("page_id", "html"), ARTICLE_RULES)


FOOTER_RULES = extract.EntryRules(entry="footer", texts={"text": "footer"})


@query("page_footers", f"""
    select page_id, {unescaped("regexp_extract(html, '<footer>([^<]*)', 1)")} as text from pages where html like '%<footer>%'""")
def page_footers(t):
    return extract.page_entries(t.pages.select("page_id", "html"), FOOTER_RULES).select("page_id", "text")


@query("page_first_last", f"""
    with l as (select page_id, regexp_extract_all(html, {LINK}, 2) as raw from pages),
         a as (select page_id, list_filter(list_transform(raw, lambda x: trim({unescaped("x")})),
                                           lambda x: x <> '') as a from l)
    select page_id, case when len(a) > 0 then a[1] else '' end as street,
           case when len(a) > 1 then a[-1] else '' end as city from a""")
def page_first_last(t):
    texts = t.pages.select("page_id", X.strip_all(H.link_texts("html")).alias("a"))
    street, city = X.first_and_last("a")
    return texts.select("page_id", street.alias("street"), city.alias("city"))


@query("url_host_page", f"""
    select page_id, {HOST} as host,
           cast(try_cast(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as int) as varchar) as page
    from pages""")
def url_host_page(t):
    return t.pages.select("page_id", U.host("url").alias("host"),
                          U.page_param("url").cast("string").alias("page"))


@query("domain_filter", f"""
    select page_id, url from pages
    where {HOST} = 'example.com' or ends_with({HOST}, '.example.com')""")
def domain_filter(t):
    return t.pages.where(U.in_domain("url", "example.com")).select("page_id", "url")


@query("url_sequence", f"""
    with h as (select {HOST} as host,
                      max(try_cast(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') as int)) as last
               from pages group by 1),
         p as (select host, unnest(range(1, cast(last as bigint) + 1)) as page from h where last is not null)
    select host, cast(page as int) as page,
           case when page = 1 then concat('https://', host, '/list.html')
                else concat('https://', host, '/list-', page, '.html') end as url from p""")
def url_sequence(t):
    last = t.pages.groupBy(U.host("url").alias("host")).agg(F.max(U.page_param("url")).alias("last"))
    pages = last.where("last is not null").select("host", F.explode(F.sequence(F.lit(1), "last")).alias("page"))
    site = F.concat(F.lit("https://"), F.col("host"))
    start, template = F.concat(site, F.lit("/list.html")), F.concat(site, F.lit("/list-%d.html"))
    return pages.select("host", "page", U.page_url("page", start, template).alias("url"))


@query("failed_url_list", """
    select distinct cast(user_id as int) as page,
           concat('https://', event_type, '.example/Seite-', user_id + cast(event_type = 'error' as int), '.html')
             as url,
           event_type = 'error' as mismatch
    from events""")
def failed_url_list(t):
    in_url = F.col("user_id") + (F.col("event_type") == "error").cast("int")
    line = F.concat(F.lit("Page "), "user_id", F.lit(": https://"), "event_type",
                    F.lit(".example/Seite-"), in_url, F.lit(".html"))
    return parse_failed(t.events.select(line.alias("value")))


@query("clean_text", f"select doc_id, {cleaned('text')} as text from documents")
def clean_text(t):
    return t.documents.select("doc_id", X.clean_text("text").alias("text"))


@query("content_hash", """
    select doc_id, md5(to_json({'lang': lang, 'n_chars': n_chars, 'origin': {'doc': doc_id, 'source': source},
                                'text': text})) as hash from documents""")
def content_hash(t):
    origin = F.struct(F.col("source"), F.col("doc_id").alias("doc")).alias("origin")
    docs = t.documents.select("doc_id", F.struct("text", origin, "n_chars", "lang").alias("content"))
    return docs.select("doc_id", J.content_hash(F.col("content"), docs.schema["content"].dataType).alias("hash"))


@query("spaced_json_hash", "select event_id, md5(props) as hash from events")
def spaced_json_hash(t):
    return t.events.select("event_id", J.spaced_json_md5("props").alias("hash"))


@query("take_until_stop", """
    with s as (select user_id, ts as stop_ts, event_id as stop_id from
                 (select *, row_number() over (partition by user_id order by ts, event_id) as rn
                  from events where event_type = 'error') where rn = 1)
    select e.user_id, e.event_id, e.ts, e.event_type from events e left join s on e.user_id = s.user_id
    where s.user_id is null or (e.ts, e.event_id) <= (s.stop_ts, s.stop_id)""")
def stop_rows(t):
    rows = t.events.select("user_id", "event_id", "ts", "event_type")
    return take_until_stop(rows, "user_id", ["ts", "event_id"], F.col("event_type") == "error")
