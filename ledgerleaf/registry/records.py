"""Standard formats, validation, enrichment and master records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerleaf.functions import html as H, text as X, url as U
from ledgerleaf.operators import attempts, consolidate, enrich, validate

from .base import query
from .extraction import HOST, cleaned, unescaped


def host_records(t) -> DataFrame:
    """Pages as cleaned records: title, host, link texts, query values."""
    blank = F.lit(None).cast("string")
    street, city = X.first_and_last(H.link_texts("html"))
    return t.pages.select(
        F.col("page_id").alias("id"),
        H.first_text("html", "title").alias("name"),
        U.host("url").alias("category"),
        F.struct(street.alias("street"), city.alias("city")).alias("address"),
        F.struct(F.col("url").alias("phone"), blank.alias("hours")).alias("contact"),
    )


FIRST_LINK = """regexp_extract(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)"""


@query("standardize", f"""
    select page_id as id, {cleaned(unescaped("coalesce(regexp_extract(html, '<title>([^<]*)</title>', 1), '')"))}
             as name,
           {HOST} as category, {cleaned(unescaped(FIRST_LINK))} as street,
           regexp_replace(url, '[^0-9]', '', 'g') as phone, '' as hours
    from pages""")
def standardize(t):
    return validate.standardize(host_records(t)).select(
        "id", "name", "category", "address.street", "contact.phone", "contact.hours"
    )


def query_records(t) -> DataFrame:
    return t.pages.select(
        "page_id",
        F.nullif(F.regexp_extract("url", "[?]([^#]*)", 1), F.lit("")).alias("name"),
        U.query_param("url", "page").alias("street"),
        U.query_param("url", "ref").alias("city"),
        H.first_text("html", "title").alias("title"),
    )


QUERY_SQL = """
    with r as (select page_id, regexp_extract(url, '[?]([^#]*)', 1) as name,
                      regexp_extract(url, '[?&]page=([^&#]*)', 1) as street,
                      regexp_extract(url, '[?&]ref=([^&#]*)', 1) as city,
                      regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages)"""
QUERY_RULES = validate.ValidationRules(fatal=("name",), required=("street", "city"), limits={"title": 60})


@query("validate", QUERY_SQL + """
    select page_id, case when trim(name) = '' then 'invalid'
                         when trim(street) = '' or trim(city) = '' then 'partial' else 'valid' end
                      as validation_status from r""")
def validated(t):
    return validate.validate(query_records(t), QUERY_RULES).select("page_id", "validation_status")


@query("validation_errors", QUERY_SQL + f"""
    select page_id, 'name' as field, 'missing' as code from r where trim(name) = ''
    union all select page_id, 'street', 'missing' from r where trim(street) = ''
    union all select page_id, 'city', 'missing' from r where trim(city) = ''
    union all select page_id, 'title', 'too_long' from r where length({unescaped('title')}) > 60""")
def validation_errors(t):
    return validate.error_rows(query_records(t), "page_id", QUERY_RULES)


@query("source_rules", """
    select page_id, host, case host when 'blog.ththan.example.net' then upper(path)
                                    when 'spam-farm.example.org' then '' else path end as path
    from (select page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) as host,
                 regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) as path from pages)""")
def source_rules(t):
    rows = t.pages.select("page_id", U.host("url").alias("host"),
                          F.try_parse_url("url", F.lit("PATH")).alias("path"))
    stored = [("blog.ththan.example.net", '{"rules": {"path": [{"op": "upper"}]}}'),
              ("spam-farm.example.org", '{"rules": {"path": [{"op": "constant", "value": ""}]}}')]
    sources = rows.sparkSession.createDataFrame(stored, "name string, config string")
    return validate.apply_stored_rules(rows, sources, "host", "name")


def places(t) -> DataFrame:
    """All nations as a reference table; customers ask for twice their nation, which not all hold."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return nations.select("n_nationkey", "n_name", "r_name")


PLACES = "(select n_nationkey, n_name, r_name from nation join region on n_regionkey = r_regionkey)"


@query("enrich_geo", f"""
    select c_custkey, n_name, r_name, case when n_nationkey is not null then cast(1.0 as double) end
             as confidence_score
    from customer left join {PLACES} on 2 * c_nationkey = n_nationkey""")
def enrich_geo(t):
    people = t.customer.select("c_custkey", (2 * F.col("c_nationkey")).alias("asked"))
    return enrich.look_up(people, places(t), "asked", "n_nationkey", ["n_name", "r_name"]).drop("asked")


@query("enriched_rows", f"""
    select c_custkey as cleaned_data_id, 'geolocation' as enrichment_type,
           cast(to_json({{'n_name': n_name, 'r_name': r_name}}) as varchar) as data, 'nation table' as source,
           cast(1.0 as double) as confidence_score
    from customer join {PLACES} on 2 * c_nationkey = n_nationkey""")
def enriched_rows(t):
    people = t.customer.select(F.col("c_custkey").alias("id"), "c_nationkey")
    rows = enrich.enriched_rows(people, places(t), 2 * F.col("c_nationkey"), "n_nationkey", ["n_name", "r_name"],
                                "geolocation", "nation table")
    return rows.drop("enriched_at")


@query("enrich_details", """
    select d.doc_id, lang, cast(quality as varchar) as quality, cast(toxic as varchar) as toxic, case when l.doc_id is not null then cast(1.0 as double) end
             as confidence_score
    from documents d left join labels l on d.doc_id = l.doc_id""")
def enrich_details(t):
    docs = t.documents.select("doc_id", "lang")
    labels = t.labels.select("doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string"))
    return enrich.look_up(docs, labels, "doc_id", "doc_id", ["quality", "toxic"])


def fingerprints(t) -> DataFrame:
    key = F.when(~X.is_blank("text"), F.md5("text")).alias("key")
    return t.documents.select("doc_id", "source", "lang", key)


@query("cross_reference", """
    select md5(text) as key, count(*) as records, count(distinct source) as sources from documents
    where trim(text) <> '' group by 1 having count(distinct source) >= 2""")
def cross_reference(t):
    return enrich.cross_reference(fingerprints(t), "key", "source")


@query("master_merge", """
    select md5(text) as key, min(doc_id) as first_id, max(doc_id) as last_id, count(*) as records,
           count(distinct source) as sources from documents where trim(text) <> '' group by 1""")
def master_merge(t):
    return consolidate.merge(fingerprints(t), "key", "doc_id", "source")


@query("master_resolve", """
    select key, doc_id, source, lang, cast(quality as varchar) as quality from
      (select md5(text) as key, d.doc_id, source, lang, quality,
              row_number() over (partition by md5(text) order by quality desc nulls last, d.doc_id) as rn
       from documents d left join labels l on d.doc_id = l.doc_id where trim(text) <> '')
    where rn = 1""")
def master_resolve(t):
    rows = fingerprints(t).join(t.labels, "doc_id", "left")
    order = [F.col("quality").isNull(), -F.col("quality"), F.col("doc_id")]
    best = consolidate.resolve(rows, "key", order, ["doc_id", "source", "lang", "quality"])
    return best.withColumn("quality", F.col("quality").cast("string"))


@query("master_lineage", """
    select md5(text) as key, array_to_string(list_sort(list(distinct source)), ',') as sources
    from documents where trim(text) <> '' group by 1""")
def master_lineage(t):
    lists = consolidate.lineage(fingerprints(t), "key", "source")
    return lists.select("key", F.array_join("sources", ",").alias("sources"))


# Parts are the cleaned records (name, brand as city, size as source), the discounts of
# their order lines the confidence scores.
@query("master_records", """
    with c as (select l_partkey, max(l_discount) as conf from lineitem group by l_partkey),
         p as (select p.*, conf, lower(p_name) || '|' || lower(p_brand) as key,
                      cast(floor(p_retailprice) as bigint) as done
               from part p left join c on l_partkey = p_partkey)
    select md5(key) as external_id,
           first(p_name order by conf desc nulls last, done desc, p_partkey) as name,
           first(p_type order by conf desc nulls last, done desc, p_partkey) as type,
           first(p_brand order by conf desc nulls last, done desc, p_partkey) as city,
           cast(to_json({'id': first(p_partkey order by conf desc nulls last, done desc, p_partkey),
                    'raw_data_id': first(p_partkey order by conf desc nulls last, done desc, p_partkey),
                    'source_id': first(cast(p_size as bigint) order by conf desc nulls last, done desc, p_partkey)})
             as varchar) as primary_data,
           cast(to_json({'record_count': count(*)}) as varchar) as data_json,
           array_to_string(list_sort(list(distinct p_size)), ',') as sources,
           min(done) as created_at, max(done) as updated_at, max(conf) as confidence_score
    from p group by key""")
def master_records(t):
    blank = F.lit("").alias("hours")
    cleaned_parts = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("raw_data_id"),
        F.col("p_size").cast("bigint").alias("source_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.struct(F.lit("").alias("street"), F.col("p_brand").alias("city")).alias("address"),
        F.struct(F.lit("").alias("phone"), blank).alias("contact"),
        F.timestamp_seconds(F.floor("p_retailprice")).alias("cleaned_at"),
    )
    scores = t.lineitem.select(
        F.col("l_partkey").alias("cleaned_data_id"), F.col("l_discount").alias("confidence_score")
    )
    masters = consolidate.master_records(cleaned_parts, scores)
    return masters.select(
        "external_id", "name", "type", "address.city", "primary_data", "data_json",
        F.array_join("sources", ",").alias("sources"),
        F.unix_timestamp("created_at").alias("created_at"),
        F.unix_timestamp("updated_at").alias("updated_at"),
        "confidence_score",
    )


# Customers in raw form, standardised, looked up, and merged by market segment and balance class
# (as name and city); records that the look-up knows come first.
BEST = "conf desc nulls last, done desc, c_custkey"


@query("master_enriched", f"""
    with p as (select c.*, cast(cast(floor(c_acctbal / 1000) as bigint) as varchar) as city,
                      case when n_nationkey is not null then cast(1.0 as double) end as conf,
                      cast(floor(c_acctbal) as bigint) + 100000 as done
               from customer c left join nation on 2 * c_nationkey = n_nationkey)
    select md5(lower(c_mktsegment) || '|' || city) as external_id, c_mktsegment as name, city,
           first(c_name order by {BEST}) as type,
           first(regexp_replace(c_name, '[^0-9]', '', 'g') order by {BEST}) as phone,
           cast(to_json({{'id': first(c_custkey order by {BEST}), 'raw_data_id': first(c_custkey order by {BEST}),
                          'source_id': first(cast(c_nationkey as bigint) order by {BEST})}}) as varchar)
             as primary_data,
           array_to_string(list_sort(list(distinct c_nationkey)), ',') as sources,
           min(done) as created_at, max(done) as updated_at, max(conf) as confidence_score
    from p group by c_mktsegment, city""")
def master_enriched(t):
    blank = F.lit("")
    records = validate.standardize(t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("raw_data_id"),
        F.col("c_nationkey").cast("bigint").alias("source_id"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit("\n")).alias("name"),
        F.col("c_name").alias("category"),
        F.struct(blank.alias("street"), F.floor(F.col("c_acctbal") / 1000).cast("string").alias("city")).alias("address"),
        F.struct(F.col("c_name").alias("phone"), blank.alias("hours")).alias("contact"),
        F.timestamp_seconds(F.floor("c_acctbal") + 100000).alias("cleaned_at"),
    ))
    found = enrich.enriched_rows(records, t.nation, 2 * F.col("source_id"), "n_nationkey", ["n_name"],
                                 "geolocation", "nation table")
    masters = consolidate.master_records(records, found.select("cleaned_data_id", "confidence_score"))
    return masters.select(
        "external_id", "name", "type", "address.city", "contact.phone", "primary_data",
        F.array_join("sources", ",").alias("sources"),
        F.unix_timestamp("created_at").alias("created_at"),
        F.unix_timestamp("updated_at").alias("updated_at"),
        "confidence_score",
    )


@query("retry_list", """
    select event_id, user_id, ts from events e where event_type = 'error'
      and not exists (select 1 from events p where p.event_type = 'purchase' and p.user_id = e.user_id
                      and p.ts > e.ts)""")
def retry_list(t):
    rows = t.events.select("event_id", "user_id", "ts", "event_type")
    failures = rows.where("event_type = 'error'").drop("event_type")
    return consolidate.retry_list(failures, rows.where("event_type = 'purchase'"), "user_id", "ts")


# Users are pages, their errors failed attempts and their purchases ones that came; ids are in order of time.
@query("retry_schedule", """
    with tried as (select user_id, event_id, ts, event_type = 'error' as failed from events
                   where event_type in ('error', 'purchase') and user_id is not null),
         ends as (select user_id, max(event_id) as last_end from tried where not failed group by 1),
         open as (select t.user_id, t.event_id, t.ts from tried t left join ends e on t.user_id = e.user_id
                  where t.failed and (last_end is null or last_end <= event_id))
    select cast(user_id as bigint) as page, count(*) as tries, max(event_id) as last_event,
           cast(case when count(*) <= 5 then 60 * pow(2, count(*) - 1) end as bigint) as wait_seconds
    from open group by 1""")
def retry_schedule(t):
    rows = t.events.where("event_type in ('error', 'purchase') and user_id is not null")
    state = F.when(F.col("event_type") == "error", attempts.FAILED).otherwise(attempts.DONE)
    tried = rows.select(
        F.lit(1).cast("bigint").alias("source_id"), F.lit(None).cast("string").alias("url"),
        F.col("user_id").alias("page_number"), state.alias("state"), F.col("event_id").cast("string").alias("error"),
        F.timestamp_seconds("event_id").alias("attempted_at"), F.col("event_id").alias("seq"),
    )
    found = attempts.open_failures(tried, "seq")
    wait = F.unix_timestamp("next_try") - F.unix_timestamp("last_try")
    return found.select(F.col("page_number").cast("bigint").alias("page"), "tries",
                        F.col("error").cast("bigint").alias("last_event"), wait.alias("wait_seconds"))
