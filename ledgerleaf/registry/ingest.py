"""Fingerprints, history, routing and the whole ingest over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerleaf.functions import text as X, url as U
from ledgerleaf.operators import dedup, extract, ingest, joins, ledger, validate

from .base import query
from .extraction import HOST, cleaned


def hashed(t) -> DataFrame:
    return t.documents.select("doc_id", "source", F.md5("text").alias("hash"))


@query("exact_dedup", "select md5(text) as hash, min(doc_id) as doc_id from documents group by 1")
def exact_dedup(t):
    return dedup.first_ids(hashed(t), "hash", "doc_id")


@query("first_wins", """
    select doc_id, source, lang, hash from
      (select doc_id, source, lang, md5(text) as hash,
              row_number() over (partition by md5(text) order by doc_id) as rn from documents)
    where rn = 1""")
def first_wins(t):
    rows = t.documents.select("doc_id", "source", "lang", F.md5("text").alias("hash"))
    return dedup.first_wins(rows, "hash", ["doc_id"])


# The labelled documents are the history, all documents arrive (again).
SEEN_SQL = """
    with h as (select distinct md5(text) as hash from documents join labels using (doc_id)),
         n as (select md5(text) as hash, min(doc_id) as doc_id from documents group by 1)
    select hash, doc_id from n where hash not in (select hash from h)"""


def labelled(t) -> DataFrame:
    return hashed(t).join(t.labels.select("doc_id"), "doc_id", "left_semi").select("hash")


@query("incremental_dedup", SEEN_SQL)
def incremental_dedup(t):
    return dedup.drop_seen(dedup.first_ids(hashed(t), "hash", "doc_id"), labelled(t))


@query("incremental_dedup_probing", SEEN_SQL)
def incremental_dedup_probing(t):
    return dedup.drop_seen_probing(dedup.first_ids(hashed(t), "hash", "doc_id"), labelled(t))


@query("orphan_check", "select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def orphan_check(t):
    return joins.orphans(t.documents.select("doc_id", "source"), "doc_id", t.labels, "doc_id")


@query("length_rejects", "select doc_id, length(text) as length from documents where length(text) > 255")
def length_rejects(t):
    return validate.length_rejects(t.documents, "doc_id", "text", 255)


@query("get_or_create", f"""
    with o as (select distinct {HOST} as name from pages where contains(url, '?page='))
    select name, 'old' as state from o
    union all
    select distinct {HOST} as name, 'new' as state from pages where {HOST} not in (select name from o)""")
def get_or_create(t):
    names = t.pages.select(U.host("url").alias("name"), "url")
    return ledger.get_or_create(names.where(U.query_param("url", "page").isNotNull()), names)


@query("new_sources", f"""
    with o as (select distinct {HOST} as name from pages where contains(url, '?page='))
    select {HOST} as name, min(url) as url, true as is_active from pages
    where {HOST} not in (select name from o) group by 1""")
def new_sources(t):
    names = t.pages.select(U.host("url").alias("name"), "url")
    known = names.where(U.query_param("url", "page").isNotNull())
    return ledger.new_sources(known, names).select("name", "url", "is_active")


@query("insert_if_absent", """
    select doc_id, cast(quality as varchar) as quality, 'stored' as state from labels
    union all
    select doc_id, null as quality, 'added' as state from documents
    where doc_id not in (select doc_id from labels)""")
def insert_if_absent(t):
    stored = t.labels.select("doc_id", F.col("quality").cast("string"), F.lit("stored").alias("state"))
    return joins.insert_if_absent(stored, t.documents.select("doc_id", F.lit("added").alias("state")), "doc_id")


@query("insert_defaults", """
    select d.doc_id, coalesce(quality, -1) as quality, coalesce(toxic, 0) as toxic, true as is_active
    from documents d left join labels l on d.doc_id = l.doc_id""")
def insert_defaults(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joins.fill_defaults(rows, {"quality": -1, "toxic": 0, "is_active": True})


# Orders are open runs; an order is closed by its last shipment once all lines are final.
@query("upsert_runs", """
    with c as (select l_orderkey, max(l_shipdate) as done, count(*) as n from lineitem
               group by l_orderkey having count(*) filter (where l_linestatus <> 'F') = 0)
    select o_orderkey as id, coalesce(c.done, o_orderdate) as updated_at,
           case when c.l_orderkey is null then o_orderstatus else 'completed' end as status,
           coalesce(n, 0) as items
    from orders left join c on l_orderkey = o_orderkey""")
def upsert_runs(t):
    runs = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderstatus").alias("status"), F.lit(0).cast("bigint").alias("items"),
    )
    closed = (
        t.lineitem.groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.max("l_shipdate").alias("done"), F.count("*").alias("items"),
             F.count_if(F.col("l_linestatus") != "F").alias("pending"))
        .where("pending = 0")
        .select("id", "items", "done", F.lit("completed").alias("status"))
    )
    return joins.upsert(runs, closed, "id", touch=F.col("new.done"))


@query("run_items", """
    with n as (select source, row_number() over (partition by md5(text) order by doc_id) as rn from documents)
    select source as id, count(*) as items_seen, count(*) filter (where rn = 1) as items_new
    from n group by source""")
def run_items(t):
    items = hashed(t).withColumnRenamed("source", "run_id")
    new = dedup.first_wins(items, "hash", ["doc_id"]).withColumn("error", F.lit(None).cast("string"))
    return ledger.run_counts(items, new)


@query("union_rejects", """
    select doc_id, md5(text) as hash, cast(null as varchar) as error, 'processed' as status
    from documents where length(text) <= 255
    union all
    select doc_id, md5(text), cast(null as varchar), 'failed' from documents where length(text) > 255
    union all
    select doc_id, null, 'too_long', 'failed' from documents where length(text) > 255""")
def union_rejects(t):
    void = F.lit(None).cast("string")
    long = F.when(X.too_long("text", 255), "too_long")
    rows = t.documents.select(
        void.alias("source_id"), void.alias("run_id"), F.col("doc_id").alias("url"), void.alias("raw_content"),
        void.alias("raw_json"), F.md5("text").alias("hash"), long.alias("address_error"),
    )
    raw = ingest.raw_rows(rows, F.current_timestamp())
    return raw.select(F.col("url").alias("doc_id"), "hash", "error", F.col("processing_status").alias("status"))


# Documents as listing items in JSON: Spanish ones have a null address (they fail), German
# ones none at all (it reads as blank).  The known sources are nation and region keys added up,
# which leave gaps; the history is all that has a label.
def document_items(documents: DataFrame) -> DataFrame:
    first_line = F.substring_index("text", "\n", 1).alias("name")
    place = F.struct(F.col("source").alias("street"), F.col("lang").alias("city"))
    rest = [F.col("text").alias("html"), F.lit(1).alias("page_number"), F.lit(None).cast("string").alias("phone")]
    keep_nulls = {"ignoreNullFields": "false"}
    with_address = F.to_json(
        F.struct(first_line, F.when(F.col("lang") != "es", place).alias("address"), *rest), keep_nulls
    )
    without = F.to_json(F.struct(first_line, *rest), keep_nulls)
    return extract.items_from_json(documents.select(
        F.substring("source", 4, 10).cast("bigint").alias("source_id"),
        F.lit(None).cast("bigint").alias("run_id"),
        F.lit(1).alias("page_number"),
        F.col("doc_id").alias("entry_pos"),
        F.col("doc_id").cast("string").alias("url"),
        F.when(F.col("lang") == "de", without).otherwise(with_address).alias("raw_json"),
    ))


def ingested(t) -> ingest.Ingested:
    items = document_items(t.documents)
    stored = t.documents.join(t.labels, "doc_id", "left_semi")
    history = document_items(stored).select("hash")
    known = t.nation.select((F.col("n_nationkey") + F.col("n_regionkey")).cast("bigint").alias("id"))
    return ingest.ingest(items, history, known)


# Content is equal where text, language and, unless the address is dropped, source agree.
INGEST_SQL = """
    with i as (select doc_id, cast(substr(source, 4) as bigint) as source_id, lang, text,
                      case when lang in ('en', 'fr') then source else '' end as place,
                      split_part(text, chr(10), 1) as name from documents),
         k as (select n_nationkey + n_regionkey as id from nation),
         f as (select *, case when source_id not in (select id from k) then 'unknown_source'
                              when lang <> 'es' and length(name) > 255 then 'too_long:name' end as reason from i),
         h as (select distinct i.text, i.lang, i.place from i join labels l on i.doc_id = l.doc_id),
         s as (select text, lang, place, min(doc_id) as doc_id from f where reason is null group by all),
         w as (select s.doc_id, f.source_id, s.text, s.lang, s.place, f.name
               from s join f on s.doc_id = f.doc_id
               where (s.text, s.lang, s.place) not in (select (text, lang, place) from h))"""


@query("ingest_raw", INGEST_SQL + """
    select cast(doc_id as varchar) as url, source_id, text as html, cast(null as varchar) as error,
           case when lang = 'es' then 'failed' else 'processed' end as processing_status from w
    union all
    select cast(doc_id as varchar), source_id, null, '''NoneType'' object has no attribute ''get''', 'failed'
    from w where lang = 'es'""")
def ingest_raw(t):
    return ingested(t).raw.select("url", "source_id", "raw_content.html", "error", "processing_status")


@query("ingest_rejects", INGEST_SQL + """
    select cast(doc_id as varchar) as url, source_id, reason from f
    where reason is not null and (text, lang, place) not in (select (text, lang, place) from h)
      and not exists (select 1 from s where s.text = f.text and s.lang = f.lang and s.place = f.place
                      and s.doc_id < f.doc_id)""")
def ingest_rejects(t):
    return ingested(t).rejects.select("url", "source_id", "reason")


@query("ingest_cleaned", INGEST_SQL + f"""
    select source_id, name, '' as category, case when lang = 'de' then '' else place end as street,
           case when lang = 'de' then '' else lang end as city, cast(null as varchar) as phone, '' as hours,
           cast(1 as int) as page_number, '' as subtitle, text as raw_html,
           case when {cleaned('name')} = '' then 'invalid' else 'partial' end as validation_status,
           case when {cleaned('name')} = '' then 'name:missing,' else '' end
             || case when lang = 'de' then 'street:missing,city:missing,' else '' end
             || 'phone:missing' as errors
    from w where lang <> 'es'""")
def ingest_cleaned(t):
    raw = ingested(t).raw.withColumn("id", F.lit(None).cast("bigint"))
    rows = ingest.cleaned_rows(raw, validate.ValidationRules())
    codes = F.transform("validation_errors", lambda e: F.concat(e["field"], F.lit(":"), e["code"]))
    return rows.select(
        "source_id", "name", "category", "address.*", "contact.*", "data_json.*", "validation_status",
        F.array_join(codes, ",").alias("errors"),
    )
