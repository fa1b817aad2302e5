"""Reports, quality checks and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerleaf.functions import html as H, json as J, url as U
from ledgerleaf.operators.dedup import duplicate_keys, duplicate_texts
from ledgerleaf.plans import metrics, quality, reports

from .base import Tables, query


# The tables seen as the package's own: customers and nations are sources, orders are
# runs, events are raw rows, customers and labelled documents are cleaned rows, parts
# and events are master rows.
def customer_sources(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


def order_runs(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("source_id"),
        F.col("o_orderdate").alias("start_time"), F.col("o_orderstatus").alias("status"),
    )


def event_rows(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("source_id"),
        F.col("ts").alias("scraped_at"), F.col("event_type").alias("processing_status"),
        F.col("props").alias("raw_content"),
    )


def customer_records(t: Tables) -> DataFrame:
    status = (
        F.when(F.col("c_acctbal") < 0, "invalid").when(F.col("c_acctbal") < 1000, "partial").otherwise("valid")
    )
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("source_id"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("category"),
        status.alias("validation_status"),
    )


CUSTOMER_STATUS = (
    "case when c_acctbal < 0 then 'invalid' when c_acctbal < 1000 then 'partial' else 'valid' end"
)


def labelled_documents(t: Tables) -> DataFrame:
    status = F.when(F.col("quality") == 1, "valid").when(F.col("quality") == 0, "partial")
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"), status.alias("validation_status")
    )


LABELLED = """(select d.doc_id, case when quality = 1 then 'valid' when quality = 0 then 'partial' end
               as validation_status from documents d left join labels l on d.doc_id = l.doc_id)"""


@query("overview_counts", """
    select (select count(*) from customer) as sources_count,
           (select count(*) from events) as raw_count,
           (select count(*) from part) as master_count""")
def overview_counts(t):
    return reports.overview(t.customer, t.events, t.part)


@query("source_names", "select c_name as name from customer")
def source_names(t):
    return reports.source_names(customer_sources(t))


@query("bound_sql", """
    select o_orderstatus as status, count(*) as runs from orders
    where o_orderpriority = '1-URGENT' group by o_orderstatus""")
def bound_sql(t):
    t.orders.createOrReplaceTempView("bound_sql_orders")
    return reports.run_sql(
        t.spark,
        """select o_orderstatus as status, count(*) as runs from bound_sql_orders
           where o_orderpriority = :priority group by o_orderstatus""",
        priority="1-URGENT",
    )


@query("recent_runs", """
    select o_orderkey as id, c_name as source, o_orderdate as start_time, o_orderstatus as status
    from orders join customer on o_custkey = c_custkey
    order by o_orderdate desc nulls first, o_orderkey desc limit 10""")
def recent_runs(t):
    return reports.recent_runs(order_runs(t), customer_sources(t))


@query("source_stats", """
    select c_name as source, count(event_id) as records, min(ts) as first_scrape, max(ts) as last_scrape
    from customer left join events on c_custkey = user_id group by c_name""")
def source_stats(t):
    return reports.source_stats(customer_sources(t), event_rows(t))


@query("source_counts", """
    select c_name as source, count(o_orderkey) as count
    from customer left join orders on c_custkey = o_custkey group by c_name""")
def source_counts(t):
    return reports.source_counts(customer_sources(t), order_runs(t))


RAW_SQL = """
    select event_id as id, ts as scraped_at, event_type as processing_status, props as raw_content
    from events join customer on user_id = c_custkey where c_name = 'Customer#000000046'"""


@query("raw_explorer", RAW_SQL + " and event_type = 'click'")
def raw_explorer(t):
    return reports.raw_explorer(event_rows(t), customer_sources(t), "Customer#000000046", "click")


@query("raw_explorer_all", RAW_SQL)
def raw_explorer_all(t):
    return reports.raw_explorer(event_rows(t), customer_sources(t), "Customer#000000046")


def nation_sources(t):
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))


CLEANED_SQL = f"""
    select c_custkey as id, c_name as name, c_mktsegment as category,
           {CUSTOMER_STATUS} as validation_status
    from customer join nation on c_nationkey = n_nationkey where n_name = 'NATION_7'"""


@query("cleaned_explorer", CLEANED_SQL + f" and {CUSTOMER_STATUS} = 'partial'")
def cleaned_explorer(t):
    return reports.cleaned_explorer(customer_records(t), nation_sources(t), "NATION_7", "partial")


@query("cleaned_explorer_all", CLEANED_SQL)
def cleaned_explorer_all(t):
    return reports.cleaned_explorer(customer_records(t), nation_sources(t), "NATION_7")


def part_masters(t):
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("external_id"),
        F.col("p_name").alias("name"), F.col("p_type").alias("type"), "p_retailprice",
    )


PART_SQL = """
    select p_partkey as id, p_brand as external_id, p_name as name, p_type as type, p_retailprice
    from part where p_name ilike '%{0}%' or p_brand ilike '%{0}%'"""


@query("search", PART_SQL.format("RING"))
def search(t):
    return reports.search(part_masters(t), "RING")


@query("search_pattern", PART_SQL.format("b_and#1"))
def search_pattern(t):
    return reports.search(part_masters(t), "b_and#1")


@query("recent_records", """
    select event_id as id, ts as updated_at, user_id, event_type, value, props from events
    order by ts desc nulls first, event_id desc limit 100""")
def recent_records(t):
    rows = t.events.withColumnsRenamed({"event_id": "id", "ts": "updated_at"})
    return reports.search(rows, "")


@query("records_per_day", """
    select cast(cast(ts as date) as varchar) as date, count(*) as count from events group by 1""")
def records_per_day(t):
    days = reports.records_per_day(event_rows(t))
    return days.withColumn("date", F.col("date").cast("string"))


@query("status_distribution", f"""
    select validation_status, count(*) as count from {LABELLED} group by validation_status""")
def status_distribution(t):
    return reports.status_distribution(labelled_documents(t))


@query("status_share", """
    select event_type as processing_status, count(*) as count,
           count(*) / cast((select count(*) from events) as double) as share
    from events group by event_type""")
def status_share(t):
    return reports.status_share(event_rows(t), "processing_status")


@query("row_count", "select count(*) as count from lineitem")
def row_count(t):
    return quality.row_count(t.lineitem)


@query("count_by_json_key", """
    select cast(json_extract_string(props, '$.k') as int) as page, count(*) as count from events
    where json_extract_string(props, '$.k') is not null group by 1 order by 1 nulls last""")
def count_by_json_key(t):
    return quality.count_by_json_int(t.events, "props", "$.k")


@query("bad_json_ints", """
    select count(*) filter (where try_cast(event_type as int) is null) as bad_values from events""")
def bad_json_ints(t):
    typed = t.events.select(F.to_json(F.struct("event_type")).alias("doc"))
    return quality.bad_json_ints(typed, "doc", "$.event_type")


@query("duplicate_keys", """
    select regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) as host, count(*) as count
    from pages group by 1 having count(*) > 1""")
def duplicate_hosts(t):
    return duplicate_keys(t.pages.select(U.host("url").alias("host")), "host")


@query("duplicate_texts", "select text, count(*) as count from documents group by text having count(*) > 1")
def repeated_texts(t):
    return duplicate_texts(t.documents, "text", "doc_id")


@query("latest_json_sample", """
    select event_id as id, event_type, json_extract_string(props, '$.k') as page,
           json_extract_string(props, '$.address.city') as city
    from events order by event_id desc nulls first limit 5""")
def latest_json_sample(t):
    rows = t.events.withColumnRenamed("event_id", "id")
    return quality.latest(rows, "props", {"page": "$.k", "city": "$.address.city"}, ["event_type"])


@query("json_default", """
    select event_id, coalesce(json_extract_string(props, '$.k'), '') as k,
           coalesce(json_extract_string(props, '$.absent'), 'none') as absent from events""")
def json_default(t):
    v = J.variant("props")
    return t.events.select(
        "event_id", J.get_default(v, "$.k").alias("k"), J.get_default(v, "$.absent", "none").alias("absent")
    )


@query("success_rate", """
    select cast(cast(ts as date) as varchar) as day, count(*) as total,
           count(*) filter (where event_type <> 'error') as succeeded,
           count(*) filter (where event_type <> 'error') / cast(count(*) as double) as rate
    from events group by 1""")
def success_rate(t):
    return metrics.success_rate(t.events, F.to_date("ts").cast("string"), "day", F.col("event_type") != "error")


@query("run_duration", """
    select user_id as id,
           date_diff('second', date_trunc('second', min(ts)), date_trunc('second', max(ts))) as seconds
    from events group by user_id""")
def run_duration(t):
    runs = t.events.groupBy(F.col("user_id").alias("id")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time")
    )
    return metrics.run_duration(runs)


@query("quality_score", """
    with f as (select regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) as host,
                      regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
                      regexp_extract(url, '[?&]page=([^&#]*)', 1) as page,
                      regexp_extract(url, '#(.*)$', 1) as frag from pages),
         c as (select host, count(*) as records,
                      cast(sum(cast(trim(title) <> '' as int) + cast(trim(page) <> '' as int)
                               + cast(trim(frag) <> '' as int)) as bigint) as filled
               from f group by host)
    select host, records, filled, filled / cast(records * 3 as double) as score from c""")
def quality_score(t):
    fields = t.pages.select(
        U.host("url").alias("host"), H.first_text("html", "title").alias("title"),
        U.query_param("url", "page").alias("page"), U.fragment("url").alias("frag"),
    )
    return metrics.quality_score(fields, "host", ["title", "page", "frag"])


def _chain(t):
    key = lambda c, name: F.col(c).cast("bigint").alias(name)
    return (
        t.region.select(key("r_regionkey", "id"), F.col("r_name").alias("name")),
        t.nation.select(key("n_nationkey", "id"), key("n_regionkey", "source_id")),
        t.customer.select(key("c_custkey", "id"), key("c_nationkey", "run_id")),
        t.orders.select(key("o_orderkey", "id"), key("o_custkey", "raw_data_id")),
        t.lineitem.select(key("l_linenumber", "id"), key("l_orderkey", "cleaned_data_id")),
    )


CHAIN_SQL = """from region left join nation on n_regionkey = r_regionkey
    left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey
    left join lineitem on l_orderkey = o_orderkey"""


@query("lineage_chain", f"""
    select cast(r_regionkey as bigint) as id, r_name as name, count(distinct n_nationkey) as runs,
           count(distinct c_custkey) as raw, count(distinct o_orderkey) as cleaned,
           count(l_orderkey) as enriched
    {CHAIN_SQL} group by r_regionkey, r_name""")
def lineage_chain(t):
    return metrics.lineage_counts(*_chain(t))


@query("lineage_rows", f"""
    select cast(r_regionkey as bigint) as source_id, r_name as source,
           cast(n_nationkey as varchar) as run_id, cast(c_custkey as varchar) as raw_data_id,
           cast(o_orderkey as varchar) as cleaned_data_id, cast(l_linenumber as varchar) as enriched_data_id
    {CHAIN_SQL}""")
def lineage_rows(t):
    rows = metrics.lineage_rows(*_chain(t))
    ids = ("run_id", "raw_data_id", "cleaned_data_id", "enriched_data_id")
    return rows.withColumns({c: F.col(c).cast("string") for c in ids})
