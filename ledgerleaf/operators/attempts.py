"""Attempts at pages: which failed, which are to be tried again and when, and where a run broke off.

A page is known by its source and number, or by its URL where it has no number; every
load notes one attempt per page that it was given.  What is open follows from the attempts
alone: a failure counts until a later attempt ends it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerleaf.operators.consolidate import retry_list

#: How often a page is tried again, and the answers after which it is.
RETRY_TIMES = 5
RETRY_CODES = (500, 502, 503, 504, 400, 403, 408, 429)
#: Seconds before the first new try; each further one waits twice as long.
FIRST_WAIT = 60

DONE, FAILED, REFUSED = "done", "failed", "refused"


def page_key() -> Column:
    """One text per page."""
    return F.to_json(F.struct("source_id", "page_number", F.when(F.col("page_number").isNull(), F.col("url")).alias("url")))


def with_outcome(pages: DataFrame) -> DataFrame:
    """Pages with ``state`` and ``error`` of their fetch.

    Markup that is NULL, an ``error`` text, or a ``status`` of 400 and above, where pages have
    these columns, mark a page that was not fetched.  A status that is not among `RETRY_CODES` is final.
    """
    error = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    status = F.col("status") if "status" in pages.columns else F.lit(None).cast("int")
    bad = F.coalesce(status >= 400, F.lit(False))
    text = F.coalesce(error, F.when(bad, F.concat(F.lit("HTTP status "), status.cast("string"))),
                      F.when(F.col("html").isNull(), "no answer"))
    state = F.when(text.isNull(), DONE).when(bad & ~status.isin(*RETRY_CODES), REFUSED).otherwise(FAILED)
    return pages.withColumns({"state": state, "error": text})


def attempts(pages: DataFrame, at: Column) -> DataFrame:
    """One attempt per page of a load; where a load holds a page several times, its best outcome counts."""
    seen = with_outcome(pages).select(
        "source_id", "run_id", "page_number", "url", "state", "error", page_key().alias("_page"),
        F.when(F.col("state") == DONE, 0).when(F.col("state") == REFUSED, 1).otherwise(2).alias("_rank"),
    )
    row = F.struct("source_id", "run_id", "page_number", "url", "state", "error")
    best = seen.groupBy("_page").agg(F.min(F.struct("_rank", row.alias("row"))).alias("_best"))
    return best.select("_best.row.*", at.alias("attempted_at"))


def open_failures(tried: DataFrame, order: str, first_wait: int = FIRST_WAIT, times: int = RETRY_TIMES) -> DataFrame:
    """Pages whose last attempts failed: tries since the last other outcome, and the time of the next.

    ``order`` sorts attempts at a page in time; the loads' batch ids do.  ``next_try`` is NULL once
    a page has failed more than ``times`` times: it is given up.  Each side of the only join is reduced to
    a row per page, or split by AQE where one page holds many failures.
    """
    keyed = tried.withColumn("_page", page_key())
    failures, ends = keyed.where(F.col("state") == FAILED), keyed.where(F.col("state") != FAILED)
    current = retry_list(failures, ends.select("_page", order), "_page", order)
    last = F.max_by(F.struct("source_id", "page_number", "url", "error", "attempted_at"), order)
    pages = current.groupBy("_page").agg(last.alias("_last"), F.count("*").alias("tries"))
    wait = F.make_dt_interval(secs=F.lit(first_wait) * F.pow(F.lit(2.0), F.col("tries") - 1).cast("decimal(18,6)"))
    again = F.when(F.col("tries") <= times, F.col("_last.attempted_at") + wait)
    return pages.select("_last.source_id", "_last.page_number", "_last.url", "tries", "_last.error",
                        F.col("_last.attempted_at").alias("last_try"), again.alias("next_try"))


def due(open_pages: DataFrame, at: Column) -> DataFrame:
    """Those of `open_failures` whose next try has come."""
    return open_pages.where(F.col("next_try") <= at)


def reached(tried: DataFrame, run: int) -> int:
    """The last page that a run has tried, 0 if none."""
    return tried.where(F.col("run_id") == run).agg(F.max("page_number")).first()[0] or 0
