"""Session state as keyed tables.

Three tables replace the reference's JSON file: ``submitted`` keyed by
normalised domain, ``queries_tried`` keyed by stripped query text, and
``source_progress`` keyed by (source, key). Upserts are 'last writer wins'
aggregates over (old state UNION new events); membership tests are anti /
semi joins. Nothing is broadcast blindly: the state grows with use, so the
join strategy is left to AQE, which broadcasts only when the measured side
is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .ordering import last_per_key


def record_submissions(events: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Upsert by normalised domain, last writer (time, then arrival) wins."""
    ev = events.withColumn("domain", tx.normalize_domain("domain"))
    src = ev if state is None else state.unionByName(ev, allowMissingColumns=True)
    return last_per_key(src, ["domain"], ["submitted_at", "seq"])


def record_queries(events: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """I4: upsert by stripped query text, last writer wins."""
    ev = events.withColumn("query", tx.py_strip("query"))
    src = ev if state is None else state.unionByName(ev, allowMissingColumns=True)
    return last_per_key(src, ["query"], ["tried_at", "seq"])


def merge_source_progress(entries: DataFrame, state: DataFrame | None = None, stamp: str | None = None) -> DataFrame:
    """New keys merged into each source's stored entries; the newer value wins. ``stamp`` marks the new entries' time."""
    new = entries if stamp is None else entries.withColumn("last_updated", F.lit(stamp))
    src = new if state is None else state.unionByName(new, allowMissingColumns=True)
    return last_per_key(src, ["source", "key"], ["seq"])


def reset_source(progress: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Drop one source; also returns a one-row frame telling whether it existed."""
    found = progress.agg(F.coalesce(F.bool_or(F.col("source") == source), F.lit(False)).alias("found"))
    return progress.filter(F.col("source") != source), found


def new_companies(candidates: DataFrame, submitted: DataFrame) -> DataFrame:
    """Candidates whose normalised domain was never submitted (left anti join)."""
    c = candidates.withColumn("domain", tx.normalize_domain("domain"))
    return c.join(submitted.select("domain"), "domain", "left_anti")


def untried_queries(queries: DataFrame, tried: DataFrame, col: str = "query") -> DataFrame:
    """D3: queries (stripped) never tried before."""
    q = queries.withColumn(col, tx.py_strip(col))
    return q.join(tried.select(F.col("query").alias(col)), col, "left_anti")


def known_companies(candidates: DataFrame, submitted: DataFrame) -> DataFrame:
    """D4 (membership): candidates already submitted (left semi join)."""
    c = candidates.withColumn("domain", tx.normalize_domain("domain"))
    return c.join(submitted.select("domain"), "domain", "left_semi")


def lookup_submission(candidates: DataFrame, submitted: DataFrame) -> DataFrame:
    """D4 (lookup): each candidate with its stored lead id, '' when unknown."""
    c = candidates.withColumn("domain", tx.normalize_domain("domain"))
    s = submitted.select("domain", "lead_id")
    j = c.join(s, "domain", "left")
    return j.select("kind", "seq", "domain", F.col("lead_id").isNotNull().alias("submitted"), F.coalesce("lead_id", F.lit("")).alias("lead_id"))


def lookup_tried(queries: DataFrame, tried: DataFrame, col: str = "query") -> DataFrame:
    """D4 (lookup): each query (stripped) with the time it was tried, NULL when never."""
    q = queries.withColumn(col, tx.py_strip(col))
    return q.join(tried.select(F.col("query").alias(col), "tried_at"), col, "left")


def lookup_progress(sources: DataFrame, progress: DataFrame) -> DataFrame:
    """D4 (lookup): each source with its stored entries as ``key=value``, sorted; empty when there are none."""
    entries = progress.groupBy("source").agg(F.array_sort(F.collect_list(F.concat_ws("=", "key", "value"))).alias("entries"))
    return sources.join(entries, "source", "left").withColumn("entries", F.coalesce("entries", F.array().cast("array<string>")))


def associate_by_domain(leads: DataFrame, companies: DataFrame) -> DataFrame:
    """Attach leads to known companies by normalised domain (left equi-join)."""
    l = leads.withColumn("domain", tx.normalize_domain("domain"))
    c = companies.select(tx.normalize_domain("domain").alias("domain"), "kind", F.col("seq").alias("company_seq"), "segment")
    return l.join(c, "domain", "left")


def state_summary(submitted: DataFrame, tried: DataFrame) -> DataFrame:
    """E23 (totals): submitted domains and tried queries, one aggregate over both tables."""
    u = submitted.select(F.lit(True).alias("__s")).unionByName(tried.select(F.lit(False).alias("__s")))
    return u.agg(F.count_if("__s").alias("total_submitted"), F.count_if(~F.col("__s")).alias("total_queries_tried"))


def source_status(progress: DataFrame) -> DataFrame:
    """E23 (per source): status and companies submitted, defaults 'unknown' and '?'."""
    return progress.groupBy("source").agg(
        F.coalesce(F.max(F.when(F.col("key") == "status", F.col("value"))), F.lit("unknown")).alias("status"),
        F.coalesce(F.max(F.when(F.col("key") == "companies_submitted", F.col("value"))), F.lit("?")).alias("companies_submitted"),
    )


def count_by_day(tried: DataFrame, days: int = 7) -> DataFrame:
    """Tried queries per day, newest ``days`` days."""
    g = tried.groupBy(tx.day_bucket("tried_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("day").desc()).limit(days)


def recent_submissions(submitted: DataFrame, k: int = 10) -> DataFrame:
    """Newest k submissions (ties by domain)."""
    return submitted.orderBy(F.col("submitted_at").desc(), F.col("domain").asc()).limit(k).select(
        "domain", "company", tx.ts_string("submitted_at").alias("submitted_at"))


def listing_by_time(df: DataFrame, time_col: str, cols: list[str]) -> DataFrame:
    """A full listing, newest first, ties by the listed columns."""
    return df.orderBy(F.col(time_col).desc(), *cols).select(*cols, tx.ts_string(time_col).alias(time_col))
