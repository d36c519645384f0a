"""Registered queries for session state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import state as st
from ..sources import bindings as b
from . import oracle_views as ov
from .registry import query

SUBMITTED = """submitted AS (
  SELECT domain, seq, company, lead_id, submitted_at, source_url FROM (
    SELECT *, row_number() OVER (PARTITION BY domain ORDER BY submitted_at DESC, seq DESC) AS rn FROM submissions) WHERE rn = 1)"""
TRIED = """tried AS (
  SELECT query, seq, tried_at, companies_found FROM (
    SELECT trim(query) AS query, seq, tried_at, companies_found,
      row_number() OVER (PARTITION BY trim(query) ORDER BY tried_at DESC, seq DESC) AS rn FROM query_log) WHERE rn = 1)"""
MERGED = """merged AS (
  SELECT source, key, value FROM (
    SELECT *, row_number() OVER (PARTITION BY source, key ORDER BY seq DESC) AS rn FROM progress) WHERE rn = 1)"""
WS = ov.with_(ov.SUBMISSIONS, SUBMITTED)
WT = ov.with_(ov.QUERY_LOG, TRIED)
WP = ov.with_(ov.PROGRESS, MERGED)


def submitted(spark, d):
    return st.record_submissions(b.submissions(spark, d))


def tried(spark, d):
    return st.record_queries(b.query_log(spark, d))


def merged(spark, d):
    return st.merge_source_progress(b.progress(spark, d))


@query("record_submissions", "I3", WS + """SELECT domain, company, lead_id, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at, source_url FROM submitted""")
def record_submissions(spark, d):
    s = submitted(spark, d)
    return s.select("domain", "company", "lead_id", tx.ts_string("submitted_at").alias("submitted_at"), "source_url")


@query("record_queries", "I4", WT + """SELECT query, strftime(tried_at, '%Y-%m-%d %H:%M:%S') AS tried_at, CAST(companies_found AS BIGINT) AS companies_found FROM tried""")
def record_queries(spark, d):
    t = tried(spark, d)
    return t.select("query", tx.ts_string("tried_at").alias("tried_at"), F.col("companies_found").cast("bigint").alias("companies_found"))


@query("merge_source_progress", "I5", WP + "SELECT source, key, value FROM merged")
def merge_source_progress(spark, d):
    return merged(spark, d).select("source", "key", "value")


@query("reset_source", "I6", WP + "SELECT source, key, value FROM merged WHERE source <> 'dir3'")
def reset_source(spark, d):
    remaining, _found = st.reset_source(merged(spark, d), "dir3")
    return remaining.select("source", "key", "value")


@query("new_companies", "D2", ov.with_(ov.SUBMISSIONS, SUBMITTED, ov.CANDIDATES) + """SELECT kind, seq, company, domain FROM candidates c
WHERE NOT EXISTS (SELECT 1 FROM submitted s WHERE s.domain = c.domain)""")
def new_companies(spark, d):
    return st.new_companies(b.candidates(spark, d), submitted(spark, d)).select("kind", "seq", "company", "domain")


@query("untried_queries", "D3", ov.with_(ov.QUERY_LOG, TRIED, ov.ATTEMPTS) + """SELECT DISTINCT trim(search_term) AS query FROM attempts a
WHERE NOT EXISTS (SELECT 1 FROM tried t WHERE t.query = trim(a.search_term))""")
def untried_queries(spark, d):
    terms = b.attempts(spark, d).select(F.col("search_term").alias("query")).distinct()
    return st.untried_queries(terms, tried(spark, d))


@query("known_companies", "D4", ov.with_(ov.SUBMISSIONS, SUBMITTED, ov.CANDIDATES) + """SELECT kind, seq, company, domain FROM candidates c
WHERE EXISTS (SELECT 1 FROM submitted s WHERE s.domain = c.domain)""")
def known_companies(spark, d):
    return st.known_companies(b.candidates(spark, d), submitted(spark, d)).select("kind", "seq", "company", "domain")


@query("lookup_state", "D4", ov.with_(ov.SUBMISSIONS, SUBMITTED, ov.CANDIDATES) + """SELECT c.kind, c.seq, c.domain, s.lead_id IS NOT NULL AS submitted,
  coalesce(s.lead_id, '') AS lead_id FROM candidates c LEFT JOIN submitted s ON s.domain = c.domain""")
def lookup_state(spark, d):
    return st.lookup_submission(b.candidates(spark, d), submitted(spark, d))


@query("lookup_tried", "D4", ov.with_(ov.QUERY_LOG, TRIED) + """SELECT c.query, strftime(t.tried_at, '%Y-%m-%d %H:%M:%S') AS tried_at
FROM (SELECT DISTINCT 'term_' || (c_custkey % 60) AS query FROM customer) c LEFT JOIN tried t ON t.query = c.query""")
def lookup_tried(spark, d):
    asked = b.read_table(spark, d, "customer").select(F.concat(F.lit(" term_"), (F.col("c_custkey") % 60).cast("string")).alias("query")).distinct()
    return st.lookup_tried(asked, tried(spark, d)).select("query", tx.ts_string("tried_at").alias("tried_at"))


@query("lookup_progress", "D4", WP + """SELECT c.source, coalesce(m.entries, '') AS entries
FROM (SELECT DISTINCT 'dir' || (s_suppkey % 9) AS source FROM supplier) c
LEFT JOIN (SELECT source, string_agg(key || '=' || value, ',' ORDER BY key || '=' || value) AS entries FROM merged GROUP BY source) m USING (source)""")
def lookup_progress(spark, d):
    asked = b.read_table(spark, d, "supplier").select(F.concat(F.lit("dir"), (F.col("s_suppkey") % 9).cast("string")).alias("source")).distinct()
    return st.lookup_progress(asked, merged(spark, d)).select("source", F.array_join("entries", ",").alias("entries"))


@query("associate_by_domain", "D5", ov.with_(ov.SUBMISSIONS, SUBMITTED, ov.CANDIDATES) + """SELECT s.domain, s.lead_id, c.kind, c.seq AS company_seq, c.segment
FROM submitted s LEFT JOIN candidates c ON c.domain = s.domain""")
def associate_by_domain(spark, d):
    j = st.associate_by_domain(submitted(spark, d).select("domain", "lead_id"), b.candidates(spark, d))
    return j.select("domain", "lead_id", "kind", "company_seq", "segment")


@query("state_summary", "E23", ov.with_(ov.SUBMISSIONS, SUBMITTED, ov.QUERY_LOG, TRIED) + """SELECT
  (SELECT count(*) FROM submitted) AS total_submitted, (SELECT count(*) FROM tried) AS total_queries_tried""")
def state_summary(spark, d):
    return st.state_summary(submitted(spark, d), tried(spark, d))


@query("source_status", "E23", WP + """SELECT source, coalesce(max(CASE WHEN key = 'status' THEN value END), 'unknown') AS status,
  coalesce(max(CASE WHEN key = 'companies_submitted' THEN value END), '?') AS companies_submitted FROM merged GROUP BY source""")
def source_status(spark, d):
    return st.source_status(merged(spark, d))


@query("count_by_day", "E24", WT + """SELECT strftime(tried_at, '%Y-%m-%d') AS day, count(*) AS n FROM tried GROUP BY 1 ORDER BY day DESC LIMIT 7""")
def count_by_day(spark, d):
    return st.count_by_day(tried(spark, d))


@query("recent_submissions", "G2", WS + """SELECT domain, company, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at FROM submitted
ORDER BY submitted_at DESC, domain LIMIT 10""")
def recent_submissions(spark, d):
    return st.recent_submissions(submitted(spark, d))


@query("queries_by_time", "G3", WT + "SELECT query, strftime(tried_at, '%Y-%m-%d %H:%M:%S') AS tried_at FROM tried ORDER BY tried_at DESC, query")
def queries_by_time(spark, d):
    return st.listing_by_time(tried(spark, d), "tried_at", ["query"])


@query("submitted_by_time", "G3", WS + """SELECT domain, company, strftime(submitted_at, '%Y-%m-%d %H:%M:%S') AS submitted_at FROM submitted ORDER BY submitted_at DESC, domain""")
def submitted_by_time(spark, d):
    return st.listing_by_time(submitted(spark, d), "submitted_at", ["domain", "company"])
