"""Registered queries for run telemetry over attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import attempts as at
from ..operators import leads as ld
from ..operators import merging as mg
from ..operators import runstats as rs
from ..operators import scoring as sc
from ..sources import bindings as b
from ..streaming.streams import work_dir
from . import oracle_views as ov
from .entrypoints import merge_batches, write_run_reports
from .probe_rules import probe_rules
from .registry import RUN_DATE, RUN_ID, query

A = ov.with_(ov.ATTEMPTS)


def att(spark, d):
    return b.attempts(spark, d)


PAIRS = """pairs AS (
  SELECT run_id, search_term, site, coalesce(bool_or(success), FALSE) AS ok,
    sum(CASE WHEN success THEN jobs_found ELSE 0 END) AS jobs,
    coalesce(bool_or(error_type = 'blocked'), FALSE) AS was_blocked,
    min(CASE WHEN error_type = 'blocked' THEN seq END) AS block_seq,
    arg_max(error_type, CASE WHEN NOT success THEN seq END) AS last_type,
    arg_max(error_message, CASE WHEN NOT success THEN seq END) AS last_message,
    arg_max(error_raw, CASE WHEN NOT success THEN seq END) AS last_raw,
    arg_max(ts, CASE WHEN NOT success THEN seq END) AS last_ts,
    arg_max(exception_class, CASE WHEN NOT success THEN seq END) AS last_class,
    count_if(NOT success) AS failed_attempts
  FROM attempts GROUP BY run_id, search_term, site)"""


def _site_stats_sql(keys: str) -> str:
    return f"""SELECT {keys}, CAST(count(*) AS BIGINT) AS searches_attempted, CAST(count_if(ok) AS BIGINT) AS searches_successful,
  CAST(sum(jobs) AS BIGINT) AS total_jobs_found, bool_or(was_blocked) AS blocked,
  arg_min(search_term, block_seq) FILTER (WHERE was_blocked) AS blocked_at_term,
  CAST(count_if(NOT ok AND NOT was_blocked) AS BIGINT) AS error_count,
  CASE WHEN count(*) > 0 THEN round(count_if(ok) / count(*) * 100, 1) ELSE 0.0 END AS success_rate"""


@query("site_stats", "E4", ov.with_(ov.ATTEMPTS, PAIRS) + _site_stats_sql("site") + " FROM pairs GROUP BY site")
def site_stats(spark, d):
    return at.site_stats(att(spark, d))


@query("blocked_sites", "E6", A + """SELECT run_id, site, arg_min(search_term, seq) AS search_term, substr(arg_min(error_message, seq), 1, 500) AS error_message,
  strftime(arg_min(ts, seq), '%Y-%m-%d %H:%M:%S') AS timestamp FROM attempts WHERE error_type = 'blocked' GROUP BY run_id, site""")
def blocked_sites(spark, d):
    return at.blocked_sites(att(spark, d))


SITE_SUMMARY_SQL = """SELECT site, CAST(count(*) AS BIGINT) AS total_attempts, CAST(count_if(success) AS BIGINT) AS successful_attempts,
  CAST(coalesce(sum(CASE WHEN success THEN jobs_found END), 0) AS BIGINT) AS total_jobs,
  CAST(sum(duration_ms) AS BIGINT) AS total_duration_ms,
  CAST(count_if(challenge_detected) AS BIGINT) AS cloudflare_encounters,
  CAST(count_if(challenge_detected AND challenge_solved IS TRUE) AS BIGINT) AS cloudflare_solved,
  CAST(count_if(challenge_detected AND challenge_solved IS FALSE) AS BIGINT) AS cloudflare_failed,
  CASE WHEN count(*) > 0 THEN round(count_if(success) / count(*) * 100, 1) ELSE 0.0 END AS success_rate,
  CAST(CASE WHEN count(*) > 0 THEN round(sum(duration_ms) / count(*)) ELSE 0 END AS BIGINT) AS avg_duration_ms,
  CASE WHEN count_if(success) > 0 THEN round(coalesce(sum(CASE WHEN success THEN jobs_found END), 0) / count_if(success), 1) ELSE 0.0 END AS avg_jobs_per_success
FROM attempts GROUP BY site"""


@query("site_summary", "E7", A + SITE_SUMMARY_SQL)
def site_summary(spark, d):
    return at.site_summary(att(spark, d))


@query("site_value_counts", "E8", A + """SELECT site, kind, key, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT site, 'error_type' AS kind, error_type AS key FROM attempts
  UNION ALL SELECT site, 'http_status', CASE WHEN http_status <> 0 THEN CAST(http_status AS VARCHAR) END FROM attempts
  UNION ALL SELECT site, 'selector', selector_matched FROM attempts)
WHERE key IS NOT NULL AND key <> '' GROUP BY site, kind, key""")
def site_value_counts(spark, d):
    return at.site_value_counts(att(spark, d))


@query("term_performance", "E9", A + """SELECT search_term, CAST(count(*) AS BIGINT) AS total_attempts,
  CAST(count_if(success) AS BIGINT) AS successful_attempts,
  CAST(coalesce(sum(CASE WHEN success THEN jobs_found END), 0) AS BIGINT) AS total_jobs,
  coalesce(string_agg(DISTINCT site, ',' ORDER BY site), '') AS sites_tried,
  coalesce(string_agg(DISTINCT site, ',' ORDER BY site) FILTER (WHERE success), '') AS sites_successful,
  coalesce(string_agg(DISTINCT site, ',' ORDER BY site) FILTER (WHERE NOT success), '') AS sites_failed,
  CASE WHEN count(*) > 0 THEN round(count_if(success) / count(*) * 100, 1) ELSE 0.0 END AS success_rate
FROM attempts GROUP BY search_term""")
def term_performance(spark, d):
    return at.term_performance(att(spark, d))


@query("timing_distribution", "E10", A + """SELECT CAST(n AS BIGINT) AS count, CAST(l[1] AS BIGINT) AS min_ms, CAST(l[n] AS BIGINT) AS max_ms,
  CAST(round(s / n) AS BIGINT) AS avg_ms, CAST(l[n // 2 + 1] AS BIGINT) AS p50_ms,
  CAST(CASE WHEN n >= 10 THEN l[CAST(floor(n * 0.9) AS BIGINT) + 1] ELSE l[n] END AS BIGINT) AS p90_ms,
  CAST(CASE WHEN n >= 100 THEN l[CAST(floor(n * 0.99) AS BIGINT) + 1] ELSE l[n] END AS BIGINT) AS p99_ms
FROM (SELECT count(*) AS n, sum(duration_ms) AS s, list_sort(list(duration_ms)) AS l FROM attempts WHERE success AND duration_ms > 0)""")
def timing_distribution(spark, d):
    return at.timing_distribution(att(spark, d))


@query("errors_by_type", "E11", A + """SELECT coalesce(error_type, 'unknown') AS error_type, CAST(count(*) AS BIGINT) AS n
FROM attempts WHERE NOT success GROUP BY 1""")
def errors_by_type(spark, d):
    return at.errors_by_type(att(spark, d))


@query("errors_by_site", "E12", A + """SELECT site, error_type, CAST(count(*) AS BIGINT) AS n, CAST(grouping(site, error_type) AS BIGINT) AS level
FROM (SELECT site, coalesce(error_type, 'unknown') AS error_type FROM attempts WHERE NOT success)
GROUP BY ROLLUP (site, error_type)""")
def errors_by_site(spark, d):
    return at.errors_by_site(att(spark, d))


@query("top_error_messages", "E13", A + """SELECT substr(error_message, 1, 100) AS message, CAST(count(*) AS BIGINT) AS n FROM attempts
WHERE NOT success AND error_message IS NOT NULL AND error_message <> ''
GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 10""")
def top_error_messages(spark, d):
    return at.top_error_messages(att(spark, d))


@query("challenge_analysis", "E14", A + """SELECT CAST(count(*) AS BIGINT) AS total_encounters,
  CAST(count_if(challenge_solved IS TRUE) AS BIGINT) AS solved, CAST(count_if(challenge_solved IS FALSE) AS BIGINT) AS failed,
  CASE WHEN count(*) > 0 THEN round(count_if(challenge_solved IS TRUE) / count(*) * 100, 1) ELSE 0.0 END AS solve_rate
FROM attempts WHERE challenge_detected""")
def challenge_analysis(spark, d):
    return at.challenge_analysis(att(spark, d))


@query("challenge_by_site", "E15", A + """SELECT site, CAST(count(*) AS BIGINT) AS encounters,
  CAST(count_if(challenge_solved IS TRUE) AS BIGINT) AS solved, CAST(count_if(challenge_solved IS FALSE) AS BIGINT) AS failed
FROM attempts WHERE challenge_detected GROUP BY site""")
def challenge_by_site(spark, d):
    return at.challenge_by_site(att(spark, d))


SEARCH_ERRORS_SQL = ov.with_(ov.ATTEMPTS, PAIRS) + """SELECT run_id, search_term, site, last_type AS error_type, substr(last_message, 1, 500) AS error_message,
  CAST(failed_attempts AS BIGINT) AS attempts, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS timestamp, last_class AS exception_class,
  CAST(nullif(regexp_extract(last_raw, '\\b([3-5]\\d{2})\\b', 1), '') AS INTEGER) AS status_code
FROM pairs WHERE NOT ok AND NOT was_blocked"""


@query("search_errors", "A7", SEARCH_ERRORS_SQL)
def search_errors(spark, d):
    return at.search_errors(att(spark, d))


@query("error_summary", "E16", ov.with_(ov.ATTEMPTS, PAIRS) + """SELECT last_type AS error_type, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total_errors FROM pairs WHERE NOT ok AND NOT was_blocked GROUP BY last_type""")
def error_summary(spark, d):
    return at.error_summary(att(spark, d))


@query("merge_run_stats", "E17", ov.with_(ov.ATTEMPTS, """bpairs AS (
  SELECT batch, run_id, search_term, site, coalesce(bool_or(success), FALSE) AS ok,
    sum(CASE WHEN success THEN jobs_found ELSE 0 END) AS jobs,
    coalesce(bool_or(error_type = 'blocked'), FALSE) AS was_blocked,
    min(CASE WHEN error_type = 'blocked' THEN seq END) AS block_seq
  FROM attempts GROUP BY batch, run_id, search_term, site)""", """per_batch AS (""" + _site_stats_sql("batch, run_id, site") + """ FROM bpairs GROUP BY batch, run_id, site)""") + """
SELECT run_id, site, CAST(count(*) AS BIGINT) AS batches, CAST(sum(searches_attempted) AS BIGINT) AS searches_attempted,
  CAST(sum(searches_successful) AS BIGINT) AS searches_successful, CAST(sum(total_jobs_found) AS BIGINT) AS total_jobs_found,
  CAST(sum(error_count) AS BIGINT) AS error_count, bool_or(blocked) AS blocked,
  arg_min(blocked_at_term, batch) FILTER (WHERE blocked_at_term IS NOT NULL) AS blocked_at_term,
  CASE WHEN sum(searches_attempted) > 0 THEN round(sum(searches_successful) / sum(searches_attempted) * 100, 1) ELSE 0.0 END AS success_rate
FROM per_batch GROUP BY run_id, site""")
def merge_run_stats(spark, d):
    return mg.merge_site_stats(at.site_stats(att(spark, d), ("batch", "run_id", "site")), ("run_id", "site"))


@query("merge_count_maps", "E18", A + """SELECT coalesce(error_type, 'unknown') AS key, CAST(count(*) AS BIGINT) AS n
FROM attempts WHERE NOT success GROUP BY 1 ORDER BY n DESC, key""")
def merge_count_maps(spark, d):
    # one map of counters a batch, as the batches report them
    failed = att(spark, d).filter("NOT success").groupBy("batch", F.coalesce("error_type", F.lit("unknown")).alias("key")).agg(F.count("*").alias("n"))
    maps = failed.groupBy("batch").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("error_summary"))
    return mg.merge_count_maps(maps, "error_summary")


@query("merge_attempt_analytics", "E19", A + f"""SELECT s.*, b.batches FROM ({SITE_SUMMARY_SQL}) s
JOIN (SELECT site, CAST(count(DISTINCT batch) AS BIGINT) AS batches FROM attempts GROUP BY site) b USING (site)""")
def merge_attempt_analytics(spark, d):
    # the batches' states are written as artifacts, read back and merged; no attempt is read again
    root = work_dir(spark, "states")
    mg.attempt_state(att(spark, d), ("batch",)).write.partitionBy("batch").json(f"{root}/attempt_state")
    return mg.merge_attempt_analytics(spark.read.schema(mg.STATE + ", batch bigint").json(f"{root}/attempt_state"))


R = probe_rules()


@query("run_stats", "E5", ov.with_(ov.ATTEMPTS, ov.POSTINGS, ov.scored_sql(R)) + f"""SELECT '{RUN_ID}' AS run_id, *,
  CASE WHEN search_terms_total > 0 THEN round(search_terms_completed / search_terms_total * 100, 1) ELSE 0.0 END AS completion_rate,
  CASE WHEN total_jobs_raw > 0 THEN round((1 - total_jobs_filtered / total_jobs_raw) * 100, 1) ELSE 0.0 END AS filter_rate
FROM (SELECT CAST((SELECT count(DISTINCT user_id % 53) FROM events) AS BIGINT) AS search_terms_total, CAST(count(DISTINCT search_term) AS BIGINT) AS search_terms_completed,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_time FROM attempts),
 (SELECT CAST(count(*) AS BIGINT) AS total_jobs_raw, CAST(count_if(qualified) AS BIGINT) AS total_jobs_filtered FROM scored),
 (SELECT CAST(count(DISTINCT company) AS BIGINT) AS unique_companies FROM scored WHERE qualified AND company IS NOT NULL AND company <> '')""")
def run_stats(spark, d):
    s = sc.score_postings(b.postings(spark, d), R)
    leads = ld.process_leads(sc.qualified_postings(s), R, RUN_DATE)
    return rs.run_stats(att(spark, d), b.planned_terms(spark, d), s, leads, RUN_ID)


@query("session_totals", "E25", A + """SELECT strftime(ts, '%Y-%m-%d') AS session_id, CAST(count(*) AS BIGINT) AS searches,
  CAST(count_if(success) AS BIGINT) AS ok, CAST(count_if(NOT success) AS BIGINT) AS failed, CAST(sum(jobs_found) AS BIGINT) AS jobs
FROM attempts GROUP BY 1""")
def session_totals(spark, d):
    return at.session_totals(att(spark, d))


@query("description_fill_rate", "E26", ov.with_(ov.POSTINGS) + """SELECT search_term, CAST(count(*) AS BIGINT) AS postings,
  CAST(sum(CASE WHEN length(description) > 50 THEN 1 ELSE 0 END) AS BIGINT) AS filled,
  CASE WHEN count(*) > 0 THEN round(sum(CASE WHEN length(description) > 50 THEN 1 ELSE 0 END) / count(*) * 100, 1) ELSE 0.0 END AS fill_rate
FROM postings GROUP BY search_term""")
def description_fill_rate(spark, d):
    return at.description_fill_rate(b.postings(spark, d))


@query("site_throughput", "E27", A + """SELECT site, CAST(sum(jobs_found) AS BIGINT) AS jobs, CAST(sum(duration_ms) AS BIGINT) AS duration_ms,
  CASE WHEN sum(duration_ms) > 0 THEN round(sum(jobs_found) / (sum(duration_ms) / 1000.0), 3) ELSE 0.0 END AS jobs_per_second
FROM attempts GROUP BY site""")
def site_throughput(spark, d):
    return at.site_throughput(att(spark, d))


@query("selector_performance", "E29", A + """SELECT site, selector, CAST(count(*) AS BIGINT) AS tried,
  CAST(count_if(coalesce(selector = selector_matched, FALSE)) AS BIGINT) AS matched
FROM (SELECT site, selector_matched, unnest(selectors_tried) AS selector FROM attempts) GROUP BY site, selector""")
def selector_performance(spark, d):
    return at.selector_performance(att(spark, d))


@query("postings_per_term", "E30", ov.with_(ov.ATTEMPTS, ov.POSTINGS) + """SELECT *, CASE WHEN avg(postings) OVER () >= 16 THEN 'ok' WHEN avg(postings) OVER () > 0 THEN 'warning' ELSE 'failed' END AS status,
  round(avg(postings) OVER (), 1) AS avg_postings FROM (
SELECT t.search_term, CAST(coalesce(c.n, 0) AS BIGINT) AS postings
FROM (SELECT DISTINCT search_term FROM attempts) t
LEFT JOIN (SELECT search_term, count(*) AS n FROM postings GROUP BY search_term) c USING (search_term))""")
def postings_per_term(spark, d):
    return at.postings_per_term(att(spark, d), b.postings(spark, d), expected=20)


@query("search_consistency", "E31", A + """SELECT site, searches, avg_ms, min_ms, max_ms, CAST(max_ms - min_ms AS BIGINT) AS spread_ms,
  avg_fill, min_fill, max_fill, CAST(max_fill - min_fill AS BIGINT) AS fill_range,
  CASE WHEN (max_ms - min_ms) / avg_ms < 0.3 THEN 'consistent' WHEN (max_ms - min_ms) / avg_ms < 0.5 THEN 'moderate' ELSE 'variable' END AS timing_rating,
  CASE WHEN all_filled THEN 'reliable' WHEN avg_fill >= 60 THEN 'mostly_reliable' ELSE 'unreliable' END AS reliability
FROM (SELECT site, CAST(count(*) AS BIGINT) AS searches, round(avg(duration_ms), 1) AS avg_ms, CAST(min(duration_ms) AS BIGINT) AS min_ms,
  CAST(max(duration_ms) AS BIGINT) AS max_ms, round(avg(jobs_found), 1) AS avg_fill, CAST(min(jobs_found) AS BIGINT) AS min_fill, CAST(max(jobs_found) AS BIGINT) AS max_fill, bool_and(jobs_found >= 60) AS all_filled
  FROM attempts WHERE success GROUP BY site)""")
def search_consistency(spark, d):
    return at.search_consistency(att(spark, d))


@query("slowdown_check", "E32", A + """SELECT run_id, site, search_term, CAST(first_ms AS BIGINT) AS first_ms, later_avg_ms,
  coalesce(later_avg_ms > 2.0 * first_ms, FALSE) AS throttled
FROM (SELECT run_id, site, search_term, arg_min(duration_ms, seq) AS first_ms,
  CASE WHEN count(*) > 1 THEN round((sum(duration_ms) - arg_min(duration_ms, seq)) / (count(*) - 1), 1) END AS later_avg_ms
  FROM attempts GROUP BY run_id, site, search_term)""")
def slowdown_check(spark, d):
    return at.slowdown_check(att(spark, d))


@query("variant_comparison", "E33", A + """SELECT variant, attempts, success_rate, avg_ms,
  row_number() OVER (ORDER BY success_rate DESC, first_seq) = 1 AS is_best
FROM (SELECT site AS variant, CAST(count(*) AS BIGINT) AS attempts,
  CASE WHEN count(*) > 0 THEN round(count_if(success) / count(*) * 100, 1) ELSE 0.0 END AS success_rate,
  round(avg(duration_ms), 1) AS avg_ms, min(seq) AS first_seq FROM attempts GROUP BY site)""")
def variant_comparison(spark, d):
    return at.variant_comparison(att(spark, d))


@query("health_alerts", "E34", ov.with_(ov.ATTEMPTS, PAIRS) + """SELECT site, alert FROM (
  SELECT s.site, unnest([
    CASE WHEN s.total_jobs / s.total_attempts < 50 THEN 'low_yield' END,
    CASE WHEN s.success_rate < 80 THEN 'low_success' END,
    CASE WHEN s.cloudflare_encounters > 0 AND s.cloudflare_solved / s.cloudflare_encounters * 100 < 70 THEN 'challenge_failures' END,
    CASE WHEN b.blocked THEN 'blocked' END]) AS alert
  FROM (""" + SITE_SUMMARY_SQL + """) s JOIN (SELECT site, bool_or(was_blocked) AS blocked FROM pairs GROUP BY site) b USING (site))
WHERE alert IS NOT NULL""")
def health_alerts(spark, d):
    return at.health_alerts(att(spark, d))


@query("retry_number", "F5", A + """SELECT seq, run_id, search_term, site,
  CAST((row_number() OVER (PARTITION BY run_id, search_term, site, ended ORDER BY seq) - 1) % 2 AS BIGINT) AS retry_number
FROM (SELECT *, coalesce(sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (
  PARTITION BY run_id, search_term, site ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ended FROM attempts)""")
def retry_number(spark, d):
    return at.retry_number(att(spark, d))


@query("circuit_breaker", "F6", A + """SELECT seq, run_id, site, coalesce(seq > (SELECT min(seq) FROM attempts b
  WHERE b.run_id = a.run_id AND b.site = a.site AND b.error_type = 'blocked'), FALSE) AS skipped
FROM attempts a""")
def circuit_breaker(spark, d):
    return at.circuit_breaker(att(spark, d))


@query("failure_streak", "F7", A + """SELECT site, CAST(max(streak) AS BIGINT) AS longest_streak, min(CASE WHEN streak >= 3 THEN seq END) AS cut_seq FROM (
  SELECT site, seq, row_number() OVER (PARTITION BY site, island ORDER BY seq) AS streak FROM (
    SELECT site, seq, success, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY site ORDER BY seq) AS island FROM attempts)
  WHERE NOT success) GROUP BY site""")
def failure_streak(spark, d):
    return at.failure_streak(att(spark, d))


@query("description_quota", "F9", ov.with_(ov.POSTINGS) + """SELECT seq, search_term, coalesce(sum(CASE WHEN length(description) > 0 THEN 1 ELSE 0 END) OVER (
  PARTITION BY search_term ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 10 AS gets_description FROM postings""")
def description_quota(spark, d):
    return at.description_quota(b.postings(spark, d), 10)


@query("sample_per_term", "F10", ov.with_(ov.POSTINGS) + """SELECT seq, search_term, title, CAST(rn AS BIGINT) AS rn FROM (
  SELECT seq, search_term, title, row_number() OVER (PARTITION BY search_term ORDER BY seq) AS rn FROM postings) WHERE rn <= 2""")
def sample_per_term(spark, d):
    return at.sample_per_term(b.postings(spark, d), 2)




@query("distinct_sites", "G7", A + """SELECT search_term, string_agg(DISTINCT site, ',' ORDER BY site) AS sites FROM attempts GROUP BY search_term""")
def distinct_sites(spark, d):
    a = att(spark, d)
    return a.groupBy("search_term").agg(F.array_join(F.array_sort(F.collect_set("site")), ",").alias("sites"))


PHASES = ov.with_(ov.ATTEMPTS, """s AS (
  SELECT run_id, search_term, site, arg_min(duration_ms, seq) AS first_ms, sum(duration_ms) AS all_ms
  FROM attempts GROUP BY run_id, search_term, site)""")


@query("phase_breakdown", "E28", PHASES + """SELECT phase, round(avg(ms), 1) AS avg_ms,
  CASE WHEN sum(sum(ms)) OVER () > 0 THEN round(sum(ms) / sum(sum(ms)) OVER () * 100, 1) ELSE 0.0 END AS share_pct
FROM (SELECT 'first_try_ms' AS phase, CAST(first_ms AS DOUBLE) AS ms FROM s
      UNION ALL SELECT 'retries_ms', CAST(all_ms - first_ms AS DOUBLE) FROM s)
GROUP BY phase""")
def phase_breakdown(spark, d):
    return at.phase_breakdown(at.search_phases(att(spark, d)), ["first_try_ms", "retries_ms"])


@query("term_failure_streak", "F7", ov.with_(ov.ATTEMPTS, """terms AS (
  SELECT run_id, search_term, min(seq) AS seq, coalesce(bool_or(success AND jobs_found > 0), FALSE) AS has_result
  FROM attempts GROUP BY run_id, search_term)""", """isl AS (
  SELECT run_id, seq, has_result, sum(CASE WHEN has_result THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq) AS island FROM terms)""",
    """st AS (
  SELECT run_id, seq, row_number() OVER (PARTITION BY run_id, island ORDER BY seq) AS streak FROM isl WHERE NOT has_result)""")
    + """SELECT r.run_id, CAST(r.terms AS BIGINT) AS terms, CAST(coalesce(s.longest, 0) AS BIGINT) AS longest_streak, s.cut_seq
FROM (SELECT run_id, count(*) AS terms FROM terms GROUP BY run_id) r
LEFT JOIN (SELECT run_id, max(streak) AS longest, min(CASE WHEN streak >= 3 THEN seq END) AS cut_seq FROM st GROUP BY run_id) s
USING (run_id)""")
def term_failure_streak(spark, d):
    return at.term_failure_streak(att(spark, d))


@query("run_progress", "E5", ov.with_(ov.ATTEMPTS, """terms AS (
  SELECT run_id, search_term, min(seq) AS seq, coalesce(bool_or(success AND jobs_found > 0), FALSE) AS has_result
  FROM attempts GROUP BY run_id, search_term)""", """isl AS (
  SELECT run_id, seq, has_result, sum(CASE WHEN has_result THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq) AS island FROM terms)""",
    """st AS (
  SELECT run_id, seq, row_number() OVER (PARTITION BY run_id, island ORDER BY seq) AS streak FROM isl WHERE NOT has_result)""",
    """cuts AS (SELECT run_id, min(CASE WHEN streak >= 3 THEN seq END) AS cut_seq FROM st GROUP BY run_id)""")
    + """SELECT p.run_id, CAST(count(*) AS BIGINT) AS search_terms_total,
  CAST(count_if(t.seq IS NOT NULL AND (c.cut_seq IS NULL OR t.seq <= c.cut_seq)) AS BIGINT) AS search_terms_completed,
  min(a.start_time) AS start_time, min(a.end_time) AS end_time,
  CASE WHEN count(*) > 0 THEN round(count_if(t.seq IS NOT NULL AND (c.cut_seq IS NULL OR t.seq <= c.cut_seq)) / count(*) * 100, 1) ELSE 0.0 END AS completion_rate
FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS run_id, 'term_' || (user_id % 53) AS search_term FROM events) p
LEFT JOIN terms t USING (run_id, search_term) LEFT JOIN cuts c USING (run_id)
JOIN (SELECT run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_time
      FROM attempts GROUP BY run_id) a USING (run_id)
GROUP BY p.run_id""")
def run_progress(spark, d):
    return at.run_progress(att(spark, d), b.planned_terms(spark, d))


@query("merge_run_report", "E17", ov.with_(ov.ATTEMPTS, ov.POSTINGS, ov.scored_sql(R), """halves AS (
  SELECT h, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time, strftime(end_ts, '%Y-%m-%d %H:%M:%S') AS end_time, terms, sites, raw, kept, blocked, companies FROM
    (SELECT batch % 2 AS h, min(ts) AS start_ts, max(ts) AS end_ts, count(DISTINCT search_term) AS terms,
       list(DISTINCT site) FILTER (WHERE error_type = 'blocked') AS sites FROM attempts GROUP BY 1)
    JOIN (SELECT batch % 2 AS h, count(*) AS raw, count_if(qualified) AS kept, count_if(company_score < 0) AS blocked,
       count(DISTINCT CASE WHEN qualified AND company <> '' THEN company END) AS companies FROM scored GROUP BY 1) USING (h))""") + """
SELECT 'r0' AS run_id, string_agg(CAST(h AS VARCHAR), ',' ORDER BY h) AS batches_processed, CAST(count(*) AS BIGINT) AS total_batches,
  min(start_time) AS start_time, max(end_time) AS end_time, CAST(sum(terms) AS BIGINT) AS search_terms_total, CAST(sum(terms) AS BIGINT) AS search_terms_completed,
  CAST(sum(raw) AS BIGINT) AS total_jobs_raw, CAST(sum(kept) AS BIGINT) AS total_jobs_filtered, CAST(sum(companies) AS BIGINT) AS unique_companies,
  CAST(sum(raw) AS BIGINT) AS total_processed, CAST(sum(kept) AS BIGINT) AS qualified, CAST(sum(raw) - sum(kept) AS BIGINT) AS rejected,
  CAST(sum(blocked) AS BIGINT) AS company_blocked,
  coalesce(array_to_string(list_sort(list_distinct(flatten(list(sites)))), ','), '') AS blocked_sites, 100.0::DOUBLE AS completion_rate,
  round((1 - sum(kept) / sum(raw)) * 100, 1) AS filter_rate, round(sum(kept) / sum(raw) * 100, 2) AS pass_rate
FROM halves""")
def merge_run_report(spark, d):
    # two batches of one run write their reports; the merge reads nothing else
    root = work_dir(spark, "run")
    postings, attempts = sc.score_postings(b.postings(spark, d), R), att(spark, d)
    for half in range(2):
        scored, tries = postings.filter(F.col("batch") % 2 == half), attempts.filter(F.col("batch") % 2 == half)
        companies = scored.filter("qualified AND company <> ''").select("company").distinct()
        write_run_reports(scored, tries, rs.run_stats(tries, tries, scored, companies, RUN_ID), root, RUN_ID, half)
    return merge_batches(spark, root, RUN_ID)["run"]
