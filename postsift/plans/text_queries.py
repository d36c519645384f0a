"""Registered queries for the scalar functions (B1-B27) over the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import scoring as sc
from ..sources import bindings as b
from ..sources import files as fs
from . import oracle_views as ov
from .leads_queries import LEAD_SELECT, WL, leads
from .page_queries import _title_case_sql
from .probe_rules import probe_rules
from .registry import query

R = probe_rules()
A = ov.with_(ov.ATTEMPTS)
P = ov.with_(ov.POSTINGS)
FORMULA_START = ("=", "+", "-", "@", "\t", "\r", "a")


@query("mask_credentials", "B1", A + f"""SELECT seq, {ov.MASK_SQL.format(x='error_raw')} AS masked FROM attempts WHERE NOT success""")
def mask_credentials(spark, d):
    a = b.attempts(spark, d).filter(~F.col("success"))
    return a.select("seq", tx.mask_credentials("error_raw").alias("masked"))


def _cell(seq="seq", title="title"):
    return F.concat(F.element_at(F.array(*[F.lit(x) for x in FORMULA_START]), (F.col(seq) % 7 + 1).cast("int")),
                    F.substring(title, 1, 10))


_CELL_SQL = f"{ov.sql_list(FORMULA_START)}[seq % 7 + 1] || substr(title, 1, 10)"


@query("sanitize_cell", "B2", P + f"""SELECT seq, CASE WHEN substr(c, 1, 1) IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || c ELSE c END AS cell
FROM (SELECT seq, {_CELL_SQL} AS c FROM postings)""")
def sanitize_cell(spark, d):
    p = b.postings(spark, d)
    return p.select("seq", tx.sanitize_cell(_cell()).alias("cell"))


def _san(c):
    return f"CASE WHEN substr({c}, 1, 1) IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || {c} ELSE {c} END AS {c}"


_LEAD_STRS = [c for c in LEAD_SELECT.split(", ") if c != "confidence_score"]


@query("sanitize_frame", "B3", WL + "SELECT " + ", ".join(_san(c) for c in _LEAD_STRS) + ", confidence_score FROM leads")
def sanitize_frame(spark, d):
    return fs.sanitize_frame(leads(spark, d))


@query("truncate_text", "B4", P + """SELECT seq, substr(description, 1, 500) AS cut500, substr(description, 1, 100) AS cut100,
  substr(description, 1, 2000) AS cut2000, substr(description, 1, 5000) AS cut5000, substr(description, 1, 200) AS cut200,
  substr(company, 1, 20) AS cut20 FROM postings""")
def truncate_text(spark, d):
    p = b.postings(spark, d)
    return p.select("seq", *[tx.truncate_text(c, n).alias(f"cut{n}") for c, n in
                             (("description", 500), ("description", 100), ("description", 2000), ("description", 5000),
                              ("description", 200), ("company", 20))])


@query("clean_company", "B5", P + f"SELECT seq, {ov.clean_company_sql('company')} AS clean FROM postings")
def clean_company(spark, d):
    return b.postings(spark, d).select("seq", tx.clean_company("company").alias("clean"))


@query("guess_domain", "B6", ov.with_(ov.CANDIDATES) + f"""SELECT kind, seq, {ov.guess_domain_sql('company')} AS domain,
  {ov.guess_domain_sql("company || ' Inc.'")} AS domain_suffixed FROM candidates""")
def guess_domain(spark, d):
    c = b.candidates(spark, d)
    return c.select("kind", "seq", tx.guess_domain("company").alias("domain"),
                    tx.guess_domain(F.concat("company", F.lit(" Inc."))).alias("domain_suffixed"))


_PREFIXES = (" www.", "WWW.", "", "w.w", "ww")


@query("normalize_domain", "B7", ov.with_(ov.CANDIDATES) + f"""SELECT kind, seq,
  {ov.normalize_domain_sql(ov.sql_list(_PREFIXES) + '[seq % 5 + 1] || domain')} AS domain FROM candidates""")
def normalize_domain(spark, d):
    c = b.candidates(spark, d)
    pre = F.element_at(F.array(*[F.lit(x) for x in _PREFIXES]), (F.col("seq") % 5 + 1).cast("int"))
    return c.select("kind", "seq", tx.normalize_domain(F.concat(pre, F.col("domain"))).alias("domain"))


@query("search_url_managers", "B8", WL + "SELECT company, linkedin_managers FROM leads")
def search_url_managers(spark, d):
    return leads(spark, d).select("company", "linkedin_managers")


@query("search_url_role", "B9", P + f"SELECT seq, {ov.url_role_sql('company', 'title')} AS linkedin_role FROM postings")
def search_url_role(spark, d):
    return b.postings(spark, d).select("seq", tx.search_url_role("company", "title").alias("linkedin_role"))


@query("search_url_hiring", "B10", P + f"SELECT seq, {ov.url_hiring_sql('company')} AS linkedin_hiring FROM postings")
def search_url_hiring(spark, d):
    return b.postings(spark, d).select("seq", tx.search_url_hiring("company").alias("linkedin_hiring"))


_KW = R.template_keywords()


@query("search_url_enduser", "B11", P + f"SELECT seq, {ov.url_enduser_sql('company', _KW)} AS google_enduser FROM postings")
def search_url_enduser(spark, d):
    return b.postings(spark, d).select("seq", tx.search_url_enduser("company", _KW).alias("google_enduser"))


_CLASSES = ("ReadTimeout", "ConnectionError", "HTTPError", "ValueError")


@query("classify_error", "B13", A + f"""SELECT seq, CASE
  WHEN {ov.any_sql('lower(error_raw)', tx.RATE_LIMIT_WORDS)} THEN 'rate_limit'
  WHEN {ov.any_sql('lower(error_raw)', tx.BLOCKED_WORDS)} THEN 'blocked'
  WHEN {ov.any_sql('lower(error_raw)', tx.TIMEOUT_WORDS)} OR contains(lower(cls), 'timeout') THEN 'timeout'
  WHEN {ov.any_sql('lower(error_raw)', tx.CONNECTION_WORDS)} OR contains(lower(cls), 'connection') THEN 'connection'
  ELSE 'unknown' END AS error_type
FROM (SELECT seq, error_raw, {ov.sql_list(_CLASSES)}[seq % 4 + 1] AS cls FROM attempts WHERE NOT success)""")
def classify_error(spark, d):
    a = b.attempts(spark, d).filter(~F.col("success"))
    cls = F.element_at(F.array(*[F.lit(x) for x in _CLASSES]), (F.col("seq") % 4 + 1).cast("int"))
    return a.select("seq", tx.classify_error("error_raw", cls).alias("error_type"))


@query("error_status_code", "B14", A + """SELECT seq, exception_class, CAST(nullif(regexp_extract(error_raw, '\\b([3-5]\\d{2})\\b', 1), '') AS INTEGER) AS from_text,
  coalesce(CAST(CASE WHEN seq % 2 = 0 THEN http_status END AS INTEGER), CAST(nullif(regexp_extract(error_raw, '\\b([3-5]\\d{2})\\b', 1), '') AS INTEGER)) AS status_code
FROM attempts WHERE NOT success""")
def error_status_code(spark, d):
    a = b.attempts(spark, d).filter(~F.col("success"))
    explicit = F.when(F.col("seq") % 2 == 0, F.col("http_status"))
    context = tx.error_context("exception_class", "error_raw", explicit)
    return a.select("seq", tx.error_status_code("error_raw").alias("from_text"), context.alias("c")).select("seq", "from_text", "c.*")


@query("challenge_flag", "B15", A + f"""SELECT seq, {ov.any_sql('lower(error_raw)', tx.CHALLENGE_WORDS_HTTP)} AS detected_http,
  {ov.any_sql('lower(error_raw)', tx.CHALLENGE_WORDS_BROWSER)} AS detected_browser,
  CASE WHEN {ov.any_sql('lower(error_raw)', tx.CHALLENGE_WORDS_HTTP)} THEN FALSE END AS solved
FROM attempts WHERE NOT success""")
def challenge_flag(spark, d):
    a = b.attempts(spark, d).filter(~F.col("success"))
    det = tx.challenge_flag("error_raw")
    return a.select("seq", det.alias("detected_http"), tx.challenge_flag("error_raw", browser=True).alias("detected_browser"),
                    F.when(det, F.lit(False)).alias("solved"))


@query("confidence_score", "B16", ov.with_(ov.POSTINGS, ov.scored_sql(R)) + """SELECT seq,
  CAST(CASE WHEN qualified THEN least(100.0, score) END AS DOUBLE) AS confidence_score FROM scored""")
def confidence_score(spark, d):
    s = sc.score_postings(b.postings(spark, d), R)
    return s.select("seq", tx.confidence_score("score", "qualified").alias("confidence_score"))


@query("rate_pct", "B17", A + """SELECT site, CASE WHEN count(*) > 0 THEN round(count_if(success) / count(*) * 100, 1) ELSE 0.0 END AS rate1,
  CASE WHEN count(*) > 0 THEN round(count_if(success) / count(*) * 100, 2) ELSE 0.0 END AS rate2,
  CASE WHEN count_if(jobs_found > 1000) > 0 THEN round(count(*) / count_if(jobs_found > 1000) * 100, 1) ELSE 0.0 END AS guarded
FROM attempts GROUP BY site""")
def rate_pct(spark, d):
    g = b.attempts(spark, d).groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.count_if("success").alias("ok"),
                                                   F.count_if(F.col("jobs_found") > 1000).alias("big"))
    return g.select("site", tx.rate_pct("ok", "n", 1).alias("rate1"), tx.rate_pct("ok", "n", 2).alias("rate2"),
                    tx.rate_pct("n", "big", 1).alias("guarded"))


@query("job_id_from_url", "B19", P + """SELECT seq, regexp_extract(job_url, '/jobs/(\\d+)/', 1) AS job_id,
  regexp_extract(location, '/jobs/(\\d+)/', 1) AS none_id FROM postings""")
def job_id_from_url(spark, d):
    p = b.postings(spark, d)
    return p.select("seq", tx.job_id_from_url("job_url").alias("job_id"), tx.job_id_from_url("location").alias("none_id"))


@query("url_from_card_id", "B20", P + """SELECT seq, coalesce(nullif(CASE WHEN seq % 3 = 0 THEN '' ELSE job_url END, ''),
  CASE WHEN starts_with('job-card-' || seq, 'job-card-') THEN 'https://jobs.example.com/view/' || substr('job-card-' || seq, 10) END) AS url
FROM postings""")
def url_from_card_id(spark, d):
    p = b.postings(spark, d)
    link = F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.col("job_url"))
    card = F.concat(F.lit("job-card-"), F.col("seq").cast("string"))
    return p.select("seq", tx.url_from_card_id(link, card, "job-card-", "https://jobs.example.com/view/").alias("url"))


@query("clean_location", "B21", P + """SELECT seq, trim(split_part(location || ' ... ' || title, '...', 1)) AS location FROM postings""")
def clean_location(spark, d):
    p = b.postings(spark, d)
    return p.select("seq", tx.clean_location(F.concat("location", F.lit(" ... "), "title")).alias("location"))


@query("employment_type", "B22", ov.with_("ev AS (SELECT event_id, upper(event_type) || '_TIME' AS raw FROM events)") + f"""SELECT event_id,
  {_title_case_sql('raw')} AS employment_type FROM ev""")
def employment_type(spark, d):
    e = b.read_table(spark, d, "events").select("event_id", F.concat(F.upper("event_type"), F.lit("_TIME")).alias("raw"))
    return e.select("event_id", tx.employment_type("raw").alias("employment_type"))


@query("salary_text", "B23", """SELECT event_id, CASE WHEN contains(s, '$') THEN s END AS salary FROM (
  SELECT event_id, CASE WHEN event_type = 'purchase' THEN '$' || CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR)
    ELSE CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR) || ' EUR' END AS s FROM events)""")
def salary_text(spark, d):
    e = b.read_table(spark, d, "events")
    amount = F.floor(F.col("value") * 1000).cast("bigint").cast("string")
    s = F.when(F.col("event_type") == "purchase", F.concat(F.lit("$"), amount)).otherwise(F.concat(amount, F.lit(" EUR")))
    return e.select("event_id", tx.salary_text(s).alias("salary"))


@query("day_bucket", "B24", A + "SELECT seq, strftime(ts, '%Y-%m-%d') AS day FROM attempts")
def day_bucket(spark, d):
    return b.attempts(spark, d).select("seq", tx.day_bucket("ts").alias("day"))


@query("text_length_gate", "B27", P + """SELECT seq, CASE WHEN length(description) > 50 THEN description END AS over50,
  CASE WHEN length(description) > 100 THEN description END AS over100 FROM postings""")
def text_length_gate(spark, d):
    p = b.postings(spark, d)
    return p.select("seq", tx.text_length_gate("description", 50).alias("over50"), tx.text_length_gate("description", 100).alias("over100"))
