"""Registered queries for sources and sinks (A1, A3-A10).

Sink keys are round trips: the result is written under the session's
checkpoint folder (a fresh sub-folder per call) and read back with the
engine's own reader, so the check covers writer and reader together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators import attempts as at
from ..operators import leads as ld
from ..operators import merging as mg
from ..operators import pages as pg
from ..operators import runstats as rs
from ..operators import scoring as sc
from ..sources import bindings as b
from ..sources import files as fs
from ..sources import state_store as ss
from ..streaming.streams import work_dir
from . import oracle_views as ov
from .entrypoints import FILTER_MAPS, FILTER_STATS, RUN_STATS, write_run_reports
from .leads_queries import LEADS_CTE, leads
from .page_queries import LOCATION_SQL, cards_sql, html_to_text_sql
from .probe_rules import probe_rules
from .registry import RUN_ID, query
from .state_queries import SUBMITTED
from .telemetry_queries import PAIRS, _site_stats_sql

R = probe_rules()

_LD_SQL = """CASE WHEN json_valid(nullif(regexp_extract(html, '(?s)<script type="application/ld\\+json">(.*?)</script>', 1), ''))
    THEN json_extract_string(regexp_extract(html, '(?s)<script type="application/ld\\+json">(.*?)</script>', 1), '$.description') END"""
PAGE_POSTINGS = cards_sql("article") + f""", page_postings AS (
  SELECT page_id AS seq, CAST(card AS BIGINT) AS card, parts[1] AS title, coalesce(parts[2], '') AS company, {LOCATION_SQL} AS location, url AS job_url,
    coalesce(nullif({html_to_text_sql('ld')}, ''), CASE WHEN length(main) > 100 THEN main END, '') AS description
  FROM (SELECT *, CASE WHEN len(regexp_extract_all(html, '(?i)<article[\\s>]')) = 1 THEN {_LD_SQL} END AS ld, {html_to_text_sql("c")} AS main FROM cards)
  WHERE parts[1] IS NOT NULL)"""


@query("pages_to_postings", "A10", ov.with_(PAGE_POSTINGS) + "SELECT seq, card, title, company, location, job_url, description FROM page_postings")
def pages_to_postings(spark, d):
    return pg.pages_to_postings(b.pages(spark, d))


@query("union_postings", "A1", ov.with_(ov.POSTINGS, PAGE_POSTINGS) + """SELECT 'document' AS kind, seq, company, title, location, job_url FROM postings
UNION ALL SELECT 'page' AS kind, seq, company, title, location, CAST(NULL AS VARCHAR) AS job_url FROM page_postings""")
def union_postings(spark, d):
    docs = b.postings(spark, d).select(F.lit("document").alias("kind"), "seq", "company", "title", "location", "job_url")
    # the page frame has no link column: the union fills it with NULL
    pages = pg.pages_to_postings(b.pages(spark, d)).select(F.lit("page").alias("kind"), "seq", "company", "title", "location")
    return fs.union_postings([docs, pages])


@query("latest_export", "A5", ov.with_(ov.ATTEMPTS) + """SELECT seq, run_id, site FROM attempts WHERE run_id = (SELECT max(run_id) FROM attempts)""")
def latest_export(spark, d):
    return fs.latest_export(b.attempts(spark, d).select("seq", "run_id", "site"), "run_id")


_NAME_SQL = "'/artifacts/run_stats_' || replace(run_id, '-', '') || '_batch' || batch || '.json'"


@query("run_partition", "A8", ov.with_(ov.ATTEMPTS) + f"""SELECT source_file,
  regexp_extract(regexp_extract(source_file, '([^/]+)$', 1), '^[a-z_]+?_(\\d[^_]*(?:_\\d+)?)(?:_batch\\d+)?\\.json$', 1) AS run_id,
  CAST(nullif(regexp_extract(regexp_extract(source_file, '([^/]+)$', 1), '_batch(\\d+)\\.json$', 1), '') AS INTEGER) AS batch
FROM (SELECT DISTINCT {_NAME_SQL} AS source_file FROM attempts)""")
def run_partition(spark, d):
    a = b.attempts(spark, d)
    names = a.select(F.concat(F.lit("/artifacts/run_stats_"), F.regexp_replace("run_id", "-", ""), F.lit("_batch"),
                              F.col("batch").cast("string"), F.lit(".json")).alias("source_file")).distinct()
    run_id, batch = fs.run_partition("source_file")
    return names.select("source_file", run_id, batch)


@query("read_labelled", "A3", ov.with_(ov.POSTINGS, ov.LABELLED) + """SELECT CAST(seq AS VARCHAR) AS id, description, label
FROM labelled WHERE description IS NOT NULL""")
def read_labelled(spark, d):
    items = b.labelled_postings(spark, d).filter(F.col("description").isNotNull()).select(
        F.col("seq").cast("string").alias("id"), "description", "label", "company")
    path = work_dir(spark, "labelled") + "/items"
    items.write.json(path)
    return fs.read_labelled(spark, path, json_lines=True).select("id", "description", "label")


STATS_SCHEMA = T.StructType([
    T.StructField("site", T.StringType()), T.StructField("searches_attempted", T.LongType()),
    T.StructField("searches_successful", T.LongType()), T.StructField("total_jobs_found", T.LongType()),
    T.StructField("error_count", T.LongType()),
])


@query("read_run_artifacts", "A4", ov.with_(ov.ATTEMPTS, """bpairs AS (
  SELECT batch, search_term, site, coalesce(bool_or(success), FALSE) AS ok,
    sum(CASE WHEN success THEN jobs_found ELSE 0 END) AS jobs,
    coalesce(bool_or(error_type = 'blocked'), FALSE) AS was_blocked,
    min(CASE WHEN error_type = 'blocked' THEN seq END) AS block_seq
  FROM attempts GROUP BY batch, run_id, search_term, site)""") + """SELECT batch, site, searches_attempted, searches_successful, total_jobs_found, error_count
FROM (""" + _site_stats_sql("batch, site") + """ FROM bpairs GROUP BY batch, site)""")
def read_run_artifacts(spark, d):
    root = work_dir(spark, "artifacts")
    stats = at.site_stats(b.attempts(spark, d), ("batch", "site")).select("batch", *[f.name for f in STATS_SCHEMA.fields])
    stats.write.partitionBy("batch").json(f"{root}/run_stats")
    # one unreadable artifact next to the good ones: skipped, reported on the side
    spark.createDataFrame([("{not json",)], "value string").write.text(f"{root}/run_stats/batch=99")
    good, _bad = fs.read_run_artifacts(spark, root, "run_stats", STATS_SCHEMA, one_object_per_file=False)
    return good.select(F.regexp_extract("source_file", r"batch=(\d+)", 1).cast("bigint").alias("batch"),
                       *[f.name for f in STATS_SCHEMA.fields])


@query("write_leads_csv", "A6", ov.with_(ov.POSTINGS, ov.scored_sql(R), LEADS_CTE) + """SELECT company, domain,
  CASE WHEN substr(job_title, 1, 1) IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || job_title ELSE job_title END AS job_title FROM leads""")
def write_leads_csv(spark, d):
    root = work_dir(spark, "csv")
    path = fs.write_leads_csv(leads(spark, d), root, "r0", 0)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return back.select("company", "domain", "job_title")


@query("write_report_json", "A7", ov.with_(ov.ATTEMPTS, PAIRS) + """SELECT last_type AS error_type, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total_errors FROM pairs WHERE NOT ok AND NOT was_blocked GROUP BY last_type""")
def write_report_json(spark, d):
    root = work_dir(spark, "reports")
    path = fs.write_report_json(at.error_summary(b.attempts(spark, d)), root, "search_errors", "r0", skip_empty=True)
    if path is None:
        return spark.createDataFrame([], "error_type string, n bigint, total_errors bigint")
    return spark.read.schema("error_type string, n bigint, total_errors bigint").json(path)


@query("report_sinks", "A7", ov.with_(ov.ATTEMPTS, PAIRS, ov.POSTINGS, ov.scored_sql(R)) + """SELECT 'run_stats' AS sink, 'total_jobs_raw' AS key, CAST(count(*) AS BIGINT) AS n FROM scored
UNION ALL SELECT 'filter_stats', 'qualified', CAST(count_if(qualified) AS BIGINT) FROM scored
UNION ALL SELECT 'filter_maps', rejection_category, CAST(count(*) AS BIGINT) FROM scored WHERE NOT qualified GROUP BY rejection_category
UNION ALL SELECT 'attempt_state', site, CAST(count(*) AS BIGINT) FROM attempts GROUP BY site
UNION ALL SELECT 'search_errors', last_type, CAST(count(*) AS BIGINT) FROM pairs WHERE NOT ok AND NOT was_blocked GROUP BY last_type
UNION ALL SELECT 'rejected', id, rn FROM (SELECT row_number() OVER (ORDER BY seq) AS rn,
  printf('rejected_%03d_%s', row_number() OVER (ORDER BY seq), substr(coalesce(company, 'None'), 1, 20)) AS id FROM scored WHERE NOT qualified) WHERE rn <= 100""")
def report_sinks(spark, d):
    # all sinks of a run's reports: written, read back with a fixed schema, one figure or row each
    root = work_dir(spark, "sinks")
    scored, attempts = sc.score_postings(b.postings(spark, d), R), b.attempts(spark, d)
    companies = scored.filter("qualified AND company <> ''").select("company").distinct()
    write_run_reports(scored, attempts, rs.run_stats(attempts, attempts, scored, companies, RUN_ID), root, RUN_ID, 0)
    fs.write_report_json(at.search_errors(attempts), root, "search_errors", RUN_ID, 0, skip_empty=True)
    fs.write_report_json(ld.rejected_postings(scored, 100), root, "rejected", RUN_ID, 0)

    def back(kind, schema, key, n):
        return fs.read_batches(spark, root, kind, RUN_ID, schema)[0].select(F.lit(kind).alias("sink"), key.alias("key"), n.cast("bigint").alias("n"))

    def summed(df):
        return df.groupBy("sink", "key").agg(F.sum("n").alias("n"))

    maps = fs.read_batches(spark, root, "filter_maps", RUN_ID, FILTER_MAPS)[0]
    states = fs.read_batches(spark, root, "attempt_state", RUN_ID, mg.STATE)[0].filter("measure = 'tried'")
    return reduce(lambda x, y: x.unionByName(y), [
        back("run_stats", RUN_STATS, F.lit("total_jobs_raw"), F.col("total_jobs_raw")),
        back("filter_stats", FILTER_STATS, F.lit("qualified"), F.col("qualified")),
        maps.select(F.lit("filter_maps").alias("sink"), F.explode("rejection_reasons").alias("key", "n")),
        summed(states.select(F.lit("attempt_state").alias("sink"), F.col("site").alias("key"), "n")),
        summed(back("search_errors", "error_type string", F.col("error_type"), F.lit(1))),
        back("rejected", "rn bigint, id string", F.col("id"), F.col("rn")),
    ])


@query("state_tables", "A9", ov.with_(ov.SUBMISSIONS, SUBMITTED) + "SELECT domain, company, lead_id FROM submitted")
def state_tables(spark, d):
    root = work_dir(spark, "state")
    events = b.submissions(spark, d).withColumn("domain", tx.normalize_domain("domain"))
    # two sessions: every third submission, then all of them on top of the stored state
    ss.upsert(events.filter("seq % 3 = 0"), root, "submitted", n_buckets=8)
    ss.upsert(events, root, "submitted")
    return ss.read_state(spark, root, "submitted").select("domain", "company", "lead_id")
