"""Registered queries for lead assembly, filter statistics and batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import leads as ld
from ..operators import ordering as od
from ..operators import runstats as rs
from ..operators import scoring as sc
from ..session import stored
from ..sources import bindings as b
from ..sources import state_store as ss
from ..streaming.streams import work_dir
from . import oracle_views as ov
from .probe_rules import probe_rules
from .registry import RUN_DATE, query

R = probe_rules()
W = ov.with_(ov.POSTINGS, ov.scored_sql(R))


def scored(spark, d):
    return sc.score_postings(b.postings(spark, d), R)


def leads(spark, d):
    return ld.process_leads(sc.qualified_postings(scored(spark, d)), R, RUN_DATE)


_KW = R.template_keywords()
LEADS_CTE = f"""leads0 AS (
  SELECT * FROM (
    SELECT seq, company, title, location, job_url, description,
      CASE WHEN qualified THEN least(100.0, score) END AS confidence_score,
      row_number() OVER (PARTITION BY company ORDER BY seq) AS rn
    FROM scored WHERE qualified AND company IS NOT NULL AND company <> '') WHERE rn = 1),
leads AS (
  SELECT seq, company, {ov.guess_domain_sql('company')} AS domain, title AS job_title, location,
    CAST(confidence_score AS DOUBLE) AS confidence_score, job_url AS posting_url, description,
    {ov.url_managers_sql('company')} AS linkedin_managers,
    {ov.url_hiring_sql('company')} AS linkedin_hiring,
    {ov.url_role_sql('company', 'title')} AS linkedin_role,
    {ov.url_enduser_sql('company', _KW)} AS google_enduser,
    '{RUN_DATE}' AS date_scraped
  FROM leads0)"""
WL = ov.with_(ov.POSTINGS, ov.scored_sql(R), LEADS_CTE)
LEAD_SELECT = ", ".join(ld.LEAD_COLUMNS)


@query("process_leads", "I1", WL + f"SELECT {LEAD_SELECT} FROM leads")
def process_leads(spark, d):
    return leads(spark, d)


@query("first_per_company", "F2", ov.with_(ov.POSTINGS) + """SELECT company, seq, title FROM (
  SELECT company, seq, title, row_number() OVER (PARTITION BY company ORDER BY seq) AS rn
  FROM postings WHERE company IS NOT NULL AND company <> '') WHERE rn = 1""")
def first_per_company(spark, d):
    p = b.postings(spark, d).filter(F.col("company").isNotNull() & (F.col("company") != "")).select("company", "seq", "title")
    return od.first_per_key(p, ["company"], "seq")


@query("rejected_postings", "C18", W + """SELECT seq, rn, printf('rejected_%03d_%s', rn, substr(coalesce(company, 'None'), 1, 20)) AS id,
  substr(coalesce(description, ''), 1, 2000) AS description, FALSE AS label, company, title,
  'Rejected: ' || rejection_category || ' (score: ' || CAST(score AS VARCHAR) || ')' AS notes
FROM (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM scored WHERE NOT qualified) WHERE rn <= 100""")
def rejected_postings(spark, d):
    return ld.rejected_postings(scored(spark, d), 100)


@query("rejected_sample", "G5", W + """SELECT seq, company, title, rejection_category, score, total AS total_rejected FROM (
  SELECT *, row_number() OVER (ORDER BY seq) AS rn, count(*) OVER () AS total FROM scored WHERE NOT qualified) WHERE rn <= 100""")
def rejected_sample(spark, d):
    return ld.rejected_sample(scored(spark, d), 100)


@query("preview", "G4", WL + f"SELECT {LEAD_SELECT} FROM leads ORDER BY seq LIMIT 10")
def preview(spark, d):
    full = ld.process_leads(sc.qualified_postings(scored(spark, d)), R, RUN_DATE, carry=["seq"])
    return full.orderBy("seq").limit(10).drop("seq")


@query("filter_stats", "E1", W + """SELECT count(*) AS total_processed, CAST(count_if(qualified) AS BIGINT) AS qualified,
  CAST(count_if(NOT qualified) AS BIGINT) AS rejected, CAST(count_if(company_score < 0) AS BIGINT) AS company_blocked,
  CASE WHEN count(*) > 0 THEN round(count_if(qualified) / count(*) * 100, 2) ELSE 0.0 END AS pass_rate FROM scored""")
def filter_stats(spark, d):
    return rs.filter_stats(scored(spark, d))


@query("rejection_breakdown", "E2", W + """SELECT rejection_category, count(*) AS n FROM scored WHERE NOT qualified
GROUP BY rejection_category ORDER BY n DESC, min(seq) LIMIT 10""")
def rejection_breakdown(spark, d):
    return rs.rejection_breakdown(scored(spark, d), 10)


@query("tier_breakdown", "E3", W + "SELECT top_tier, count(*) AS n FROM scored WHERE qualified GROUP BY top_tier")
def tier_breakdown(spark, d):
    return rs.tier_breakdown(scored(spark, d))


@query("unique_companies", "E20", WL + """SELECT (SELECT count(DISTINCT company) FROM leads) AS unique_companies,
  (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(DISTINCT company) AS n FROM scored
     WHERE qualified AND company IS NOT NULL AND company <> '' GROUP BY batch)) AS summed_companies""")
def unique_companies(spark, d):
    return rs.unique_companies(scored(spark, d))


@query("batch_slice", "F1", ov.with_(ov.POSTINGS) + """SELECT seq, CAST(ntile(4) OVER (ORDER BY seq) - 1 AS INTEGER) AS batch FROM postings""")
def batch_slice(spark, d):
    return od.batch_slice(b.postings(spark, d).select("seq"), 4)


@query("lead_upsert", "I2", ov.with_(ov.POSTINGS, ov.scored_sql(R), f"""rows AS (
  SELECT company, title, row_number() OVER (PARTITION BY company, title ORDER BY batch, seq) AS nth, coalesce(trim(title), '') = '' AS bad FROM (
    SELECT *, row_number() OVER (PARTITION BY batch, company ORDER BY seq) AS rn
    FROM scored WHERE qualified AND company IS NOT NULL AND company <> '') WHERE rn = 1)""") + """SELECT
  CAST(count(*) FILTER (WHERE NOT bad AND nth = 1) AS BIGINT) AS inserted,
  CAST(count(*) FILTER (WHERE NOT bad AND nth > 1) AS BIGINT) AS duplicates_skipped,
  CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS errors FROM rows""")
def lead_upsert(spark, d):
    # the batches of a run go one after the other into one table; the last one is sent twice and reports the same again
    s = stored(sc.qualified_postings(scored(spark, d)).filter("company IS NOT NULL AND company <> ''")
               .select("batch", "company", "seq", "title", "location", "job_url", "score", "qualified"), "qualified")
    root, batches, total = work_dir(spark, "leads"), sorted(r[0] for r in s.select("batch").distinct().collect()), {}
    for k in [*batches, *batches[-1:]]:
        batch = ld.process_leads(s.filter(F.col("batch") == k), R, RUN_DATE, carry=["seq"])
        total[k] = ss.insert_leads(batch, root, f"batch{k}", n_buckets=4)
    names = ("inserted", "duplicates_skipped", "errors")
    return spark.createDataFrame([tuple(sum(t[n] for t in total.values()) for n in names)], ", ".join(f"{n} bigint" for n in names))


@query("attach_scores", "D1", W + """SELECT p.seq, p.company, s.score, s.qualified FROM postings p JOIN scored s ON s.posting_id = p.posting_id""")
def attach_scores(spark, d):
    # scores stored apart from the postings (a table in the shared folder) are attached back by key
    path = f"{work_dir(spark, 'scores')}/scored"
    scored(spark, d).select("posting_id", "score", "qualified").write.parquet(path)
    return b.postings(spark, d).select("seq", "posting_id", "company").join(spark.read.parquet(path), "posting_id").drop("posting_id")


@query("rejected_id", "B26", W + """SELECT seq, printf('rejected_%03d_%s', rn, substr(coalesce(company, 'None'), 1, 20)) AS id FROM (
  SELECT seq, company, row_number() OVER (ORDER BY seq) AS rn FROM scored WHERE NOT qualified)""")
def rejected_id(spark, d):
    # every rejected row numbered in arrival order (no export cap)
    return ld.rejected_ids(scored(spark, d)).select("seq", "id")


@query("top_k_counts", "G1", ov.with_(ov.POSTINGS) + """SELECT company, CAST(count(*) AS BIGINT) AS n FROM postings
WHERE company IS NOT NULL AND company <> '' GROUP BY company ORDER BY n DESC, min(seq) LIMIT 10""")
def top_k_counts(spark, d):
    p = b.postings(spark, d).filter(F.col("company").isNotNull() & (F.col("company") != ""))
    return rs.top_counts(p, "company", 10).withColumn("n", F.col("n").cast("bigint"))
