"""Registered queries for the streaming operators.

Each runs the stream over the table's files with ``availableNow`` into the
checkpoint folder and returns the written result; a stream over the whole
table must equal the batch result, so the batch SQL is the oracle.
"""

from __future__ import annotations

from ..sources import bindings as b
from ..streaming import streams as ss
from . import oracle_views as ov
from .probe_rules import probe_rules
from .registry import RUN_ID, query

R = probe_rules()


@query("stream_score", "J1", ov.with_(ov.POSTINGS, ov.scored_sql(R)) + "SELECT seq, company, score, top_tier FROM scored WHERE qualified")
def stream_score(spark, d):
    src = b.postings_from(b.stream_table(spark, d, "documents"))
    out = ss.run_to_table(spark, ss.stream_score(src, R).select("seq", "company", "score", "top_tier"), "score")
    return spark.read.parquet(out)


@query("stream_new_companies", "J2", ov.with_(ov.POSTINGS) + """SELECT company, seq, title FROM (
  SELECT company, seq, title, row_number() OVER (PARTITION BY company ORDER BY seq) AS rn
  FROM postings WHERE company IS NOT NULL AND company <> '') WHERE rn = 1""")
def stream_new_companies(spark, d):
    src = b.postings_from(b.stream_table(spark, d, "documents")).select("company", "seq", "title")
    return ss.stream_new_companies(spark, src, ss.work_dir(spark, "new-companies"), RUN_ID)


@query("stream_site_health", "J3", ov.with_(ov.ATTEMPTS) + """SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, site,
  CAST(count(*) AS BIGINT) AS attempts, CAST(count_if(success) AS BIGINT) AS successes,
  round(count_if(success) / count(*) * 100, 1) AS success_rate, CAST(count_if(coalesce(error_type = 'blocked', FALSE)) AS BIGINT) AS blocks
FROM attempts GROUP BY 1, 2""")
def stream_site_health(spark, d):
    src = b.attempts_from(b.stream_table(spark, d, "events"))
    return ss.stream_site_health(spark, src)
