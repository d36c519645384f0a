"""Bindings of the engine's inputs to the driver's Parquet tables.

Every view is a pure projection (plus one key join for labels and
submissions) of a given table, so Catalyst prunes columns down to the scan
and the work grows with the tables. The same derivations are restated in SQL
in ``plans.oracle_views`` for the DuckDB check.

postings    <- documents        (seq = doc_id)
labelled    <- documents + labels
attempts    <- events           (seq = event_id)
pages       <- pages
submissions <- orders + customer   (state: submitted companies)
query_log   <- orders              (state: tried queries)
progress    <- supplier            (state: per-source progress entries)
candidates  <- customer            (companies to check against the state)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.rule_sql import sql_str

# --- fixed values of the bindings -----------------------------------------
COMPANY_SUFFIXES = ("", " LLC", " Inc.", " & Sons Co", " Corp")
SITES = ("board_a", "board_b", "board_c", "board_d")
# error texts by k % 6; the second one is the blocking message
ERROR_TEXTS = (
    "HTTP 429 Too Many Requests from https://bot:hunter2@proxy.example.com:8080/search",
    "403 Client Error: Forbidden - request blocked by cloudflare",
    "Read timed out (read timeout=30)",
    "Connection refused by remote host",
    "Bad gateway: upstream answered 502",
    "Unexpected page layout, no results container",
)
ERROR_STATUS = (429, 403, None, None, 502, None)
# exception classes by k % 6
ERROR_CLASSES = ("HTTPError", "HTTPError", "ReadTimeout", "ConnectionError", "HTTPError", "ValueError")
SELECTORS = ("div.job-card", "article.result", "li.listing", "ul.jobs li")
PROGRESS_KEYS = ("status", "last_page", "companies_submitted")
PROGRESS_STATUS = ("in_progress", "done")
N_TERMS = 40
N_PLANNED = 53
N_POSTING_TERMS = 37


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = 1000) -> DataFrame:
    """A table (one file or a folder of part files) as a streaming source, schema taken from the batch read."""
    reader = spark.readStream.schema(read_table(spark, sf_dir, name).schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # a pattern, since a stream takes a single file only through one; it also matches a folder
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def _pick(values, idx):
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in values]), idx))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return postings_from(d)


def _arr(values) -> str:
    return "array(" + ", ".join("CAST(NULL AS INT)" if v is None else (sql_str(v) if isinstance(v, str) else str(v)) for v in values) + ")"


def postings_from(d: DataFrame) -> DataFrame:
    """The postings projection of a documents frame (batch or streaming)."""
    return d.selectExpr(
        "doc_id AS seq",
        "doc_id AS posting_id",
        "CASE WHEN doc_id % 17 = 0 THEN CAST(NULL AS STRING) WHEN doc_id % 19 = 0 THEN '' "
        f"ELSE concat('Acme ', source, element_at({_arr(COMPANY_SUFFIXES)}, CAST(doc_id % 5 + 1 AS INT))) END AS company",
        "substring(text, 1, 40) AS title",
        "lang AS location",
        "concat('/jobs/', CAST(doc_id AS STRING), '/x') AS job_url",
        "CASE WHEN doc_id % 23 = 0 THEN CAST(NULL AS STRING) WHEN doc_id % 29 = 0 THEN '' ELSE text END AS description",
        "source AS site",
        f"concat('term_', CAST(doc_id % {N_POSTING_TERMS} AS STRING)) AS search_term",
        "doc_id % 4 AS batch",
    )


def labelled_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings that carry a label (inner join on the key; label = quality = 1)."""
    lab = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("seq"), (F.col("quality") == 1).alias("label"))
    return postings(spark, sf_dir).join(lab, "seq", "inner")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return attempts_from(e)


def attempts_from(e: DataFrame) -> DataFrame:
    """The attempts projection of an events frame (batch or streaming)."""
    k = e.selectExpr("event_id", "ts", "user_id", "event_type", "value", "CAST(get_json_object(props, '$.k') AS INT) AS k")
    raw = f"CASE WHEN event_type <> 'error' THEN CAST(NULL AS STRING) WHEN k IS NOT NULL THEN element_at({_arr(ERROR_TEXTS)}, CAST(k % 6 + 1 AS INT)) END"
    sel = f"CASE WHEN k IS NOT NULL THEN element_at({_arr(SELECTORS)}, CAST(k % 4 + 1 AS INT)) END"
    return k.selectExpr(
        "event_id AS seq",
        "ts",
        # one collection run per day: a search is (run_id, term, site) with its retries
        "date_format(ts, 'yyyy-MM-dd') AS run_id",
        f"concat('term_', CAST(user_id % {N_TERMS} AS STRING)) AS search_term",
        f"element_at({_arr(SITES)}, CAST(event_id % 4 + 1 AS INT)) AS site",
        "user_id % 4 AS batch",
        "event_type <> 'error' AS success",
        "CAST(CASE WHEN event_type <> 'error' THEN k ELSE 0 END AS BIGINT) AS jobs_found",
        "CAST(CASE WHEN k = 0 THEN 0 ELSE floor(value * 100) END AS BIGINT) AS duration_ms",
        f"CASE WHEN event_type <> 'error' THEN 200 WHEN k IS NOT NULL THEN element_at({_arr(ERROR_STATUS)}, CAST(k % 6 + 1 AS INT)) END AS http_status",
        f"CASE WHEN event_type = 'error' THEN {tx.classify_error_sql(raw)} END AS error_type",
        # mask first, then cut to 500 characters
        f"substring({tx.mask_credentials_sql(raw)}, 1, 500) AS error_message",
        f"{raw} AS error_raw",
        f"CASE WHEN event_type = 'error' AND k IS NOT NULL THEN element_at({_arr(ERROR_CLASSES)}, CAST(k % 6 + 1 AS INT)) END AS exception_class",
        "k % 7 = 0 AS challenge_detected",
        "CASE WHEN k % 7 = 0 THEN (CASE WHEN k % 3 = 1 THEN true WHEN k % 3 = 2 THEN false END) END AS challenge_solved",
        f"slice({_arr(SELECTORS)}, 1, CAST(k % 4 + 1 AS INT)) AS selectors_tried",
        f"CASE WHEN k % 5 <> 0 THEN {sel} END AS selector_matched",
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submission events: each order submits its customer as a lead."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # the domain is derived once per customer, before the join multiplies rows
    c = read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", f"{tx.normalize_domain_sql(tx.guess_domain_sql('c_name'))} AS c_domain")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_orderkey").alias("seq"),
        F.col("c_domain").alias("domain"),
        F.col("c_name").alias("company"),
        F.concat(F.lit("lead_"), F.col("o_orderkey").cast("string")).alias("lead_id"),
        F.col("o_orderdate").alias("submitted_at"),
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("https://example.com/o/"), F.col("o_orderkey").cast("string"))).alias("source_url"),
    )


def planned_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search plan: the terms each run (one per day) set out to search; not all of them are searched."""
    e = read_table(spark, sf_dir, "events").select("ts", "user_id")
    return e.selectExpr("date_format(ts, 'yyyy-MM-dd') AS run_id", f"concat('term_', CAST(user_id % {N_PLANNED} AS STRING)) AS search_term").distinct()


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query events: raw query text (with blanks around it), time, companies found."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit(" term_"), ((F.col("o_custkey") % 20) * 2).cast("string"), F.lit(" ")).alias("query"),
        F.col("o_orderdate").alias("tried_at"),
        (F.col("o_orderkey") % 7).alias("companies_found"),
    )


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress entries (source, key, value) in arrival order."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    i = F.col("s_suppkey")
    key = _pick(PROGRESS_KEYS, (i % 3 + 1).cast("int"))
    value = (
        F.when(key == "status", _pick(PROGRESS_STATUS, (i % 2 + 1).cast("int")))
        .when(key == "last_page", (i % 50).cast("string"))
        .otherwise(F.col("s_nationkey").cast("string"))
    )
    return s.select(
        i.alias("seq"),
        F.concat(F.lit("dir"), (i % 7).cast("string")).alias("source"),
        key.alias("key"),
        value.alias("value"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies to check against the state: customers and suppliers by name (``kind``, ``seq``)."""
    c = read_table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("seq"), F.col("c_name").alias("company"),
        F.col("c_mktsegment").alias("segment"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("seq"), F.col("s_name").alias("company"),
        F.lit("SUPPLIER").alias("segment"))
    u = c.unionByName(s)
    return u.selectExpr("kind", "seq", "company", f"{tx.normalize_domain_sql(tx.guess_domain_sql('company'))} AS domain", "segment")
