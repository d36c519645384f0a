"""Fixed schemas of the engine's inputs and outputs (FIXTURES.md §1)."""

from pyspark.sql import types as T

S, L, I, D, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


POSTING = _s(
    ("seq", L), ("company", S), ("title", S), ("location", S), ("job_url", S), ("description", S),
    ("date_posted", S), ("salary", S), ("job_type", S), ("search_term", S), ("source_site", S),
)

ATTEMPT = _s(
    ("search_term", S), ("site", S), ("timestamp", S), ("success", B), ("jobs_found", L), ("duration_ms", L),
    ("http_status", I), ("error_type", S), ("error_message", S), ("retry_count", I),
    ("selectors_tried", T.ArrayType(S)), ("selector_matched", S), ("cloudflare_detected", B),
    ("cloudflare_solved", B), ("page_title", S), ("response_size_bytes", L),
)

SEARCH_ERROR = _s(
    ("search_term", S), ("site", S), ("error_type", S), ("error_message", S), ("attempts", I),
    ("timestamp", S), ("exception_class", S), ("status_code", I),
)

LEAD = _s(
    ("company", S), ("domain", S), ("job_title", S), ("location", S), ("confidence_score", D), ("posting_url", S),
    ("description", S), ("linkedin_managers", S), ("linkedin_hiring", S), ("linkedin_role", S),
    ("google_enduser", S), ("date_scraped", S),
)

LABELLED_ITEM = _s(("id", S), ("description", S), ("label", B), ("company", S), ("category", S), ("notes", S))

SUBMITTED = _s(("domain", S), ("company", S), ("lead_id", S), ("submitted_at", TS), ("source_url", S))
QUERIES_TRIED = _s(("query", S), ("tried_at", TS), ("companies_found", L))
SOURCE_PROGRESS = _s(("source", S), ("key", S), ("value", S), ("last_updated", TS))

SITE_HEALTH = _s(("window_start", S), ("site", S), ("attempts", L), ("successes", L), ("blocks", L))
STORED_LEAD = T.StructType([*LEAD.fields, T.StructField("batch_id", S, True)])

STATE_SCHEMAS = {"submitted": SUBMITTED, "queries_tried": QUERIES_TRIED, "source_progress": SOURCE_PROGRESS, "leads": STORED_LEAD, "site_health": SITE_HEALTH}
