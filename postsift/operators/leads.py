"""Lead assembly: I1 process_leads, C18 rejected postings, I2 lead upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.rules import RuleSet
from ..session import stored
from .ordering import first_per_key, last_per_key, row_numbers

LEAD_COLUMNS = (
    "company", "domain", "job_title", "location", "confidence_score", "posting_url", "description",
    "linkedin_managers", "linkedin_hiring", "linkedin_role", "google_enduser", "date_scraped",
)


def process_leads(qualified: DataFrame, rules: RuleSet, run_date: str, keep: str = "first", carry: list[str] | None = None) -> DataFrame:
    """Qualified scored postings -> one lead per company.

    confidence (B16) -> drop missing company -> first posting per exact company
    (F2, a group limit: one row per company and task goes into the only shuffle) -> domain (B6)
    -> run date (B25) -> renames -> four search URLs (B8-B11) -> fixed order.
    ``keep="best"`` keeps the highest-scoring posting of a company instead of
    the first one (earliest wins a tie). ``carry`` (e.g. ``seq``) adds columns at the end.
    """
    if keep not in ("first", "best"):
        raise ValueError(f"keep must be 'first' or 'best', got {keep!r}")
    # columns the input lacks are kept as NULL (the reference keeps whatever is available)
    for c in ("title", "location", "job_url", "description"):
        if c not in qualified.columns:
            qualified = qualified.withColumn(c, F.lit(None).cast("string"))
    base = qualified.select(
        "seq", "company", "title", "location", "job_url", "description",
        tx.confidence_score("score", "qualified").alias("confidence_score"),
        F.col("score").alias("__score"),
    ).filter(F.col("company").isNotNull() & (F.col("company") != ""))
    if keep == "best":
        # the best score, then the earliest arrival
        first = last_per_key(base.withColumn("__late", -F.col("seq")), ["company"], ["__score", "__late"])
    else:
        first = first_per_key(base, ["company"], "seq")
    keywords = rules.template_keywords()
    return first.select(
        "company",
        tx.guess_domain("company").alias("domain"),
        F.col("title").alias("job_title"),
        "location",
        "confidence_score",
        F.col("job_url").alias("posting_url"),
        "description",
        tx.search_url_managers("company").alias("linkedin_managers"),
        tx.search_url_hiring("company").alias("linkedin_hiring"),
        tx.search_url_role("company", "title").alias("linkedin_role"),
        tx.search_url_enduser("company", keywords).alias("google_enduser"),
        tx.run_stamp(run_date).alias("date_scraped"),
        *(carry or []),
    )


def rejected_ids(scored: DataFrame) -> DataFrame:
    """``seq, company, rn, id`` of every rejected row, numbered in arrival order.

    Postings are scored once: what leaves is the seq and the company of the rejected ones, a narrow stored table.
    """
    rejected = stored(scored.filter(~F.col("qualified")).select("seq", "company"), "rejected")
    numbered = row_numbers(rejected, [], "seq", out="rn").withColumn("rn", F.col("rn").cast("bigint"))
    return numbered.select("seq", "company", "rn", tx.rejected_id("rn", "company").alias("id"))


def rejected_postings(scored: DataFrame, max_export: int | None = 100) -> DataFrame:
    """Rejected rows numbered in arrival order, in the labelling schema.

    ``rejected_id`` (B26), description cut to 2000, ``label`` false and a note
    with category and score. ``max_export`` keeps the first n (the export cap
    is the feature here); ``None`` keeps all: the export's rows are stored once,
    numbered by their ``seq`` alone and met again by it.
    """
    rej = scored.filter(~F.col("qualified")).select(
        "seq", "company", "title", F.substring(F.coalesce(F.col("description"), F.lit("")), 1, 2000).alias("description"), "rejection_category", "score")
    if max_export is not None:
        # the cap is the feature: a top-k (k rows per task, then k overall), numbered after
        first = rej.orderBy("seq").limit(max_export)
        numbered = first.withColumn("rn", F.row_number().over(Window.orderBy("seq")))
    else:
        rej = stored(rej, "rejected-export")
        numbered = rej.join(row_numbers(rej.select("seq"), [], "seq", out="rn"), "seq")
    return numbered.select(
        "seq",
        F.col("rn").cast("bigint").alias("rn"),
        tx.rejected_id("rn", "company").alias("id"),
        "description",
        F.lit(False).alias("label"),
        "company",
        "title",
        F.concat(F.lit("Rejected: "), F.col("rejection_category"), F.lit(" (score: "), F.col("score").cast("string"), F.lit(")")).alias("notes"),
    )


def rejected_sample(scored: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rejected rows in arrival order, each with the number of all rejected rows."""
    rejected = scored.filter(~F.col("qualified"))
    total = rejected.agg(F.count(F.lit(1)).alias("n")).scalar()
    first = rejected.select("seq", "company", "title", "rejection_category", "score").orderBy("seq").limit(n)
    return first.withColumn("total_rejected", total)


def insert_leads(existing: DataFrame, batch: DataFrame, key=("company", "job_title", "date_scraped"), order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Insert a batch into an existing lead table: the new rows, and one row of counts.

    A key that the table holds is skipped, of a key that the batch repeats the first row counts.
    """
    keyed = first_per_key(batch, list(key), order)
    new = keyed.join(existing.select(*key).distinct(), list(key), "left_anti").select(*batch.columns)
    counts = batch.agg(F.count(F.lit(1)).alias("rows")).select(
        new.agg(F.count(F.lit(1))).scalar().alias("inserted"),
        (F.col("rows") - new.agg(F.count(F.lit(1))).scalar()).alias("duplicates_skipped"))
    return new, counts
