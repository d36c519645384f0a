"""Filter statistics and run totals (E1-E3, E5, E16-E20): aggregates, not counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def filter_stats(scored: DataFrame) -> DataFrame:
    """One global aggregate (partial per partition, then final)."""
    return scored.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("qualified")).alias("qualified"),
        F.count_if(~F.col("qualified")).alias("rejected"),
        F.count_if(F.col("company_score") < 0).alias("company_blocked"),
    ).withColumn("pass_rate", tx.rate_pct("qualified", "total_processed", 2))


def top_counts(df: DataFrame, key: str, k: int | None, order_col: str = "seq", out: str = "n") -> DataFrame:
    """G1: counts per key, largest first; ties keep first-seen order (smallest ``order_col``)."""
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias(out), F.min(order_col).alias("__first"))
    ordered = agg.orderBy(F.col(out).desc(), F.col("__first").asc())
    if k is not None:
        ordered = ordered.limit(k)
    return ordered.drop("__first")


def rejection_breakdown(scored: DataFrame, k: int | None = 10) -> DataFrame:
    """Rejected rows per category, top k."""
    return top_counts(scored.filter(~F.col("qualified")), "rejection_category", k)


def tier_breakdown(scored: DataFrame) -> DataFrame:
    """Qualified rows per highest tier."""
    return scored.filter(F.col("qualified")).groupBy("top_tier").agg(F.count(F.lit(1)).alias("n"))


def unique_companies(scored: DataFrame, batch_col: str = "batch") -> DataFrame:
    """Exact distinct companies of the kept rows, and the per-batch sum the merge reports."""
    kept = scored.filter(F.col("qualified") & F.col("company").isNotNull() & (F.col("company") != ""))
    per_batch = kept.groupBy(batch_col, "company").agg(F.count(F.lit(1)).alias("__n"))
    by_company = per_batch.groupBy("company").agg(F.count(F.lit(1)).alias("__batches"))
    return by_company.agg(
        F.count(F.lit(1)).alias("unique_companies"),
        F.sum("__batches").alias("summed_companies"),
    )


def run_stats(attempts: DataFrame, planned: DataFrame, scored: DataFrame, leads: DataFrame, run_id: str) -> DataFrame:
    """E5: run totals: planned and searched terms, time span, raw / kept / unique, completion and filter rates.

    The four inputs are narrowed and unioned, then reduced by one aggregate
    (no join of one-row frames).
    """
    a = attempts.select(F.lit("attempt").alias("__k"), "search_term", "ts")
    s = scored.select(F.lit("posting").alias("__k"), "qualified")
    u = leads.select(F.lit("lead").alias("__k"))
    p = planned.select(F.lit("plan").alias("__k"), "search_term")
    x = a.unionByName(s, allowMissingColumns=True).unionByName(u, allowMissingColumns=True).unionByName(p, allowMissingColumns=True)
    k = F.col("__k")
    g = x.agg(
        F.count_distinct(F.when(k == "plan", F.col("search_term"))).alias("search_terms_total"),
        F.count_distinct(F.when(k == "attempt", F.col("search_term"))).alias("search_terms_completed"),
        tx.ts_string(F.min("ts")).alias("start_time"),
        tx.ts_string(F.max("ts")).alias("end_time"),
        F.count_if(k == "posting").alias("total_jobs_raw"),
        F.count_if((k == "posting") & F.col("qualified")).alias("total_jobs_filtered"),
        F.count_if(k == "lead").alias("unique_companies"),
    )
    return g.select(
        F.lit(run_id).alias("run_id"), "start_time", "end_time", "search_terms_total", "search_terms_completed",
        tx.rate_pct("search_terms_completed", "search_terms_total").alias("completion_rate"),
        "total_jobs_raw", "total_jobs_filtered", "unique_companies",
        F.when(F.col("total_jobs_raw") > 0,
               F.round((1 - F.col("total_jobs_filtered") / F.col("total_jobs_raw")) * 100, 1)).otherwise(0.0).alias("filter_rate"),
    )

