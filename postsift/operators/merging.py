"""Merging what batches of a run report (E17-E19): counters that add up, and the reports read from the sums.

``attempt_state`` turns the attempts of a batch into counters: one row per
(measure, site, key), made in one scan with partial sums. States of any batches
merge by adding (``merge_states``), and every attempt report follows from the
merged state as it does from the raw attempts, so a merge reads counters, not
attempts. ``merge_count_maps`` adds map columns key by key; ``merge_run_stats``
adds the totals of runs and recomputes every rate from the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .attempts import site_rates, timing_of
from .ordering import first_per_key

STATE = "measure string, site string, key string, n bigint, first_seq bigint"


def _i(c):
    return c.cast("bigint")


def attempt_state(att: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys, measure, site, key, n, first_seq``: the counters of a set of attempts."""
    ok, found, solved = F.col("success"), F.col("challenge_detected"), F.col("challenge_solved")
    one = F.lit(1).cast("bigint")

    def entry(measure: str, when: Column, n: Column = one, key: Column = F.lit(None), site: Column = F.col("site")) -> Column:
        row = F.struct(F.lit(measure).alias("measure"), site.cast("string").alias("site"), key.cast("string").alias("key"), n.cast("bigint").alias("n"))
        return F.when(when, row)

    everywhere = F.lit(None)
    told = F.col("error_message").isNotNull() & (F.col("error_message") != "")
    counters = F.array_compact(F.array(
        entry("tried", F.lit(True), key=F.col("search_term")),
        entry("succeeded", ok, key=F.col("search_term")),
        entry("failed", ~ok, key=F.col("search_term")),
        entry("jobs", ok & (F.col("jobs_found") != 0), F.col("jobs_found"), F.col("search_term")),
        entry("duration_ms", F.col("duration_ms") != 0, F.col("duration_ms")),
        entry("took_ms", ok & (F.col("duration_ms") > 0), key=F.col("duration_ms"), site=everywhere),
        entry("challenged", found),
        entry("solved", found & solved),
        entry("unsolved", found & ~solved),
        entry("failed_type", ~ok, key=F.coalesce("error_type", F.lit("unknown"))),
        entry("error_type", F.col("error_type") != "", key=F.col("error_type")),
        entry("http_status", F.col("http_status") != 0, key=F.col("http_status")),
        entry("selector", F.col("selector_matched") != "", key=F.col("selector_matched")),
        entry("message", ~ok & told, key=tx.truncate_text("error_message", 100), site=everywhere),
    ))
    return _added(att.select(*keys, F.col("seq").alias("first_seq"), F.inline(counters)), keys)


def _added(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*keys, "measure", "site", "key").agg(_i(F.sum("n")).alias("n"), _i(F.min("first_seq")).alias("first_seq"))


def merge_states(states: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """States of several batches as one."""
    return _added(states, keys)


def _sum_of(measure: str) -> Column:
    return _i(F.coalesce(F.sum(F.when(F.col("measure") == measure, F.col("n"))), F.lit(0)))


def _of(state: DataFrame, *measures: str) -> DataFrame:
    return state.where(F.col("measure").isin(*measures))


def site_summary(state: DataFrame) -> DataFrame:
    """E7 from a state."""
    names = {"total_attempts": "tried", "successful_attempts": "succeeded", "total_jobs": "jobs", "total_duration_ms": "duration_ms",
             "cloudflare_encounters": "challenged", "cloudflare_solved": "solved", "cloudflare_failed": "unsolved"}
    return site_rates(_of(state, *names.values()).groupBy("site").agg(*[_sum_of(m).alias(c) for c, m in names.items()]))


def site_value_counts(state: DataFrame) -> DataFrame:
    """E8 from a state."""
    return _of(state, "error_type", "http_status", "selector").select("site", F.col("measure").alias("kind"), "key", "n")


def term_performance(state: DataFrame) -> DataFrame:
    """E9 from a state."""
    def sites(measure: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col("measure") == measure, F.col("site")))), ",")

    g = _of(state, "tried", "succeeded", "failed", "jobs").groupBy(F.col("key").alias("search_term")).agg(
        _sum_of("tried").alias("total_attempts"), _sum_of("succeeded").alias("successful_attempts"), _sum_of("jobs").alias("total_jobs"),
        sites("tried").alias("sites_tried"), sites("succeeded").alias("sites_successful"), sites("failed").alias("sites_failed"))
    return g.withColumn("success_rate", tx.rate_pct("successful_attempts", "total_attempts"))


def timing_distribution(state: DataFrame) -> DataFrame:
    """E10 from a state: its histogram of durations."""
    return timing_of(_of(state, "took_ms").select(F.col("key").cast("bigint").alias("duration_ms"), "n"))


def errors_by_type(state: DataFrame) -> DataFrame:
    """E11 from a state."""
    return _of(state, "failed_type").groupBy(F.col("key").alias("error_type")).agg(_i(F.sum("n")).alias("n"))


def errors_by_site(state: DataFrame) -> DataFrame:
    """E12 from a state."""
    rows = _of(state, "failed_type").select("site", F.col("key").alias("error_type"), "n")
    return rows.rollup("site", "error_type").agg(_i(F.sum("n")).alias("n"), _i(F.grouping_id()).alias("level"))


def top_error_messages(state: DataFrame, k: int = 10) -> DataFrame:
    """E13 from a state: ties in the order in which the messages were first seen."""
    return _of(state, "message").orderBy(F.col("n").desc(), "first_seq").limit(k).select(F.col("key").alias("message"), "n")


def challenge_analysis(state: DataFrame) -> DataFrame:
    """E14 from a state."""
    g = _of(state, "challenged", "solved", "unsolved").agg(
        _sum_of("challenged").alias("total_encounters"), _sum_of("solved").alias("solved"), _sum_of("unsolved").alias("failed"))
    return g.withColumn("solve_rate", tx.rate_pct("solved", "total_encounters"))


def challenge_by_site(state: DataFrame) -> DataFrame:
    """E15 from a state."""
    return _of(state, "challenged", "solved", "unsolved").groupBy("site").agg(
        _sum_of("challenged").alias("encounters"), _sum_of("solved").alias("solved"), _sum_of("unsolved").alias("failed"))


def merge_attempt_analytics(states: DataFrame) -> DataFrame:
    """The site summary of all batches (states with a ``batch`` column), with the number of batches that met a site."""
    met = _of(states, "tried").groupBy("site").agg(_i(F.count_distinct("batch")).alias("batches")).withColumnRenamed("site", "__site")
    summary = site_summary(merge_states(states))
    return summary.join(met, summary["site"].eqNullSafe(met["__site"])).drop("__site")


def merge_count_maps(batches: DataFrame, map_col: str, k: int | None = None) -> DataFrame:
    """``key, n``: the counters of all rows' maps added key by key, largest first, then by key; ``k`` keeps the first.

    A null map or count adds nothing.
    """
    merged = batches.select(F.explode(map_col).alias("key", "n")).where("n IS NOT NULL").groupBy("key").agg(_i(F.sum("n")).alias("n"))
    ordered = merged.orderBy(F.col("n").desc(), F.col("key").asc())
    return ordered.limit(k) if k is not None else ordered


def merge_site_stats(per_batch: DataFrame, keys: tuple[str, ...] = ("site",)) -> DataFrame:
    """E17 per site: sums, blocked = any, the blocked term of the first batch that has one, the rate from the sums.

    ``per_batch`` has ``attempts.site_stats`` of each batch and its ``batch`` (null: the run was not cut).
    """
    total = per_batch.groupBy(*keys).agg(
        _i(F.count("*")).alias("batches"),
        *[_i(F.sum(c)).alias(c) for c in ("searches_attempted", "searches_successful", "total_jobs_found", "error_count")],
        F.bool_or("blocked").alias("blocked"),
    )
    first = first_per_key(per_batch.filter("blocked_at_term IS NOT NULL").select(*keys, "batch", "blocked_at_term"), list(keys), "batch").drop("batch")
    return total.join(first, list(keys), "left").withColumn("success_rate", tx.rate_pct("searches_successful", "searches_attempted"))


def merge_run_stats(runs: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per run from its batches' run totals and site stats.

    ``runs``: ``run_id, batch, start_time, end_time``, the term, posting and
    filter counts of each batch; ``sites``: ``run_id, batch, site, blocked``.
    Companies are added, as a batch reports only how many it kept
    (``runstats.unique_companies`` counts them over the rows).
    """
    sums = ("search_terms_total", "search_terms_completed", "total_jobs_raw", "total_jobs_filtered", "unique_companies",
            "total_processed", "qualified", "rejected", "company_blocked")
    g = runs.groupBy("run_id").agg(
        F.array_join(F.array_sort(F.collect_set("batch")), ",").alias("batches_processed"),
        _i(F.count("*")).alias("total_batches"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        *[_i(F.coalesce(F.sum(c), F.lit(0))).alias(c) for c in sums],
    )
    blocked = sites.where("blocked").groupBy("run_id").agg(F.array_join(F.array_sort(F.collect_set("site")), ",").alias("blocked_sites"))
    kept = F.when(F.col("total_jobs_raw") > 0, F.round((1 - F.col("total_jobs_filtered") / F.col("total_jobs_raw")) * 100, 1)).otherwise(0.0)
    return g.join(blocked, "run_id", "left").withColumns({
        "blocked_sites": F.coalesce("blocked_sites", F.lit("")),
        "completion_rate": tx.rate_pct("search_terms_completed", "search_terms_total"),
        "filter_rate": kept,
        "pass_rate": tx.rate_pct("qualified", "total_processed", 2),
    })
