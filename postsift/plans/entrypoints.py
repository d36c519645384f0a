"""The three end-to-end flows of SURVEY §3 as compositions of the operators.

* ``run_batch``      score -> leads CSV, rejected export, run stats, search errors,
                     site analytics, one folder per (kind, run, batch)  (§3.1)
* ``merge_batches``  read the artifacts of every batch of a run and recompute
                     the merged reports from them                       (§3.2)
* ``evaluate``       labelled items -> confusion matrix and ratios       (§3.3)

The scored frame feeds several sinks; it is written once under the output
root and read back (a table in the shared folder cuts the lineage), so the
rules run once per batch however many reports follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.rules import RuleSet
from ..operators import attempts as at
from ..operators import evaluation as ev
from ..operators import leads as ld
from ..operators import merging as mg
from ..operators import runstats as rs
from ..operators import scoring as sc
from ..session import path_exists
from ..sources import files as fs

FILTER_STATS = "total_processed bigint, qualified bigint, rejected bigint, company_blocked bigint"
SITE_STATS = ("site string, searches_attempted bigint, searches_successful bigint, total_jobs_found bigint, "
              "blocked boolean, blocked_at_term string, error_count bigint")
RUN_STATS = ("start_time string, end_time string, search_terms_total bigint, search_terms_completed bigint, "
             "total_jobs_raw bigint, total_jobs_filtered bigint, unique_companies bigint")
FILTER_MAPS = "rejection_reasons map<string,bigint>, qualification_tiers map<string,bigint>"


def run_batch(spark: SparkSession, postings: DataFrame, attempts: DataFrame, rules: RuleSet, out_root: str,
              run_id: str, run_date: str, batch: int | None = None, planned: DataFrame | None = None) -> dict[str, str | None]:
    """§3.1: one batch of a run; returns the written paths by kind.

    ``planned`` (``search_term``) is the search plan; without one the searched terms are taken as the plan.
    """
    root = out_root.rstrip("/")
    part = f"run_id={run_id}" + (f"/batch={batch}" if batch is not None else "")
    scored_path = f"{root}/scored/{part}"
    sc.score_postings(postings, rules).write.mode("overwrite").parquet(scored_path)
    scored = spark.read.parquet(scored_path)

    leads = ld.process_leads(sc.qualified_postings(scored), rules, run_date)
    paths: dict[str, str | None] = {"scored": scored_path}
    paths["leads"] = fs.write_leads_csv(leads, root, run_id, batch, mode="overwrite")
    paths["rejected"] = fs.write_report_json(ld.rejected_postings(scored, 100), root, "rejected", run_id, batch, mode="overwrite")
    paths |= write_run_reports(scored, attempts, rs.run_stats(attempts, attempts if planned is None else planned, scored, leads, run_id), root, run_id, batch)
    # search errors are exported only when there are any
    paths["search_errors"] = fs.write_report_json(at.search_errors(attempts), root, "search_errors", run_id, batch,
                                                  skip_empty=True, mode="overwrite")
    paths["attempts"] = fs.write_report_json(attempts, root, "attempts", run_id, batch, mode="overwrite")
    return paths


def write_run_reports(scored: DataFrame, attempts: DataFrame, stats: DataFrame, root: str, run_id: str, batch: int | None) -> dict[str, str | None]:
    """What a batch reports for the merge: run totals, filter counters and their maps, site stats, attempt counters."""
    reports = {
        "run_stats": stats,
        "filter_stats": rs.filter_stats(scored),
        "filter_maps": filter_maps(scored),
        "site_stats": at.site_stats(attempts),
        "attempt_state": mg.attempt_state(attempts),
    }
    return {kind: fs.write_report_json(df, root, kind, run_id, batch, mode="overwrite") for kind, df in reports.items()}


def filter_maps(scored: DataFrame) -> DataFrame:
    """One row: rejected rows by category and qualified rows by tier, as maps of counters."""
    kept = F.col("qualified")
    counts = scored.groupBy(kept.alias("kept"), F.when(kept, F.col("top_tier")).otherwise(F.col("rejection_category")).alias("key")).agg(F.count("*").alias("n"))
    entries = F.struct("key", "n")
    counts = counts.where("key IS NOT NULL")
    return counts.agg(F.map_from_entries(F.collect_list(F.when(~F.col("kept"), entries))).alias("rejection_reasons"),
                      F.map_from_entries(F.collect_list(F.when(F.col("kept"), entries))).alias("qualification_tiers"))


def merge_batches(spark: SparkSession, out_root: str, run_id: str) -> dict[str, DataFrame]:
    """§3.2: merged reports of one run, recomputed from the batch artifacts.

    Counters are added and rates recomputed from the sums; the attempt analytics
    follow from the batches' counters, so no attempt is read again; unique
    companies are counted exactly over the union of the leads (not added up). A
    corrupt artifact is skipped and listed under ``corrupt``.
    """
    root = out_root.rstrip("/")
    corrupt = []

    def read(kind: str, schema: str) -> DataFrame:
        good, bad = fs.read_batches(spark, root, kind, run_id, schema)
        corrupt.append(bad.withColumn("kind", F.lit(kind)))
        return good

    filters = read("filter_stats", FILTER_STATS)
    filt = filters.agg(*[F.sum(c).alias(c) for c in ("total_processed", "qualified", "rejected", "company_blocked")])
    filt = filt.withColumn("pass_rate", tx.rate_pct("qualified", "total_processed", 2))
    maps = read("filter_maps", FILTER_MAPS)
    sites = read("site_stats", SITE_STATS)
    totals = read("run_stats", RUN_STATS).withColumn("run_id", F.lit(run_id))
    both = totals.unionByName(filters.withColumn("run_id", F.lit(run_id)), allowMissingColumns=True)
    per_batch = both.groupBy("run_id", "batch").agg(*[F.max(c).alias(c) for c in both.columns if c not in ("run_id", "batch")])
    state = mg.merge_states(read("attempt_state", mg.STATE))
    errors = read("search_errors", "error_type string").groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))
    leads_path = f"{root}/leads/run_id={run_id}"
    leads = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("recursiveFileLookup", True).csv(leads_path) \
        if path_exists(spark, leads_path) else spark.createDataFrame([], "company string")
    companies = leads.agg(F.count_distinct("company").alias("unique_companies"))
    return {
        "run": mg.merge_run_stats(per_batch, sites.withColumn("run_id", F.lit(run_id))),
        "filter": filt,
        "rejection_reasons": mg.merge_count_maps(maps, "rejection_reasons", 10),
        "qualification_tiers": mg.merge_count_maps(maps, "qualification_tiers"),
        "sites": mg.merge_site_stats(sites),
        "site_summary": mg.site_summary(state),
        "site_values": mg.site_value_counts(state),
        "terms": mg.term_performance(state),
        "errors_by_type": mg.errors_by_type(state),
        "errors_by_site": mg.errors_by_site(state),
        "top_errors": mg.top_error_messages(state),
        "challenges": mg.challenge_analysis(state),
        "challenges_by_site": mg.challenge_by_site(state),
        "timing": mg.timing_distribution(state),
        "error_summary": errors,
        "unique_companies": companies,
        "corrupt": reduce(DataFrame.unionByName, corrupt),
    }


def evaluate(spark: SparkSession, labelled_path: str, rules: RuleSet, json_lines: bool = False) -> DataFrame:
    """§3.3: read and validate labelled items, predict without a title, one aggregate of metrics."""
    items = fs.read_labelled(spark, labelled_path, json_lines=json_lines)
    company = "company" if "company" in items.columns else None
    pred = sc.is_match(items, rules, "description", company)
    return ev.confusion_matrix(pred)
