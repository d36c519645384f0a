"""Merged reports equal those of the raw attempts; counters, maps and runs; corrupt artifacts."""

import os

import pytest
from pyspark.sql import functions as F

from postsift.operators import attempts as at
from postsift.operators import merging as mg
from postsift.plans.entrypoints import merge_batches, run_batch
from postsift.plans.probe_rules import probe_rules
from postsift.sources import bindings as b
from tables import SF_SMALL

REPORTS = ["site_summary", "site_value_counts", "term_performance", "timing_distribution", "errors_by_type", "errors_by_site",
           "top_error_messages", "challenge_analysis", "challenge_by_site"]


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def merged_state(spark):
    """Every batch's state, written and read as JSON, in one."""
    from postsift.session import stored

    states = mg.attempt_state(b.attempts(spark, SF_SMALL), ("batch",))
    return stored(mg.merge_states(states.repartition(5)), "merged-state")


@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_counters_equal_those_from_attempts(spark, merged_state, name):
    assert rows(getattr(mg, name)(merged_state)) == rows(getattr(at, name)(b.attempts(spark, SF_SMALL)))


def test_merging_in_any_order_is_the_same(spark, merged_state):
    att = b.attempts(spark, SF_SMALL)
    a, c = mg.attempt_state(att.where("seq % 3 = 0")), mg.attempt_state(att.where("seq % 3 <> 0"))
    assert rows(mg.merge_states(mg.merge_states(c).unionByName(a))) == rows(merged_state)


def test_odd_attempts(spark):
    schema = ("seq long, search_term string, site string, success boolean, jobs_found long, duration_ms long, http_status int, error_type string, "
              "error_message string, selector_matched string, challenge_detected boolean, challenge_solved boolean")
    tries = [(1, None, None, False, None, None, None, None, None, None, None, None), (2, "t", "s", True, 3, 10, 200, "", "", "", True, None),
             (3, "t", "s", False, 0, 0, 0, "blocked", "x" * 300, "a.b", True, False), (4, "t", None, True, None, 5, 200, None, None, "a.b", False, True)]
    df = spark.createDataFrame(tries, schema)
    state = mg.attempt_state(df)
    for name in REPORTS:
        got, want = rows(getattr(mg, name)(state).fillna(0)), rows(getattr(at, name)(df).fillna(0))
        assert got == want, name
    empty = mg.attempt_state(df.where("false"))
    assert mg.site_summary(empty).isEmpty() and mg.timing_distribution(empty).first()["count"] == 0


def test_maps_add_key_by_key(spark):
    maps = spark.createDataFrame([(1, {"a": 2, "b": 1}), (2, {"b": 4, "c": None}), (3, None), (4, {}), (5, {"d": 2})], "batch long, counts map<string,bigint>")
    assert [tuple(r) for r in mg.merge_count_maps(maps, "counts").collect()] == [("b", 5), ("a", 2), ("d", 2)]
    assert [r["key"] for r in mg.merge_count_maps(maps, "counts", 2).collect()] == ["b", "a"]


def test_runs_stay_apart_and_rates_come_from_sums(spark):
    runs = spark.createDataFrame(
        [("r1", 0, "01", "05", 10, 5, 100, 10, 4, 100, 10, 90, 1), ("r1", 2, "00", "04", 30, 5, 0, 0, 3, 0, 0, 0, 0), ("r2", None, None, None, 0, 0, 0, 0, 0, 0, 0, 0, 0)],
        "run_id string, batch int, start_time string, end_time string, search_terms_total long, search_terms_completed long, total_jobs_raw long, "
        "total_jobs_filtered long, unique_companies long, total_processed long, qualified long, rejected long, company_blocked long")
    sites = spark.createDataFrame([("r1", 2, "x", True), ("r1", 0, "x", True), ("r1", 0, "a", True), ("r1", 0, "b", False)], "run_id string, batch int, site string, blocked boolean")
    out = {r["run_id"]: r for r in mg.merge_run_stats(runs, sites).collect()}
    one = out["r1"]
    assert (one["batches_processed"], one["total_batches"], one["start_time"], one["end_time"]) == ("0,2", 2, "00", "05")
    assert (one["completion_rate"], one["filter_rate"], one["pass_rate"], one["unique_companies"], one["blocked_sites"]) == (25.0, 90.0, 10.0, 7, "a,x")
    assert (out["r2"]["completion_rate"], out["r2"]["filter_rate"], out["r2"]["blocked_sites"], out["r2"]["batches_processed"]) == (0.0, 0.0, "", "")


def test_a_corrupt_artifact_is_skipped(spark, tmp_dir):
    postings, attempts = b.postings(spark, SF_SMALL), b.attempts(spark, SF_SMALL)
    for k in range(2):
        run_batch(spark, postings.filter(F.col("batch") % 2 == k), attempts.filter(F.col("batch") % 2 == k), probe_rules(), tmp_dir, "r1", "2026-01-22", batch=k)
    whole = merge_batches(spark, tmp_dir, "r1")
    assert whole["corrupt"].isEmpty() and whole["run"].first()["total_batches"] == 2
    assert rows(whole["terms"]) == rows(at.term_performance(attempts))
    reasons = whole["rejection_reasons"].collect()
    for kind in ("run_stats", "filter_maps", "attempt_state"):
        folder = f"{tmp_dir}/{kind}/run_id=r1/batch=7"
        os.makedirs(folder)
        with open(f"{folder}/part-0.json", "w") as f:
            f.write('{"rejection_reasons": {"unknown": 99999}, "total_jobs_raw": 5, "measure": "tried", "n": 4}\n{not json\n')
    again = merge_batches(spark, tmp_dir, "r1")
    assert {r["kind"] for r in again["corrupt"].collect()} == {"run_stats", "filter_maps", "attempt_state"}
    assert again["rejection_reasons"].collect() == reasons and again["run"].collect() == whole["run"].collect()
    assert rows(again["site_summary"]) == rows(at.site_summary(attempts))
