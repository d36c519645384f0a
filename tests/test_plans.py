"""Plan regression tests: the physical properties the design relies on."""

import re

from tables import SF_SMALL

from __spark_entry__ import queries


def plan(spark, key):
    df = queries()[key](spark, SF_SMALL)
    df.collect()  # the plan of this execution is final afterwards
    p = df._jdf.queryExecution().executedPlan().toString()
    return p.split("== Initial Plan ==")[0]


def test_flagship_scores_once_and_shuffles_once_on_company(spark):
    p = plan(spark, "process_leads")
    assert "Generate inline" in p                      # scoring results behind the generator
    assert p.count("lower(description") == 1           # text lower-cased once per row
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)", p)
    assert shuffles == ["company"] and "SortAggregate" not in p
    # the scan reads only the columns the postings view needs
    read = re.search(r"ReadSchema: struct<([^>]*)>", df_formatted(spark, "process_leads")).group(1)
    assert "n_chars" not in read and "text" in read


def df_formatted(spark, key):
    df = queries()[key](spark, SF_SMALL)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_is_not_pushed_into_the_scan(spark):
    p = plan(spark, "filter_stats")
    scan_filters = re.findall(r"Filter \(([^\n]*)", p)
    assert not any("Contains" in f for f in scan_filters)


def test_top_k_per_group_is_limited_before_the_shuffle(spark):
    p = plan(spark, "sample_per_term")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_rule_hits_are_a_projection(spark):
    p = plan(spark, "rule_hits")
    assert "Join" not in p and "Exchange" not in p and "Generate inline" in p


def test_first_per_key_is_limited_before_the_shuffle(spark):
    p = plan(spark, "first_per_company")
    assert "Partial" in p and p.count("Scan parquet") == 1 and "SortAggregate" not in p


def test_site_and_state_aggregates_hash(spark):
    for key in ("site_stats", "record_submissions", "error_summary"):
        assert "SortAggregate" not in plan(spark, key), key


def test_links_of_a_page_need_no_shuffle(spark):
    for key in ("page_links", "links_per_page", "page_cap"):
        p = plan(spark, key)
        assert "Exchange" not in p and p.count("Scan parquet") == 1, key


def test_run_level_streaks_read_attempts_once(spark):
    p = plan(spark, "term_failure_streak")
    assert p.count("Scan parquet") == 1 and p.count("Exchange hashpartitioning") <= 2


def test_plan_does_not_depend_on_the_number_of_cores(spark):
    p = plan(spark, "score_job")
    assert "Exchange" not in p
