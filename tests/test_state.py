"""Session state: upserts repeated twice, last writer wins, membership joins."""

from datetime import datetime

from postsift.operators import state as st

SUB = "seq long, domain string, company string, lead_id string, submitted_at timestamp, source_url string"


def test_upsert_twice_is_idempotent_and_last_wins(spark):
    ev = spark.createDataFrame([(1, "WWW.A.com ", "A", "l1", datetime(2026, 1, 1), None),
                                (2, "a.com", "A2", "l2", datetime(2026, 1, 2), None)], SUB)
    once = st.record_submissions(ev)
    twice = st.record_submissions(ev, once)
    rows = twice.collect()
    assert len(rows) == 1 and rows[0]["lead_id"] == "l2" and rows[0]["domain"] == "a.com"


def test_new_and_known_companies(spark):
    sub = st.record_submissions(spark.createDataFrame([(1, "a.com", "A", "l1", datetime(2026, 1, 1), None)], SUB))
    cand = spark.createDataFrame([(1, "www.a.com", "c"), (2, "b.com", "c")], "seq long, domain string, kind string")
    assert [r["domain"] for r in st.new_companies(cand, sub).collect()] == ["b.com"]
    assert [r["domain"] for r in st.known_companies(cand, sub).collect()] == ["a.com"]


def test_queries_strip_and_progress_merge(spark):
    q = spark.createDataFrame([(1, " q1 ", datetime(2026, 1, 1), 3), (2, "q1", datetime(2026, 1, 3), 5)],
                              "seq long, query string, tried_at timestamp, companies_found long")
    t = st.record_queries(q).collect()
    assert len(t) == 1 and t[0]["companies_found"] == 5
    old = spark.createDataFrame([(1, "dir", "status", "in_progress"), (2, "dir", "last_page", "3")], "seq long, source string, key string, value string")
    new = spark.createDataFrame([(3, "dir", "status", "done")], "seq long, source string, key string, value string")
    merged = {r["key"]: r["value"] for r in st.merge_source_progress(new, old).collect()}
    assert merged == {"status": "done", "last_page": "3"}
    remaining, found = st.reset_source(st.merge_source_progress(new, old), "dir")
    assert remaining.count() == 0 and found.first()["found"]


def test_site_alias_merges_spellings(spark):
    from postsift.operators.attempts import alias_sites, site_summary

    rows = [(1, "board x", True, 3, 10, False, None), (2, "boardx", False, 0, 20, False, None), (3, "other", True, 1, 5, False, None)]
    att = spark.createDataFrame(rows, "seq long, site string, success boolean, jobs_found long, duration_ms long, "
                                      "challenge_detected boolean, challenge_solved boolean")
    merged = {r["site"]: r["total_attempts"] for r in site_summary(alias_sites(att, {"boardx": "board x"})).collect()}
    assert merged == {"board x": 2, "other": 1}
    assert alias_sites(att, {}) is att
