"""State tables in versions: cost of an upsert, replays, old versions, removal, lead batches."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.operators import state as st
from postsift.sources import bindings as b
from postsift.sources import state_store as ss
from tables import SF_SMALL

SUB = "seq long, domain string, company string, lead_id string, submitted_at timestamp, source_url string"


def sub(spark, rows):
    return spark.createDataFrame([(k, d, c, l, datetime(2026, 1, t), None) for k, d, c, l, t in rows], SUB)


def content(spark, root, table="submitted", version=None):
    return {r["domain"]: r["lead_id"] for r in ss.read_state(spark, root, table, version).collect()}


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "/data/" in d}


def test_newest_version_wins_and_missing_is_empty(spark, tmp_dir):
    assert ss.read_state(spark, tmp_dir, "submitted").count() == 0 and ss.versions(spark, tmp_dir, "submitted") == []
    ss.write_state_version(sub(spark, [(1, "a.com", "A", "l1", 1)]), tmp_dir, "submitted", 1)
    ss.write_state_version(sub(spark, [(1, "a.com", "A", "l1", 1), (2, "b.com", "B", "l2", 2)]), tmp_dir, "submitted", 2)
    assert content(spark, tmp_dir) == {"a.com": "l1", "b.com": "l2"}
    assert content(spark, tmp_dir, version=1) == {"a.com": "l1"}
    with pytest.raises(ValueError, match="already there"):
        ss.write_state_version(sub(spark, []), tmp_dir, "submitted", 2)


def test_an_upsert_writes_the_buckets_it_touches(spark, tmp_dir):
    many = spark.range(5000).select(F.col("id").alias("seq"), F.concat("id", F.lit(".com")).alias("domain"), F.lit("c").alias("company"), F.lit("old").alias("lead_id"),
                                    F.lit(datetime(2026, 1, 1)).alias("submitted_at"), F.lit(None).cast("string").alias("source_url"))
    ss.upsert(many, tmp_dir, "submitted")
    before = files(tmp_dir)
    assert len(ss.manifest(spark, tmp_dir, "submitted").folders) == ss.BUCKETS
    ss.upsert(sub(spark, [(k, f"{k}.com", "c", "new", 2) for k in range(0, 5000, 500)]), tmp_dir, "submitted")
    added = files(tmp_dir) - before
    assert 1 <= len(added) <= 10  # at most one file a key, whatever the table holds
    now = content(spark, tmp_dir)
    assert len(now) == 5000 and sum(v == "new" for v in now.values()) == 10
    assert set(content(spark, tmp_dir, version=1).values()) == {"old"}
    read = ss.read_state(spark, tmp_dir, "submitted")
    assert len(read.inputFiles()) == ss.BUCKETS


def test_two_sessions_equal_one(spark, tmp_dir):
    events = b.submissions(spark, SF_SMALL).withColumn("domain", tx.normalize_domain("domain"))
    for part in (events.where("seq % 4 = 1"), events.where("seq % 4 <> 1"), events, events.where("false")):
        ss.upsert(part, tmp_dir, "submitted", n_buckets=5)
    cols = ["domain", "company", "lead_id", "submitted_at"]
    assert ss.versions(spark, tmp_dir, "submitted") == [1, 2, 3]
    assert sorted(ss.read_state(spark, tmp_dir, "submitted").select(cols).collect()) == sorted(st.record_submissions(events).select(cols).collect())


def test_ties_nulls_and_a_dead_writer(spark, tmp_dir):
    ss.upsert(sub(spark, [(1, "a.com", "A", "first", 1), (2, None, "N", "null key", 1)]), tmp_dir, "submitted", n_buckets=3)
    ss.upsert(sub(spark, [(1, "a.com", "A", "same time", 1)]), tmp_dir, "submitted")  # of equal times the event wins over the stored row
    # rows of version 3 without a manifest are not read, and the next writer writes over them
    os.makedirs(f"{tmp_dir}/submitted/data/version=000000000003/bucket=0")
    assert content(spark, tmp_dir) == {"a.com": "same time", None: "null key"}
    ss.upsert(sub(spark, [(3, "c.com", "C", "x", 2)]), tmp_dir, "submitted")
    assert content(spark, tmp_dir) == {"a.com": "same time", None: "null key", "c.com": "x"}
    ss.rebucket(spark, tmp_dir, "submitted", 11)
    assert ss.manifest(spark, tmp_dir, "submitted").n_buckets == 11 and len(content(spark, tmp_dir)) == 3


def test_removing_a_source_touches_its_bucket(spark, tmp_dir):
    rows = [(k, f"s{k % 6}", f"key{k}", str(k), datetime(2026, 1, 1)) for k in range(30)]
    ss.upsert(spark.createDataFrame(rows, "seq long, source string, key string, value string, last_updated timestamp"), tmp_dir, "source_progress")
    before = files(tmp_dir)
    assert ss.remove(spark, tmp_dir, "source_progress", source="s3")
    assert len(files(tmp_dir) - before) <= 1
    left = ss.read_state(spark, tmp_dir, "source_progress")
    assert left.count() == 25 and left.where("source = 's3'").isEmpty()
    assert not ss.remove(spark, tmp_dir, "source_progress", source="s3")
    assert ss.versions(spark, tmp_dir, "source_progress") == [1, 2]
    for k in range(6):
        ss.remove(spark, tmp_dir, "source_progress", source=f"s{k}")
    assert ss.read_state(spark, tmp_dir, "source_progress").isEmpty()


LEAD = "seq long, company string, job_title string, date_scraped string, confidence_score double, domain string, location string, posting_url string, description string, " \
       "linkedin_managers string, linkedin_hiring string, linkedin_role string, google_enduser string"


def lead_rows(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], LEAD)


def test_lead_batches_and_replays(spark, tmp_dir):
    one = lead_rows(spark, [(1, "A", "x", "d", 90.0), (2, "A", "x", "d", 80.0), (3, "B", "y", "d", None), (4, None, "y", "d", 1.0), (5, "C", " ", "d", 1.0), (6, "D", "z", "d", 101.0)])
    assert ss.insert_leads(one, tmp_dir, "b1", n_buckets=4) == {"inserted": 2, "duplicates_skipped": 1, "errors": 3}
    two = lead_rows(spark, [(1, "A", "x", "d", 10.0), (2, "E", "x", "d", 10.0)])
    assert ss.insert_leads(two, tmp_dir, "b2") == {"inserted": 1, "duplicates_skipped": 1, "errors": 0}
    known = ss.versions(spark, tmp_dir, "leads")
    assert ss.insert_leads(one, tmp_dir, "b1") == {"inserted": 2, "duplicates_skipped": 1, "errors": 3}
    assert ss.insert_leads(two, tmp_dir, "b2") == {"inserted": 1, "duplicates_skipped": 1, "errors": 0}
    assert ss.versions(spark, tmp_dir, "leads") == known
    held = {(r["company"], r["confidence_score"], r["batch_id"]) for r in ss.read_state(spark, tmp_dir, "leads").collect()}
    assert held == {("A", 90.0, "b1"), ("B", None, "b1"), ("E", 10.0, "b2")}
    assert ss.insert_leads(lead_rows(spark, []), tmp_dir, "b3") == {"inserted": 0, "duplicates_skipped": 0, "errors": 0}
