"""File sources and sinks: labelled items, corrupt artifacts, CSV safety, state versions."""

import json
import os

import pytest
from pyspark.sql import functions as F

from postsift.sources import files as fs


def write(path, obj, raw=False):
    with open(path, "w") as f:
        f.write(obj if raw else json.dumps(obj))
    return path


def test_read_labelled_wrapped_and_bare(spark, tmp_dir):
    items = [{"id": "a", "description": "pv work", "label": True}, {"description": "other", "label": False, "company": "X"}]
    w = write(f"{tmp_dir}/w.json", {"metadata": {"n": 2}, "items": items})
    b = write(f"{tmp_dir}/b.json", items)
    assert fs.read_labelled(spark, w).count() == 2
    assert fs.read_labelled(spark, b).count() == 2


def test_read_labelled_rejects_non_boolean_label(spark, tmp_dir):
    p = write(f"{tmp_dir}/bad.json", {"items": [{"description": "x", "label": "yes"}]})
    with pytest.raises(ValueError, match="boolean"):
        fs.read_labelled(spark, p)
    p1 = write(f"{tmp_dir}/bad1.json", {"items": [{"description": "x", "label": True}, {"description": "y", "label": "maybe"}]})
    with pytest.raises(ValueError, match="Item 1 field 'label'"):
        fs.read_labelled(spark, p1)
    p2 = write(f"{tmp_dir}/bad2.json", {"items": [{"description": "x", "label": True}, {"label": False}]})
    with pytest.raises(ValueError, match="Item 1"):
        fs.read_labelled(spark, p2)


def test_artifacts_skip_corrupt_and_recover_run(spark, tmp_dir):
    from pyspark.sql import types as T

    d = f"{tmp_dir}/run_stats"
    os.makedirs(d)
    write(f"{d}/run_stats_20260122_101010_batch0.json", {"total": 3, "completed": 2})
    write(f"{d}/run_stats_20260122_101010_batch1.json", {"total": 5, "completed": 5})
    write(f"{d}/run_stats_20260122_101010_batch2.json", "{not json", raw=True)
    schema = T.StructType([T.StructField("total", T.LongType()), T.StructField("completed", T.LongType())])
    good, bad = fs.read_run_artifacts(spark, tmp_dir, "run_stats", schema)
    assert good.agg(F.sum("total")).first()[0] == 8
    assert bad.count() == 1
    run_id, batch = fs.run_partition()
    rows = sorted(good.select(run_id, batch).collect())
    assert [tuple(r) for r in rows] == [("20260122_101010", 0), ("20260122_101010", 1)]


def test_csv_sink_is_sanitised_and_batched(spark, tmp_dir):
    df = spark.createDataFrame([("=cmd", 1.5), ("ok", None)], "company string, confidence_score double")
    p0 = fs.write_leads_csv(df, tmp_dir, "r1", 0)
    p1 = fs.write_leads_csv(df, tmp_dir, "r1", 1)
    assert p0 != p1
    back = spark.read.option("header", True).csv(p0).collect()
    assert sorted(r["company"] for r in back) == ["'=cmd", "ok"]


def test_report_json_skips_empty(spark, tmp_dir):
    empty = spark.createDataFrame([], "error_type string")
    assert fs.write_report_json(empty, tmp_dir, "search_errors", "r1", skip_empty=True) is None
    assert fs.write_report_json(spark.createDataFrame([("x",)], "error_type string"), tmp_dir, "search_errors", "r1") is not None


def test_union_tolerates_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "seq long, company string")
    b = spark.createDataFrame([(2, "t")], "seq long, title string")
    u = fs.union_postings([a, b])
    assert set(u.columns) == {"seq", "company", "title"} and u.count() == 2
