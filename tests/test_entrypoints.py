"""End-to-end flows: batches written, merged and evaluated; merged = recomputed on the union."""

import json

from pyspark.sql import functions as F

from tables import SF_SMALL
from postsift.operators import attempts as at
from postsift.operators import runstats as rs
from postsift.operators import scoring as sc
from postsift.plans.entrypoints import evaluate, merge_batches, run_batch
from postsift.plans.probe_rules import probe_rules
from postsift.sources import bindings as b

R = probe_rules()


def test_batches_then_merge_equal_whole_run(spark, tmp_dir):
    postings = b.postings(spark, SF_SMALL)
    attempts = b.attempts(spark, SF_SMALL)
    for k in range(2):
        paths = run_batch(spark, postings.filter(F.col("batch") % 2 == k), attempts.filter(F.col("batch") % 2 == k),
                          R, tmp_dir, "r1", "2026-01-22", batch=k)
        assert paths["leads"] and paths["run_stats"]
    merged = merge_batches(spark, tmp_dir, "r1")
    whole = sc.score_postings(postings, R)
    assert merged["filter"].first().asDict() == rs.filter_stats(whole).first().asDict()
    got = {r["site"]: r["total_attempts"] for r in merged["site_summary"].collect()}
    want = {r["site"]: r["total_attempts"] for r in at.site_summary(attempts).collect()}
    assert got == want
    assert merged["timing"].first()["p90_ms"] == at.timing_distribution(attempts).first()["p90_ms"]
    assert merged["unique_companies"].first()[0] == rs.unique_companies(whole).first()["unique_companies"]


def test_evaluate_flow(spark, tmp_dir):
    items = [{"id": "a", "description": "the thand reer", "label": True},
             {"id": "b", "description": "no match here", "label": False},
             {"id": "c", "description": "the onon", "label": True}]
    path = f"{tmp_dir}/labelled.json"
    with open(path, "w") as f:
        json.dump({"metadata": {}, "items": items}, f)
    m = evaluate(spark, path, R).first()
    assert (m["true_positives"], m["false_negatives"], m["true_negatives"]) == (1, 1, 1)
    assert m["precision"] == 1.0 and m["recall"] == 0.5


def test_command_line_run_and_merge(spark, tmp_dir):
    from postsift.__main__ import main
    from postsift.plans.probe_rules import PROBE_RULES

    b.postings(spark, SF_SMALL).write.parquet(f"{tmp_dir}/postings")
    b.attempts(spark, SF_SMALL).drop("selectors_tried").write.parquet(f"{tmp_dir}/attempts")
    with open(f"{tmp_dir}/rules.json", "w") as f:
        json.dump(PROBE_RULES, f)
    assert main(["run-batch", "--rules", f"{tmp_dir}/rules.json", "--postings", f"{tmp_dir}/postings",
                 "--attempts", f"{tmp_dir}/attempts", "--out", f"{tmp_dir}/out", "--run-id", "r9",
                 "--run-date", "2026-01-22", "--batch", "0"]) == 0
    assert main(["merge", "--out", f"{tmp_dir}/out", "--run-id", "r9", "--write", f"{tmp_dir}/merged"]) == 0
    assert spark.read.json(f"{tmp_dir}/merged/filter").first()["total_processed"] == 200
