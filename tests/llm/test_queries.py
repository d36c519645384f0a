"""The registered queries: oracle agreement, contract columns, whole tables; the pipeline's stages."""

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op4_token_counts": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op5_line_dedup": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op6_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_simhash": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
    "op8_chat": {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"},
    "op9_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_decontaminate": {"doc_id": "bigint", "item_id": "bigint"},
    "op11_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op12_alignment": {"doc_id": "bigint", **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint"), "groups_sha256": "string"},
    "op13_filter_audit": {"part": "string", "filter_order": "string", "step": "int", **dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")},
}


@pytest.mark.parametrize("key", ["op1_jaccard_join", "op5_line_dedup", "op8_chat", "op13_filter_audit"])
def test_oracle(spark, key):
    ok, message = compare(spark, key, SF, duck(SF))
    assert ok, message


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_columns_and_rows(spark, key):
    from __spark_entry__ import queries

    out = queries()[key](spark, SF)
    types = dict(out.dtypes)
    assert {c: types.get(c) for c in COLUMNS[key]} == COLUMNS[key]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    if key in ("op3_packing", "op10_decontaminate", "op8_chat", "op13_filter_audit"):
        return
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    from postsift.llm import decontaminate, jaccard

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in cp.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF)
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        assert kept.columns == docs.columns
        if name == "line_dedup":
            assert kept.count() == before.count()
        elif name == "near_duplicates":
            again = jaccard.join(kept)
            assert again.where("n_shingles > 0").groupBy("root").count().where("count > 1").count() == 0
            groups = jaccard.join(before).where("n_shingles > 0").select("root").distinct().count()
            assert kept.count() == groups + jaccard.join(before).where("n_shingles = 0").count()
        elif name == "decontamination":
            assert decontaminate.find(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    pieces = cp.STAGES[-1][1](spark, kept, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}
    whole = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t"))
    assert whole.where("n <> t").count() == 0
