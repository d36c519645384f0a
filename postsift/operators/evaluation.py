"""Evaluation on labelled data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_matrix(pred: DataFrame, label: str = "label", predicted: str = "is_match") -> DataFrame:
    """E21 + E22: tp, fp, fn, tn, totals and precision / recall / f1 in one aggregate.

    Ratios are 0 when their divisor is 0 (also on empty input).
    """
    t, p = F.col(label), F.col(predicted)
    m = pred.agg(
        F.count_if(t & p).alias("true_positives"),
        F.count_if(~t & p).alias("false_positives"),
        F.count_if(t & ~p).alias("false_negatives"),
        F.count_if(~t & ~p).alias("true_negatives"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(t).alias("positives"),
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    m = m.withColumns({"negatives": F.col("total") - F.col("positives"), "precision": F.round(precision, 6), "recall": F.round(recall, 6)})
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0)
    return m.withColumn("f1", F.round(f1, 6))


def eval_items(pred: DataFrame, label: str = "label", predicted: str = "is_match", id_col: str = "seq") -> DataFrame:
    """Per item expected, predicted and MATCH / MISMATCH."""
    return pred.select(
        id_col, F.col(label).alias("expected"), F.col(predicted).alias("predicted"),
        F.when(F.col(label) == F.col(predicted), F.lit("MATCH")).otherwise(F.lit("MISMATCH")).alias("status"),
    )
