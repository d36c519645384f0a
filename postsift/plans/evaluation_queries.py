"""Registered queries for evaluation on labelled postings."""

from __future__ import annotations

from ..operators import evaluation as ev
from ..operators import scoring as sc
from ..sources import bindings as b
from . import oracle_views as ov
from .probe_rules import probe_rules
from .registry import query

R = probe_rules()
WL = ov.with_(ov.POSTINGS, ov.LABELLED, ov.scored_sql(R, source="labelled", use_title=False))


def predictions(spark, d):
    return sc.is_match(b.labelled_postings(spark, d), R)


CM = """SELECT CAST(count_if(label AND qualified) AS BIGINT) AS true_positives,
  CAST(count_if(NOT label AND qualified) AS BIGINT) AS false_positives,
  CAST(count_if(label AND NOT qualified) AS BIGINT) AS false_negatives,
  CAST(count_if(NOT label AND NOT qualified) AS BIGINT) AS true_negatives,
  count(*) AS total, CAST(count_if(label) AS BIGINT) AS positives FROM scored"""


@query("confusion_matrix", "E21", WL + f"""SELECT *, total - positives AS negatives,
  round(CASE WHEN true_positives + false_positives > 0 THEN true_positives / (true_positives + false_positives) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN true_positives + false_negatives > 0 THEN true_positives / (true_positives + false_negatives) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN 2 * true_positives + false_positives + false_negatives > 0
    THEN 2 * true_positives / (2 * true_positives + false_positives + false_negatives) ELSE 0.0 END, 6) AS f1
FROM ({CM})""")
def confusion_matrix(spark, d):
    return ev.confusion_matrix(predictions(spark, d))


@query("precision_recall_f1", "E22", WL + f"""SELECT
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1
FROM (SELECT count_if(label AND qualified) AS tp, count_if(NOT label AND qualified) AS fp, count_if(label AND NOT qualified) AS fn FROM scored)""")
def precision_recall_f1(spark, d):
    return ev.confusion_matrix(predictions(spark, d)).select("precision", "recall", "f1")


@query("eval_items", "I7", WL + """SELECT seq, label AS expected, qualified AS predicted,
  CASE WHEN label = qualified THEN 'MATCH' ELSE 'MISMATCH' END AS status FROM scored""")
def eval_items(spark, d):
    return ev.eval_items(predictions(spark, d))
