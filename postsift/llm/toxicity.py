"""Toxicity by class-conditional Kneser-Ney models.

One character model is learned from the documents marked toxic, one from the
ordinary ones, both over all labelled rows (``ngram_arrays``: every n-gram
counts). Orders up to ``SHARED`` are counted over both classes together, so a
rare expression backs off to the same counts in both models and says little
unless its longer parts were seen more often in one class.

A document is judged by the difference of its two length-normalised
log-likelihoods (all its words, each as often as it occurs, and its length in
symbols). A logistic curve over that difference, the logarithm of the length
and their product gives the score, because a long ordinary document strays less
from the mean than a short one. The curve is fitted on a sample of the labelled
rows of each class (about ``calibration`` rows in all, half of them a class, by
hash of the id), each class weighted back to its share. Contexts end at word
borders.

Defined cases: texts without words have difference and length zero and get the
curve's value there; labels that are null or whose document is missing are
ignored; a document with several labels counts once for each; with labels of
one class only, or none, or no word in any labelled text, every score is 0;
repeated rows give repeated results; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ngram_arrays as arrays
from .common import among, share, store, text_or_empty
from .language import logistic

SHARED = 2
CLASSES = ["0", "1"]
FEATURES = ("difference", "size", "both")


@dataclass
class Learned:
    """The labelled rows (``grp, text``) and the curve's stored sample (``label, id, text, times``)."""

    rows: DataFrame
    sample: DataFrame


def fit(labelled: DataFrame, calibration: int = 20_000) -> Learned | None:
    """What is learned from ``labelled`` (columns ``doc_id``, ``text``, ``toxic``); None without both classes."""
    rows = labelled.where(F.col("toxic").isin(0, 1)).select(
        F.col("doc_id").alias("id"), text_or_empty("text").alias("text"), F.col("toxic").cast("int").cast("string").alias("grp"))
    sizes = {r["grp"]: r["count"] for r in rows.groupBy("grp").count().collect()}  # at most two
    if sorted(sizes) != CLASSES:
        return None
    half = calibration // 2
    ordinary, toxic = (share(rows.where(F.col("grp") == label), half, "id") for label in CLASSES)
    is_toxic = F.col("grp") == CLASSES[1]
    # one pass for both classes; the condition on the id alone holds back texts before they are joined
    drawn = rows.where(ordinary | toxic).where(F.when(is_toxic, toxic).otherwise(ordinary))
    times = F.when(is_toxic, max(sizes[CLASSES[1]] / half, 1.0)).otherwise(max(sizes[CLASSES[0]] / half, 1.0))
    drawn = drawn.select(F.col("grp").alias("label"), "id", "text", times.alias("times"))
    return Learned(rows.select("grp", "text"), store(drawn, "toxicity-sample"))


def _evidence(rows: DataFrame, model: arrays.Model) -> DataFrame:
    """``key, difference, size, both`` per row of (key, text)."""
    found = arrays.score(rows, model)
    apart = (F.col("sums")[1] - F.col("sums")[0]) / F.greatest("chars", F.lit(1))
    return found.select("key", (100 * apart).alias("difference"), F.log1p("chars").alias("size")).withColumn("both", F.col("difference") * F.col("size"))


def _curve(found: DataFrame) -> np.ndarray:
    """The curve from the scored sample; rows of one id, label and text are one."""
    rows = found.groupBy("label", "id", *FEATURES).agg(F.sum("times").alias("times")).collect()  # about ``calibration`` rows
    x = np.array([[1.0, *(r[c] for c in FEATURES)] for r in rows])
    return logistic(x, np.array([float(r["label"]) for r in rows]), ridge=0.1, times=np.array([r["times"] for r in rows]))


def _judged(rows: DataFrame, learned: Learned) -> DataFrame | None:
    """``key, score`` per row of (key, text); None if no labelled text has a word. The curve's sample is scored along."""
    asked = rows.select(F.lit(None).cast("string").alias("grp"), "text")
    model = arrays.finish(arrays.count(learned.rows.unionByName(asked), CLASSES), CLASSES, SHARED)
    if model is None:
        return None
    kind = rows.schema["key"].dataType
    none = F.lit(None)
    own = F.struct("key", none.cast("string").alias("label"), none.cast("long").alias("id"), none.cast("double").alias("times"))
    of_sample = F.struct(none.cast(kind).alias("key"), "label", F.col("id").cast("long").alias("id"), "times")
    both = rows.select(own.alias("key"), "text").unionByName(learned.sample.select(of_sample.alias("key"), "text"))
    found = store(_evidence(both, model).select("key.*", *FEATURES), "toxicity-evidence")
    curve = _curve(found.where(F.col("label").isNotNull()))
    return found.where(F.col("label").isNull()).select("key", _score(curve).alias("score"))


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents with their labels. Labels grow with the corpus, so the join is a merge join at every size; texts of
    documents that have none are held back before it (``among``)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return among(texts, "doc_id", known.select("doc_id")).join(known.hint("merge"), "doc_id")


def score(docs: DataFrame, learned: Learned | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("key"), text_or_empty(text_col).alias("text"))
    judged = None if learned is None else _judged(rows, learned)
    if judged is None:
        return rows.select(F.col("key").alias("doc_id"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    scored = judged.withColumnRenamed("key", "doc_id")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def keep(docs: DataFrame, learned: Learned | None, text_col: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns. A prediction depends on the text alone,
    so the toxic texts are taken out by their 128-bit hash."""
    key = F.unhex(F.md5(text_or_empty(text_col).cast("binary")))
    judged = None if learned is None else _judged(docs.select(key.alias("key"), text_or_empty(text_col).alias("text")), learned)
    if judged is None:
        return docs
    toxic = judged.where("score >= 0.5").select("key").distinct()
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), key.alias("key"))
    return rows.join(toxic, "key", "left_anti").select("row.*")


def _score(curve: np.ndarray) -> Column:
    z = sum((F.col(c) * float(w) for c, w in zip(FEATURES, curve[1:])), F.lit(float(curve[0])))
    return 1.0 / (1.0 + F.exp(-z))
