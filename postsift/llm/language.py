"""Language identification by Kneser-Ney character models.

Every language has a model over all its training documents, stored in sorted hash
arrays (``ngram_arrays``); a text goes to the language with the lowest
cross-entropy per character. The score is the
probability that this is right, from a logistic curve over the margin to the
second language (times the text's length up to ``long_text`` characters),
fitted on all training documents with letters (with one right and one wrong
answer at margin zero added): each Newton step is one sum over their stored
margins. A text whose cross-entropy is above nearly all (``quantile``) of the
rightly named training documents' for its language, by more than a tenth, is
marked as rejected; that quantile is found from counts, digit by digit.

Defined cases: null text and text without letters are ``und`` with score 0;
null languages are not learned from; with nothing to learn from everything is
``und``; ties take the first language in order; a null id is in no held-out
fold; repeated rows give repeated results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ngram_arrays as arrays
from .common import store, text_or_empty

UNKNOWN = "und"


def _curve(rows: DataFrame) -> np.ndarray:
    """The curve over all rows of (margin, right)."""

    def moments(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = F.col("margin")
        z = F.greatest(F.least(m * float(w[1]) + float(w[0]), F.lit(30.0)), F.lit(-30.0))
        p = rows.select("margin", "right", (1.0 / (1.0 + F.exp(-z))).alias("p"))
        weight, error = F.col("p") * (1 - F.col("p")), F.col("right") - F.col("p")
        sums = p.agg(*[F.sum(c) for c in (error, error * m, weight, weight * m, weight * m * m)]).first()
        e0, e1, h0, h1, h2 = (x or 0.0 for x in sums)
        at_zero = 1.0 / (1.0 + np.exp(-np.clip(w[0], -30, 30)))  # one right and one wrong answer
        return np.array([e0 + 1 - 2 * at_zero, e1]), np.array([[h0 + 2 * at_zero * (1 - at_zero), h1], [h1, h2]])

    return newton(moments, 2)


def _quantiles(rows: DataFrame, quantile: float) -> dict[str, float]:
    """The quantile over all rows of (grp, x) per group, to nine decimals, between the two values around its place.

    Each round counts the rows by some more digits where a place was found to lie; only counts reach the driver.
    """
    rows = rows.select("grp", F.round(F.col("x") * 1e9).cast("long").alias("x"))
    sizes = {r["grp"]: r["n"] for r in rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranks = {(g, up): min(int(quantile * (n - 1)) + up, n - 1) for g, n in sizes.items() for up in (0, 1)}
    stretch = {}
    for unit, above in ((10**8, None), (10**4, 10**8), (1, 10**4)):
        inside = rows
        if stretch:
            inside = rows.where(reduce(lambda a, b: a | b, [(F.col("grp") == g) & (F.expr(f"x div {above}") == v) for g, v in {(g, v) for (g, _), v in stretch.items()}]))
        whole = F.expr(f"x div {above}") if above else F.lit(0).cast("long")
        counts = {}
        for r in inside.groupBy("grp", whole.alias("whole"), F.expr(f"x div {unit}").alias("part")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault((r["grp"], r["whole"]), []).append((r["part"], r["n"]))
        for (g, up), rank in list(ranks.items()):
            for part, n in sorted(counts[g, stretch.get((g, up), 0)]):
                if rank < n:
                    break
                rank -= n
            ranks[g, up], stretch[g, up] = rank, part
    out = {}
    for g, n in sizes.items():
        share = quantile * (n - 1) % 1
        out[g] = (stretch[g, 0] * (1 - share) + stretch[g, 1] * share) / 1e9
    return out


def newton(moments: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], size: int, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; ``moments`` gives gradient and Hessian over the examples at some weights."""
    w = np.zeros(size)
    for _ in range(rounds):
        gradient, hessian = moments(w)
        step = np.linalg.solve(hessian + ridge * np.eye(size), gradient - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50, times: np.ndarray | None = None) -> np.ndarray:
    """``newton`` over arrays: rows of ``x`` are examples, counted ``times`` each; the first column is one."""
    times = np.ones(len(y)) if times is None else times

    def moments(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        return x.T @ (times * (y - p)), (x * (times * p * (1 - p))[:, None]).T @ x

    return newton(moments, x.shape[1], ridge, rounds)


def _scored(rows: DataFrame, model: arrays.Model, long_text: int) -> DataFrame:
    """``key, letters, lang_pred, entropy, margin`` per row of (key, text)."""
    found = arrays.score(rows, model)
    best = F.array_max("sums") / F.col("chars")
    second = F.sort_array("sums", False)[1] / F.col("chars") if len(model.groups) > 1 else best - 1.0
    some = F.col("letters") > 0
    lang = F.element_at(F.lit(model.groups), F.array_position("sums", F.array_max("sums")).cast("int"))
    return found.select(
        "key", "letters", F.when(some, lang).otherwise(UNKNOWN).alias("lang_pred"), F.when(some, -best).otherwise(0.0).alias("entropy"),
        F.when(some, (best - second) * F.least("chars", F.lit(long_text))).otherwise(0.0).alias("margin"))


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             long_text: int = 200, quantile: float = 0.995) -> DataFrame:
    """``doc_id, lang_pred, score, entropy, rejected`` for every row; ``learn`` picks the rows to learn from."""
    lang = F.when(learn, F.col(lang_col).cast("string"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), lang.alias("grp"), text_or_empty(text_col).alias("text"))
    learned = rows.where(F.col("grp").isNotNull())
    groups = sorted(r["grp"] for r in learned.select("grp").distinct().collect())  # a row per language
    model = arrays.finish(arrays.count(rows, groups), groups) if groups else None
    if model is None:
        return rows.select(F.col("id").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("entropy"), F.lit(True).alias("rejected"))
    found = store(_scored(rows.select(F.struct("id", F.col("grp").alias("label")).alias("key"), "text"), model, long_text).select("key.*", "letters", "lang_pred", "entropy", "margin"), "language-scores")
    known = found.where("label IS NOT NULL AND letters > 0")
    right = F.col("label") == F.col("lang_pred")
    curve = _curve(known.select("margin", right.cast("double").alias("right")))
    limits = {lang: 1.1 * x for lang, x in _quantiles(known.where(right).select(F.col("label").alias("grp"), F.col("entropy").alias("x")), quantile).items()}
    score = 1.0 / (1.0 + F.exp(-(F.lit(float(curve[0])) + F.col("margin") * float(curve[1]))))
    over = F.lit(False)
    for name, limit in limits.items():
        over = over | ((F.col("lang_pred") == name) & (F.col("entropy") > limit))
    none = F.col("letters") == 0
    return found.select(F.col("id").alias("doc_id"), "lang_pred", F.when(none, 0.0).otherwise(score).alias("score"), "entropy", (none | over).alias("rejected"))
