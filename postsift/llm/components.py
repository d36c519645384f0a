"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a``, ``b``, long): the root is a node of its component.

    Each round hooks every node to its smallest neighbour if that is smaller,
    follows the hooks twice, and rewrites the edges between what is left. Edges
    inside a component vanish, so a round at least halves its nodes with edges;
    hooks are minima, combined before they are shuffled. Every round is written
    to the shared folder, so lineage stays short.
    """
    left = store(_tidy(edges.select("a", "b")), "edges")
    roots = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        hooks = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "hooks")
        for _ in range(2):
            hooks = _follow(hooks, hooks)
        hooks = store(hooks, "hooks")
        roots = hooks if roots is None else store(_follow(roots, hooks), "roots")
        a, b = hooks.toDF("a", "ra"), hooks.toDF("b", "rb")
        left = store(_tidy(left.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _follow(roots: DataFrame, hooks: DataFrame) -> DataFrame:
    step = hooks.toDF("at", "next")
    return roots.join(step, roots["root"] == step["at"], "left").select("node", F.coalesce("next", "root").alias("root"))
