"""Connected components by repeated contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adlumen.llm import common as c


def components(links: DataFrame) -> DataFrame:
    """``links (a, b)`` to (v, label): for each vertex that is not the smallest of its component,
    the smallest one. Vertices that are missing are labels of themselves.

    Each round hooks every vertex to its smallest smaller neighbour, follows the pointers twice and
    contracts the links. The smallest vertex of a component never moves, so it ends as the label.
    Rounds grow with the logarithm of the longest chain.
    """
    edges = c.stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        hooks = edges.groupBy("v").agg(F.min("u").alias("p"))
        for _ in range(2):
            again = hooks.select(F.col("v").alias("p"), F.col("p").alias("q"))
            hooks = hooks.join(again, "p", "left").select("v", F.coalesce("q", "p").alias("p"))
        hooks = c.stored(hooks, "hooks")
        to_u, to_v = (hooks.select(F.col("v").alias(x), F.col("p").alias(f"p{x}")) for x in "uv")
        ends = edges.join(to_u, "u", "left").join(to_v, "v", "left").select(F.coalesce("pu", "u").alias("x"), F.coalesce("pv", "v").alias("y"))
        smaller = c.stored(ends.where("x <> y").select(F.greatest("x", "y").alias("v"), F.least("x", "y").alias("u")).distinct(), "links")
        if labels is None:
            merged = hooks.select("v", F.col("p").alias("label"))
        else:
            moved = labels.join(hooks.select(F.col("v").alias("label"), "p"), "label", "left").select("v", F.coalesce("p", "label").alias("label"))
            merged = moved.unionByName(hooks.select("v", F.col("p").alias("label")).join(labels, "v", "left_anti"))
        merged = c.stored(merged, "labels")
        for old in (edges, hooks, labels):
            if old is not None:
                c.forget(old)
        edges, labels = smaller, merged
    return labels if labels is not None else edges.select("v", F.col("u").alias("label"))
