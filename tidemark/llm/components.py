"""Connected components of a graph given as a table of edges, and of a small one in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_with_tasks, stage


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest vertex of the component of each of `n` vertices."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    return label


def components(edges: DataFrame) -> DataFrame:
    """(id, root): each vertex of `edges` (a, b) and the smallest vertex connected to it.

    Alternates large-star and small-star rounds: every vertex links its larger, then its smaller
    neighbours to the smallest one it knows. Rounds grow with the logarithm of the longest path.
    Each round is written to the shared folder, which cuts the lineage; edges never outnumber the
    input. Self-loops keep lone vertices; no edges give no rows.
    """
    def down(pairs):
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(pairs):
        got = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return got[0], got[1]

    vertices = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    current = stage(down(edges), "edges")
    before = None
    while (now := state(current)) != before:
        before = now
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_low")).select("a", F.least("a", "_low").alias("_low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
        current = stage(down(large), "edges")
        low = current.groupBy("a").agg(F.min("b").alias("_low"))
        small = current.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("_low").alias("b"))
        current = stage(down(small), "edges")
    return vertices.join(current, vertices["id"] == current["a"], "left").select("id", F.coalesce("b", "id").alias("root"))


ship_with_tasks(__name__)
