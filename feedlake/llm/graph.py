"""Connected components of links that are spread over many tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import written


def stars(i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """(member, smallest id) rows that connect what the pairs ``left[i] - right[j]`` connect; ``i`` ascends."""
    low_left, low_right = left.copy(), right.copy()
    starts = np.flatnonzero(np.diff(i, prepend=-1))
    rows = i[starts]
    while len(rows):
        low_left[rows] = np.minimum(low_left[rows], np.minimum.reduceat(low_right[j], starts))
        before = low_right.copy()
        np.minimum.at(low_right, j, low_left[i])
        if (before == low_right).all():
            break
    met = np.unique(j)
    out = np.concatenate([np.stack([left[rows], low_left[rows]], 1), np.stack([right[met], low_right[met]], 1)])
    return out[out[:, 0] != out[:, 1]]


def connected(links: DataFrame) -> DataFrame:
    """``id, comp`` of every end of ``a, b`` links: the smallest id it is connected with.

    Each round takes the smallest label among a node's neighbours and then
    jumps to that label's own label, until nothing changes.
    """
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = written(links.select(ways.alias("w")).select("w.a", "w.b").distinct(), "links")
    label = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(label.select(F.col("id").alias("b"), F.col("comp").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        low = label.join(near, F.col("id") == F.col("a"), "left").select("id", F.least("comp", "c").alias("low"), "comp")
        up = label.select(F.col("id").alias("low"), F.col("comp").alias("root"))
        step = low.join(up, "low", "left").select("id", F.least("low", "root").alias("new"), "comp")
        step = written(step, "labels")
        changed = step.filter("new <> comp").limit(1).count()
        label = step.select("id", F.col("new").alias("comp"))
        if not changed:
            return label
