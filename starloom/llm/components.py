"""Connected components of a graph given by its links, as Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links a[i] - b[i] of one task as stars: (node, least node of its
    component) without the centres, at most one row a node."""
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, least = number[: len(a)], number[len(a) :], np.arange(len(nodes))
    while True:
        m = np.minimum(least[i], least[j])
        new = least.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        new = new[new]
        if (new == least).all():
            break
        least = new
    other = least != np.arange(len(nodes))
    return nodes[other], nodes[least[other]]


def _stars(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step of links (u, v)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    large = materialize(large, "large-star")
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return materialize(small.filter("u <> v").distinct(), "small-star")


def components(links: DataFrame) -> DataFrame:
    """(node, least node of its component) of every node of the links (u, v)
    but the least ones, by alternating large and small stars (the number of
    rounds grows with the logarithm of a component's size). Each round is a
    written table, so a lost executor repeats one round at most."""
    links = materialize(links.select("u", "v").filter("u <> v").distinct(), "links")
    state = None
    while True:
        links = _stars(links)
        new = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state or new[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("least"))
        state = new
