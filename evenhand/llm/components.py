"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import stored


def local_components(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """The smallest index that each of n points can reach over the links a-b; label: what earlier calls found."""
    label = np.arange(n) if label is None else label
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            return label
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label[label] != label).any():
            label = label[label]


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node reachable) for every node of `links`; nodes are longs.

    Links have no direction; repeated ones and loops do no harm, links with a null end are
    left out, an empty table gives an empty one. Each step halves the depth of the trees, so
    that the number of steps grows with the logarithm of the longest chain; every step is
    stored. Minima are combined before they are shuffled, and no step gathers the
    neighbours of a node: a node with very many links is a skewed join, which adaptive
    execution splits. What a step sends to the driver is two numbers.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(f"{a} IS NOT NULL AND {b} IS NOT NULL AND u > v").distinct()
    edges, before = stored(edges), None
    while True:
        n = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if n[0] == 0 or n == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = n
        # large star: what is above a node is linked to the least of its neighbours and itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: what is below a node is linked to the least of it
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct())
