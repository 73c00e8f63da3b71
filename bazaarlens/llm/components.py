"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from bazaarlens.llm.common import written


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of `links` (u, v: long) that is not itself a root; root is the smallest node reachable.

    Each round points every node's larger neighbours at the smallest
    neighbour (large star), then its smaller ones (small star), until nothing
    changes; the rounds grow with the logarithm of the longest path. A node
    with very many links is summed before the shuffle, and the minima are
    written before they are joined, so that AQE can split a hot node. Empty
    links give no rows; self links and repeated links change nothing.
    """
    edges = written(_oriented(links), "links")
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")), "least")
        large = both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = written(_oriented(large), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m"), "least")
        small = large.join(least, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(_oriented(small.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))), "links")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def star_links(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same connections in at most one link per node: every node with its component's smallest, roots left out."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        m = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        np.minimum.at(new, label, new)  # the old root follows its members
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    out = label != np.arange(len(nodes))
    return nodes[out], nodes[label[out]]
