"""Connected components of a graph of integer ids: union-find within partitions, then alternating stars.

Each task first reduces its edges to a spanning forest by union-find.  Large-star and small-star rounds
then hang every node on the smallest id it can reach; each round is two aggregations (combined before the
shuffle) and two joins, and its edges go to a written table.  Nothing is collected but a count and a
checksum per round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


def spanning(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node that isn't the smallest of its component, for edges ``x`` - ``y``."""
    if not len(x):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    nodes, flat = np.unique(np.concatenate((x, y)), return_inverse=True)
    a, b = flat[: len(x)], flat[len(x) :]
    parent = np.arange(len(nodes))
    while True:
        ra, rb = parent[a], parent[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))  # union: roots hang on smaller roots
        while True:  # find: every path is halved until it is flat
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    below = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[below], nodes[parent[below]]


def _forest(batches: Iterator):
    import pyarrow as pa

    node = root = np.empty(0, np.int64)
    for batch in batches:
        x, y = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        node, root = spanning(np.concatenate((node, x)), np.concatenate((root, y)))
    if len(node):
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], names=["a", "b"])


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint, not null) but the smallest of each component.

    Loops and repeated edges are ignored; no edges give no rows.
    """
    edges = edges.where("a <> b").select("a", "b")
    e = materialise(edges.mapInArrow(_forest, "a bigint, b bigint"))
    mark = None
    while True:
        before, e = e, materialise(_small(_large(e)))
        release(before)
        found = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == (found["n"], found["h"]):
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = (found["n"], found["h"])
