"""Connected components of a link table, by alternating large-star and small-star steps.

Each step replaces links so that every node points to the smallest node it knows; components keep their nodes, and
after about log(diameter) rounds every node points to its component's smallest. Links stay in Spark; each round is written to
the shared checkpoint folder, so a lost executor never costs more than a round. A step takes minima with a map-side
combine and joins them back, so a node with very many links is no group in one task.

Before and after each round every task joins the links that it has, some at a time, to stars of their own (``_contract``). Links that were all joined at
once need no round; more of them need fewer. What is left of all tasks goes to one task as soon as that joins it at once, which is up to ``JOINED`` links
however large the input is: a few links in many partitions need no round either.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import apart, ready

#: Links that a task joins at once.
JOINED = 1 << 20


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a and b: root has the smallest member of each one's set, before and after."""
    while True:
        x, y = root[a], root[b]
        off = x != y
        if not off.any():
            return
        a, b, x, y = a[off], b[off], x[off], y[off]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def _contract(links: DataFrame) -> DataFrame:
    """Links a > b that connect the same nodes: of JOINED links at most, each node's smallest among them; piece tells which were joined at once."""
    most = JOINED

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held, waiting, piece = [], 0, TaskContext.get().partitionId() << 32

        def joined():
            a, b = (np.concatenate(x) for x in zip(*held))
            node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            root, at = np.arange(len(node)), at.ravel()
            unite(root, at[: len(a)], at[len(a) :])
            own = np.flatnonzero(root != np.arange(len(node)))
            return pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[root[own]]), pa.array(np.full(len(own), piece))], ["a", "b", "piece"])

        for batch in batches:
            for first in range(0, batch.num_rows, most):
                part = batch.slice(first, most)
                if held and waiting + part.num_rows > most:
                    yield joined()
                    held.clear()
                    waiting, piece = 0, piece + 1
                held.append(tuple(part.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)))
                waiting += part.num_rows
        if held:
            yield joined()

    return links.select("a", "b").mapInArrow(run, "a long, b long, piece long")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step on distinct links a > b."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = both.join(apart(least, "u"), "u")
    if large:
        met = met.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        met = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return met.filter("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of links (a, b); self-links and nulls are left out."""
    ready(links.sparkSession)
    now = _contract(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()).checkpoint()
    sign = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"), F.min("piece").alias("first"), F.max("piece").alias("last")).first()
        if state["first"] == state["last"] or (state["n"], state["h"]) == sign:
            break
        sign = state["n"], state["h"]
        now = _contract(now.coalesce(1) if state["n"] <= JOINED else _star(_star(now, True), False)).checkpoint()
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionAll(found.select(F.col("component").alias("node"), "component").distinct())
