"""Duplicate components, constraints, chains and hierarchies. Edges stay in Spark; every round ends in a checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..folders import ready


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that is reachable over edges in either direction.

    Labels take the minimum over neighbours, then jump to their label's label, until a round changes nothing.
    """
    ready(edges.sparkSession)
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionAll(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).filter("u is not null and v is not null").distinct().checkpoint()
    labels = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("component")).withColumnRenamed("u", "node").checkpoint()
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("near"))
        lower = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        stepped = lower.join(jump, "next").select("node", "component", F.least("next", "far").alias("now")).checkpoint()
        changed = stepped.filter("component <> now").limit(1).count()
        labels = stepped.select("node", F.col("now").alias("component"))
        if not changed:
            return labels


def cannot_link_conflicts(labels: DataFrame, cannot: DataFrame, a: str = "source_id", b: str = "target_id") -> DataFrame:
    """Constraints both of whose ends are in one component."""
    left = labels.select(F.col("node").alias(a), F.col("component").alias("component"))
    right = labels.select(F.col("node").alias(b), F.col("component").alias("_other"))
    return cannot.join(left, a).join(right, b).filter("component = _other").drop("_other")


def chain_terminals(nodes: DataFrame, step: DataFrame, key: str = "node", target: str = "target", most: int = 64) -> DataFrame:
    """node, terminal, length, status of following ``target`` to its end: ok, cycle or too_deep (terminal null).

    Pointers double each round, so a chain of n steps takes log2(n) joins.
    """
    ready(nodes.sparkSession)
    now = nodes.select(F.col(key).alias("node")).join(step.select(F.col(key).alias("node"), F.col(target).alias("at")), "node", "left")
    now = now.select("node", F.coalesce("at", "node").alias("at"), F.when(F.col("at").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("long").alias("length")).checkpoint()
    span = 1
    while span <= most:
        ahead = now.select(F.col("node").alias("at"), F.col("at").alias("_next"), F.col("length").alias("_more"))
        now = now.join(ahead, "at", "left").select("node", F.coalesce("_next", "at").alias("at"), (F.col("length") + F.coalesce("_more", F.lit(0))).alias("length")).checkpoint()
        span *= 2
    open_ends = step.select(F.col(key).alias("at")).distinct().withColumn("_open", F.lit(True))
    now = now.join(open_ends, "at", "left")
    # What still has a step after so many is in a cycle or in a chain that is too long.
    back = F.col("length") >= F.lit(most)
    return now.select(
        "node", F.when(F.col("_open").isNull(), F.col("at")).alias("terminal"), F.when(F.col("_open").isNull(), F.col("length")).alias("length"),
        F.when(F.col("_open").isNull(), F.lit("ok")).when(back, F.lit("cycle_or_too_deep")).otherwise(F.lit("ok")).alias("status"),
    )


def parent_faults(units: DataFrame, most: int = 64) -> DataFrame:
    """code, fault of units whose parent is missing, or whose line of parents is cyclic or deeper than ``most``."""
    known = units.select(F.col("code").alias("parent_code")).distinct()
    missing = units.filter("parent_code is not null").join(known, "parent_code", "left_anti").select("code", F.lit("parent_missing").alias("fault"))
    steps = units.filter("parent_code is not null").select(F.col("code").alias("node"), F.col("parent_code").alias("target")).join(known.withColumnRenamed("parent_code", "target"), "target", "left_semi")
    walked = chain_terminals(units.select(F.col("code").alias("node")), steps, most=most)
    return missing.unionAll(walked.filter("status <> 'ok'").select(F.col("node").alias("code"), F.lit("cycle_or_too_deep").alias("fault")))


def constrained_clusters(edges: DataFrame, cannot: DataFrame, order: list[str]) -> DataFrame:
    """node, cluster: edges (a, b) merge in the given order unless that would join a cannot-link pair (a, b).

    The order decides the result, so it is explicit. Components without constraints inside need no order; only the others are merged
    edge by edge, each component in one group.
    """
    labels = components(edges.select("a", "b"))
    conflicts = cannot_link_conflicts(labels, cannot.select(F.col("a").alias("source_id"), F.col("b").alias("target_id")))
    hard = conflicts.select("component").distinct()
    easy = labels.join(hard, "component", "left_anti").select("node", F.col("component").alias("cluster"))
    kind = edges.schema["a"].dataType.simpleString()
    placed = labels.join(hard, "component", "left_semi").withColumnRenamed("node", "a")
    work = edges.join(placed, "a").select("component", "a", "b", F.lit(False).alias("barred"), F.row_number().over(_by("component", order)).alias("_nth"))
    bars = conflicts.select("component", F.col("source_id").alias("a"), F.col("target_id").alias("b"), F.lit(True).alias("barred"), F.lit(0).alias("_nth"))

    def merge(pdf):
        import pandas as pd

        pdf = pdf.sort_values("_nth")
        # What a node must not meet; a merge looks at the smaller side's only.
        bars: dict = {}
        for x in pdf[pdf.barred].itertuples():
            bars.setdefault(x.a, set()).add(x.b)
            bars.setdefault(x.b, set()).add(x.a)
        group: dict = {}
        for x in pdf[~pdf.barred].itertuples():
            p, q = sorted((group.setdefault(x.a, {x.a}), group.setdefault(x.b, {x.b})), key=len)
            if p is q or any(not q.isdisjoint(bars[v]) for v in p if v in bars):
                continue
            q |= p
            for v in p:
                group[v] = q
        return pd.DataFrame({"node": list(group), "cluster": [min(g) for g in group.values()]})

    return easy.unionAll(work.unionByName(bars).groupBy("component").applyInPandas(merge, f"node {kind}, cluster {kind}"))


def _by(key: str, order: list[str]):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def expand_frontier(seeds: DataFrame, links: DataFrame, max_depth: int, max_children: int) -> DataFrame:
    """url, depth of what is reached over links (source, target) within max_depth, each url once, at most max_children new ones (by url) for each source."""
    from pyspark.sql import Window

    ready(seeds.sparkSession)
    seen = seeds.select("url", F.lit(0).alias("depth")).distinct().checkpoint()
    edge = seen
    for depth in range(1, max_depth + 1):
        found = links.join(edge.select(F.col("url").alias("source")), "source", "left_semi").join(seen.select(F.col("url").alias("target")), "target", "left_anti")
        nth = F.row_number().over(Window.partitionBy("source").orderBy("target"))
        edge = found.select("source", "target").distinct().withColumn("_nth", nth).filter(F.col("_nth") <= max_children).select(F.col("target").alias("url")).distinct().withColumn("depth", F.lit(depth)).checkpoint()
        if not edge.limit(1).count():
            break
        seen = seen.unionAll(edge).checkpoint()
    return seen
