from __future__ import annotations

import random

from sparrowgrid.llm import components
from sparrowgrid.llm.components import connected_components


def brute(links):
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in [*root]}


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 5001 + k) for k in range(60)] + [(7, 7)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {v: c for v, c in brute([x for x in links if x[0] != x[1]]).items()}


def rounds(monkeypatch, most, df):
    taken = []
    star = components._star
    monkeypatch.setattr(components, "JOINED", most)
    monkeypatch.setattr(components, "_star", lambda *a: taken.append(1) or star(*a))
    return {r.node: r.component for r in connected_components(df).collect()}, len(taken) // 2


def test_links_that_are_joined_at_once_take_no_round(spark, monkeypatch):
    chain = [(k, k + 1) for k in range(500)] + [(3000 - k, 2999 - k) for k in range(500)]
    random.Random(3).shuffle(chain)
    df = spark.createDataFrame(chain, "a long, b long").coalesce(1)
    assert rounds(monkeypatch, 1 << 20, df) == (brute(chain), 0)
    found, taken = rounds(monkeypatch, 7, df)
    assert found == brute(chain) and taken > 1


def test_few_links_of_many_partitions_take_no_round(spark, monkeypatch):
    chain = [(k, k + 1) for k in range(500)] + [(9000, 9001 + k) for k in range(100)]
    random.Random(4).shuffle(chain)
    df = spark.createDataFrame(chain, "a long, b long")
    # As on large inputs: Spark leaves the partitions as they are.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rounds(monkeypatch, 600, df) == (brute(chain), 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
