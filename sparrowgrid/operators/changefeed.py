"""Change feeds: snapshots at a cut, filtered views, gaps, replays. An event is a full after-image per key; null deletes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def snapshot_at(events: DataFrame, key: str, seq: str, cut: Column, deleted: Column) -> DataFrame:
    """The latest event of each key up to the cut, but for deletions."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))
    return events.filter(F.col(seq) <= cut).withColumn("_nth", nth).filter("_nth = 1").filter(~deleted).drop("_nth")


def filtered(events: DataFrame, key: str, seq: str, after: str, visible: Callable[[Column], Column]) -> DataFrame:
    """events with ``action`` for a consumer who sees only some rows: upsert when the row is visible now, remove when it was before, else none."""
    before = F.lag(after).over(Window.partitionBy(key).orderBy(seq))
    now, was = F.coalesce(visible(F.col(after)), F.lit(False)) & F.col(after).isNotNull(), F.coalesce(visible(F.col("_before")), F.lit(False)) & F.col("_before").isNotNull()
    return events.withColumn("_before", before).withColumn("action", F.when(now, "upsert").when(was, "remove").otherwise("none")).drop("_before")


def changes(events: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Events whose value differs from the one before (null counts as a value); the first event of a key is no change."""
    w = Window.partitionBy(key).orderBy(*order)
    out = events.withColumns({"before": F.lag(value).over(w), "_first": F.row_number().over(w) == 1})
    return out.filter(~F.col("_first") & ~F.col(value).eqNullSafe(F.col("before"))).drop("_first")


def gaps(events: DataFrame, stream: str, seq: str) -> DataFrame:
    """stream, after_seq, before_seq, missing of holes in the sequence (decimal: sequences reach 2^64 - 1)."""
    following = F.lead(seq).over(Window.partitionBy(stream).orderBy(seq))
    found = events.select(stream, F.col(seq).alias("after_seq"), following.alias("before_seq")).filter(F.col("before_seq") - F.col("after_seq") > 1)
    return found.withColumn("missing", F.col("before_seq") - F.col("after_seq") - 1)


def dedupe(events: DataFrame, keys: list[str]) -> DataFrame:
    """At-least-once delivery to once."""
    return events.dropDuplicates(keys)


def replay(snapshot: DataFrame, events: DataFrame, key: str, seq: str, cut: Column, deleted: str) -> DataFrame:
    """snapshot with the events after the cut put on top: duplicates and disorder don't matter."""
    names = [c for c in snapshot.columns if c != seq]
    late = dedupe(events.filter(F.col(seq) > cut), [key, seq]).select(*names, seq, F.col(deleted).alias("_gone"))
    every = snapshot.select(*names, cut.cast(events.schema[seq].dataType).alias(seq), F.lit(False).alias("_gone")).unionByName(late)
    nth = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))
    return every.withColumn("_nth", nth).filter("_nth = 1 and not _gone").select(*names)
