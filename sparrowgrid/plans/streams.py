"""Streaming queries: over a file stream they give what the batch queries give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import tables
from .inventory import CADENCE, PRESENCE_SQL, presence_events
from .registry import query


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def stream_dedupe(spark, d):
    source = tables.read(spark, f"{d}/events.parquet").withColumn("day", F.to_date("ts"))
    return tables.drain(tables.dedupe(source, ["user_id", "event_type", "day"], "ts", "40 days").select("user_id", "event_type", "day"), "dedupe")


@query("stream_expiry", """
    SELECT event_id, CASE WHEN ts + to_days(CAST(event_id % 7 + 1 AS INTEGER)) > TIMESTAMP '2024-01-20' THEN 'kept' ELSE 'expired' END AS branch FROM events
""")
def stream_expiry(spark, d):
    source = tables.read(spark, f"{d}/events.parquet").withColumn("expires_at", F.col("ts") + F.make_dt_interval((F.col("event_id") % 7 + 1).cast("int")))
    return tables.drain(tables.live_split(source, F.lit("2024-01-20 00:00:00").cast("timestamp"), "expires_at").select("event_id", "branch"), "expiry")


@query("stream_presence", PRESENCE_SQL)
def stream_presence(spark, d):
    return tables.presence_ledger(presence_events(tables.read(spark, f"{d}/events.parquet")), "user_id", CADENCE)


@query("stream_tumbling", """
    SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL
""")
def stream_tumbling(spark, d):
    source = tables.read(spark, f"{d}/events.parquet")
    out = tables.drain(tables.tumbling(source, "ts", "1 day", "1 day", ["event_type"]), "tumbling", "update")
    # A window may be updated by several batches: its largest count is the last.
    return out.groupBy("event_type", F.col("window.start").cast("timestamp_ntz").alias("day")).agg(F.max("count").alias("n"))
