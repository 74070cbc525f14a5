"""Frontiers, queues, budgets and paging over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import planner, queue
from ..sources import geography
from ..functions import canonical
from .registry import ntz, query, table


@query("round_robin_order", """
    WITH r AS (SELECT n_regionkey AS lane, n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS idx FROM nation)
    SELECT lane, n_nationkey, idx, row_number() OVER (ORDER BY idx, lane) - 1 AS ordinal FROM r
""")
def round_robin_order(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_regionkey").alias("lane"), "n_nationkey", (F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1).cast("long").alias("idx"))
    return planner.round_robin(rows, "lane", "idx").select("lane", "n_nationkey", "idx", "ordinal")


@query("round_robin_page", """
    WITH lanes AS (SELECT o_custkey AS lane, count(*) AS length FROM orders GROUP BY 1),
    items AS (SELECT lane, unnest(range(length)) AS idx FROM lanes), placed AS (SELECT lane, idx, row_number() OVER (ORDER BY idx, lane) - 1 AS ordinal FROM items)
    SELECT lane, idx AS "index", ordinal FROM placed WHERE ordinal >= 1000 AND ordinal < 1700
""")
def round_robin_page(spark, d):
    lanes = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("lane")).agg(F.count("*").alias("length"))
    return planner.round_robin_page(lanes, "lane", "length", 1000, 700)


@query("frontier_size", """
    SELECT s_nationkey AS country, sum(1 + (SELECT count(*) FROM region) * (s_suppkey % 4))::BIGINT AS total_tasks FROM supplier GROUP BY 1
""")
def frontier_size(spark, d):
    places = table(spark, d, "region").agg(F.count("*").alias("places"))
    rows = table(spark, d, "supplier").crossJoin(places).select(F.col("s_nationkey").alias("country"), F.lit(1).alias("seeds"), "places", (F.col("s_suppkey") % 4).alias("queries"))
    return planner.frontier_size(rows, "country", "seeds", "places", "queries")


@query("cross_frontier", """
    SELECT r_regionkey, t.p_type, c.c_mktsegment, sha256('["' || r_name || '","' || t.p_type || '","' || c.c_mktsegment || '"]') AS task_key
    FROM region, (SELECT DISTINCT p_type FROM part) t, (SELECT DISTINCT c_mktsegment FROM customer) c
""")
def cross_frontier(spark, d):
    """A frontier is a product of small vocabularies by definition."""
    kinds, classes = table(spark, d, "part").select("p_type").distinct(), table(spark, d, "customer").select("c_mktsegment").distinct()
    rows = table(spark, d, "region").crossJoin(kinds).crossJoin(classes)
    return rows.select("r_regionkey", "p_type", "c_mktsegment", F.sha2(canonical.canonical_array(F.col("r_name"), F.col("p_type"), F.col("c_mktsegment")), 256).alias("task_key"))


@query("claim_order", """
    WITH t AS (SELECT o_orderkey AS task_key, o_custkey % 7 AS stratum, o_custkey % 7 % 3 AS last_claim, o_orderdate AS created_at, (length(o_orderpriority) * 7) % 10 AS priority FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY created_at, priority DESC, task_key) AS rnd FROM t),
    h AS (SELECT stratum, row_number() OVER (ORDER BY last_claim, created_at, priority DESC, task_key) AS turn FROM r WHERE rnd = 1)
    SELECT task_key, stratum, row_number() OVER (ORDER BY rnd, turn) AS claim FROM r JOIN h USING (stratum)
""")
def claim_order(spark, d):
    stratum = F.col("o_custkey") % 7
    tasks = table(spark, d, "orders").select(F.col("o_orderkey").alias("task_key"), stratum.alias("stratum"), (stratum % 3).alias("last_claim"), F.col("o_orderdate").alias("created_at"), ((F.length("o_orderpriority") * 7) % 10).alias("priority"))
    return queue.claim_order(tasks).select("task_key", "stratum", "claim")


@query("budget_admission", """
    SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS spent,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) <= 100 AS admitted FROM orders
""")
def budget_admission(spark, d):
    return queue.admit_budget(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate"), "o_orderpriority", F.lit(100), ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("throttle_fold", """
    WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) / 1e6 AS sec, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    walk AS (SELECT user_id, n, sec + 86400.0 AS next_at, 1 AS admitted FROM e WHERE n = 1
        UNION ALL SELECT e.user_id, e.n, CASE WHEN e.sec >= w.next_at THEN e.sec + 86400.0 ELSE w.next_at END, w.admitted + CASE WHEN e.sec >= w.next_at THEN 1 ELSE 0 END FROM walk w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
    SELECT user_id, max(n)::BIGINT AS asked, max(admitted)::BIGINT AS admitted FROM walk GROUP BY user_id
""")
def throttle_fold(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("at"))
    return queue.throttle(rows, "user_id", F.col("at"), "event_id", 86400.0).select("user_id", "asked", "admitted")


@query("origin_cooldown", "SELECT CAST(user_id AS VARCHAR) AS origin, max(value) AS next_at FROM events GROUP BY 1")
def origin_cooldown(spark, d):
    rows = table(spark, d, "events").select(F.col("user_id").cast("string").alias("origin"), F.col("value").alias("next_at"), "event_id")
    return queue.cooldown(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"))


@query("lease_expiry", """
    SELECT o_orderkey AS task_key, CASE WHEN o_orderstatus = 'P' AND o_totalprice <= 200000 THEN 'retry' WHEN o_orderstatus = 'P' THEN 'running' ELSE o_orderstatus END AS status,
        CASE WHEN o_orderstatus = 'P' AND o_totalprice <= 200000 THEN 'lease_expired' ELSE '' END AS reason FROM orders
""")
def lease_expiry(spark, d):
    running = F.col("o_orderstatus") == "P"
    tasks = table(spark, d, "orders").select(F.col("o_orderkey").alias("task_key"), F.when(running, "running").otherwise(F.col("o_orderstatus")).alias("status"), F.lit("").alias("reason"), F.lit(0.0).alias("not_before"), F.when(running, "t").alias("lease_token"), F.when(running, F.col("o_totalprice")).alias("lease_until"))
    return queue.expire_leases(tasks, F.lit(200000.0)).select("task_key", "status", "reason")


@query("enqueue_conflicts", """
    WITH old AS (SELECT c_custkey AS k, c_mktsegment AS p FROM customer WHERE c_custkey % 2 = 0), new AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 = 0 THEN 'other' ELSE c_mktsegment END AS p FROM customer)
    SELECT 'append' AS what, count(*) AS n FROM new WHERE k NOT IN (SELECT k FROM old) UNION ALL SELECT 'conflict', count(*) FROM new JOIN old USING (k) WHERE new.p <> old.p
""")
def enqueue_conflicts(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("task_key"), F.col("c_mktsegment").alias("payload"))
    new = c.withColumn("payload", F.when(F.col("task_key") % 6 == 0, "other").otherwise(F.col("payload")))
    fresh, wrong = queue.enqueue(c.filter("task_key % 2 = 0"), new.unionAll(new))
    return fresh.agg(F.lit("append").alias("what"), F.count("*").alias("n")).unionAll(wrong.agg(F.lit("conflict").alias("what"), F.count("*").alias("n")))


@query("release_frontier", """
    SELECT task_key FROM (SELECT o_orderkey AS task_key FROM orders WHERE o_custkey % 5 <= 3 ORDER BY 1 LIMIT 200) WHERE task_key NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def release_frontier(spark, d):
    o = table(spark, d, "orders")
    deferred = o.select(F.col("o_orderkey").alias("task_key"), (F.col("o_custkey") % 5).alias("channel_page"), F.lit(3).alias("max_pages"))
    return queue.release(deferred, o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("task_key")), 200).select("task_key")


@query("retry_after", """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1000.0 + greatest(1, CAST(props->>'k' AS BIGINT)) ELSE 1060.0 END::DOUBLE AS retry_at FROM events
""")
def retry_after(spark, d):
    value = F.when(F.col("event_id") % 3 == 0, F.get_json_object("props", "$.k")).when(F.col("event_id") % 3 == 1, F.lit("soon"))
    return table(spark, d, "events").select("event_id", queue.retry_at(value, F.lit(1000.0)).alias("retry_at"))


@query("keyset_page", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100")
def keyset_page(spark, d):
    return planner.keyset_page(table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], (500,), 100)


@query("keyset_page_tuple", """
    SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey > 20 OR (o_custkey = 20 AND o_orderkey > 300) ORDER BY o_custkey, o_orderkey LIMIT 100
""")
def keyset_page_tuple(spark, d):
    return planner.keyset_page(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], (20, 300), 100)


@query("plan_page_meta", """
    WITH p AS (SELECT o_custkey AS plan_id, count(*) AS total_tasks FROM orders GROUP BY 1)
    SELECT plan_id, total_tasks, 5 AS "offset", CASE WHEN least(total_tasks, 15) < total_tasks THEN 15 END::BIGINT AS next_offset, least(total_tasks, 15) >= total_tasks AS complete FROM p
""")
def plan_page_meta(spark, d):
    plans = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("plan_id")).agg(F.count("*").alias("total_tasks"))
    return planner.page_meta(plans, F.lit(5), F.lit(10))


@query("due_windows", """
    WITH s AS (SELECT s_suppkey AS schedule_id, TIMESTAMP '2024-01-01' + to_hours(CAST(s_suppkey % 24 AS INTEGER)) AS starts_at, (s_suppkey % 5 + 1) * 3600 * 12 AS step FROM supplier WHERE s_acctbal >= 0)
    SELECT schedule_id, count(*) AS windows, max(due) AS last_due FROM (SELECT schedule_id, unnest(generate_series(starts_at, TIMESTAMP '2024-01-15', to_seconds(step))) AS due, starts_at FROM s) WHERE due <> starts_at GROUP BY 1
""")
def due_windows(spark, d):
    starts = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=(F.col("s_suppkey") % 24).cast("int"))
    schedules = table(spark, d, "supplier").select(F.col("s_suppkey").alias("schedule_id"), starts.alias("starts_at"), ((F.col("s_suppkey") % 5 + 1) * 3600 * 12).alias("interval_seconds"), (F.col("s_acctbal") < 0).alias("paused"))
    done = schedules.select("schedule_id", F.col("starts_at").alias("due_at"))
    found = planner.due_windows(schedules, done, F.lit("2024-01-15 00:00:00").cast("timestamp"))
    return found.groupBy("schedule_id").agg(F.count("*").alias("windows"), F.max("due_at").cast("timestamp_ntz").alias("last_due"))


@query("schedule_shares", """
    WITH RECURSIVE d AS (SELECT s_suppkey AS schedule_id, s_suppkey % 9 * 3 AS size, row_number() OVER (ORDER BY s_suppkey % 4, s_nationkey, s_suppkey) AS n FROM supplier),
    w(n, rest, schedule_id, given) AS (
        SELECT 0::BIGINT, 100::BIGINT, NULL::BIGINT, 0::BIGINT
        UNION ALL SELECT d.n, rest - g, d.schedule_id, g FROM (SELECT w.*, least((SELECT count(*) FROM d), 8) - w.n AS turns FROM w) w JOIN d ON d.n = w.n + 1, LATERAL (SELECT CASE WHEN rest > 0 THEN least(d.size, greatest(1, rest // turns)) ELSE 0 END::BIGINT AS g) WHERE d.n <= 8
    ) SELECT (n - 1)::INTEGER AS turn, schedule_id, given FROM w WHERE n > 0
""")
def schedule_shares(spark, d):
    due = table(spark, d, "supplier").select(F.col("s_suppkey").alias("schedule_id"), (F.col("s_suppkey") % 4).alias("last_tick"), F.col("s_nationkey").alias("next_at"), (F.col("s_suppkey") % 9 * 3).alias("size"))
    return planner.shares(due, 100, 8)


@query("place_resolve", """
    WITH i AS (SELECT DISTINCT p_partkey AS code, lower(p_name) AS k FROM part), q AS (SELECT DISTINCT lower(p_name) AS name FROM part UNION SELECT 'no such place')
    SELECT name, CASE WHEN count(code) = 0 THEN 'unknown' WHEN count(code) = 1 THEN 'matched' ELSE 'ambiguous' END AS status, CASE WHEN count(code) = 1 THEN min(code) END AS code, count(code)::INTEGER AS candidates FROM q LEFT JOIN i ON k = name GROUP BY name
""")
def place_resolve(spark, d):
    units = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("region"))
    index = geography.name_index(units, canonical.ascii_name_key, aliases=None)
    asked = table(spark, d, "part").select(F.lower("p_name").alias("name")).distinct().unionAll(spark.createDataFrame([("no such place",)], "name string"))
    out = geography.resolve(asked, index, canonical.ascii_name_key(F.col("name")))
    return out.select("name", "status", F.col("code").cast("long").alias("code"), F.size("candidates").alias("candidates"))


@query("set_operations", """
    WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P')
    SELECT (SELECT count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)) AS either, (SELECT count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)) AS both_, (SELECT count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)) AS only_first
""")
def set_operations(spark, d):
    """Union, intersection and difference of members in one pass over the keys."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.col("o_orderstatus") == "F").alias("a"), F.max(F.col("o_orderstatus") == "P").alias("b"))
    return o.agg(F.count_if(F.col("a") | F.col("b")).alias("either"), F.count_if(F.col("a") & F.col("b")).alias("both_"), F.count_if(F.col("a") & ~F.col("b")).alias("only_first"))
