"""Presence, change feeds, inventory metrics, export and capacity over the test tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import canonical
from ..operators import capacity, changefeed, coverage, inventory, order, presence
from ..sources import exchange
from .registry import ntz, query, table

CADENCE = 86400


def presence_events(rows):
    """Events of users as presence evidence: view and click are positive, error is a miss, purchase an incomplete census, signup a verified withdrawal."""
    kind = F.when(F.col("event_type").isin("view", "click"), "positive").when(F.col("event_type") == "signup", "withdraw").otherwise("census")
    return rows.select(
        "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("id"), kind.alias("kind"),
        (F.col("event_type") != "purchase").alias("complete"), F.lit(True).alias("comparable"), F.lit(False).alias("present"), F.lit(True).alias("verified"),
    )


PRESENCE_SQL = """
    WITH RECURSIVE e AS (SELECT user_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS at, event_type AS t, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch_us(ts) / 1000000), event_id) AS n FROM events),
    walk AS (
        SELECT user_id, 0::BIGINT AS n, 'observed_present' AS state, 0 AS effects, 0::BIGINT AS pos, NULL::BIGINT AS miss FROM e WHERE n = 1
        UNION ALL
        SELECT s.user_id, s.n, s.state, s.effects + CASE WHEN s.state <> s.old THEN 1 ELSE 0 END, s.pos, s.miss FROM (
            SELECT w.user_id, e.n, w.state AS old, w.effects,
                CASE WHEN t IN ('view', 'click') THEN 'observed_present' WHEN t = 'signup' THEN 'withdrawn'
                    WHEN t = 'error' AND e.at > w.pos AND w.state <> 'withdrawn' AND w.state <> 'not_observed' AND w.miss IS NULL THEN 'absence_suspected'
                    WHEN t = 'error' AND e.at > w.pos AND w.state <> 'withdrawn' AND w.state <> 'not_observed' AND e.at - w.miss >= 86400 THEN 'not_observed' ELSE w.state END AS state,
                CASE WHEN t IN ('view', 'click') THEN e.at ELSE w.pos END AS pos,
                CASE WHEN t IN ('view', 'click', 'signup', 'purchase') THEN NULL
                    WHEN e.at > w.pos AND w.state <> 'withdrawn' AND w.state <> 'not_observed' AND w.miss IS NULL THEN e.at ELSE w.miss END AS miss
            FROM walk w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1) s
    )
    SELECT user_id, arg_max(state, n) AS state, max(effects) AS effects, max(n)::INTEGER AS events FROM walk GROUP BY user_id
"""


@query("presence_state", PRESENCE_SQL)
def presence_state(spark, d):
    return presence.states(presence_events(table(spark, d, "events")), "user_id", F.lit(CADENCE)).select("user_id", "state", "effects", "events")


@query("two_miss_pairs", """
    WITH m AS (SELECT user_id, epoch_us(ts) / 1e6 AS sec, event_id FROM events WHERE event_type = 'error'),
    p AS (SELECT user_id, sec, lag(sec) OVER (PARTITION BY user_id ORDER BY sec) AS previous FROM m)
    SELECT user_id, count(*) AS pairs, count(*) FILTER (sec - previous >= 86400) AS usable FROM p WHERE previous IS NOT NULL GROUP BY user_id
""")
def two_miss_pairs(spark, d):
    rows = table(spark, d, "events").filter("event_type = 'error'").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("at"))
    return presence.miss_pairs(rows, "user_id", "at", F.lit(CADENCE)).groupBy("user_id").agg(F.count("*").alias("pairs"), F.count_if("usable").alias("usable"))


def _feed(spark, d):
    """Events by (ts, event_id) as a feed of user_id: after-image (type, value), null for signup (a deletion)."""
    seq = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    image = F.when(F.col("event_type") != "signup", F.struct(F.col("event_type").alias("class"), F.col("value").alias("price")))
    return table(spark, d, "events").select("user_id", "event_id", seq.cast("decimal(20,0)").alias("seq"), image.alias("after"))


FEED = "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, event_type AS class, value AS price FROM events"


@query("filtered_changefeed", f"""
    WITH f AS ({FEED}), v AS (SELECT *, class = 'view' AND price <= 50 AS now FROM f), b AS (SELECT *, lag(now) OVER (PARTITION BY user_id ORDER BY seq) AS was FROM v)
    SELECT user_id, event_id, CASE WHEN now THEN 'upsert' WHEN was THEN 'remove' ELSE 'none' END AS action FROM b
""")
def filtered_changefeed(spark, d):
    return changefeed.filtered(_feed(spark, d), "user_id", "seq", "after", lambda a: (a["class"] == "view") & (a["price"] <= 50)).select("user_id", "event_id", "action")


@query("snapshot_at_seq", f"WITH f AS ({FEED}) SELECT user_id, arg_max(event_id, seq) AS event_id FROM f WHERE seq <= 20 GROUP BY user_id HAVING arg_max(class, seq) <> 'signup'")
def snapshot_at_seq(spark, d):
    return changefeed.snapshot_at(_feed(spark, d), "user_id", "seq", F.lit(20), F.col("after").isNull()).select("user_id", "event_id")


@query("snapshot_catch_up", f"WITH f AS ({FEED}) SELECT user_id, arg_max(event_id, seq) AS event_id FROM f GROUP BY user_id HAVING arg_max(class, seq) <> 'signup'")
def snapshot_catch_up(spark, d):
    """A snapshot at 20 with the events after it, delivered twice, equals the live state."""
    feed = _feed(spark, d).withColumn("gone", F.col("after").isNull())
    start = changefeed.snapshot_at(feed, "user_id", "seq", F.lit(20), F.col("gone")).select("user_id", "event_id", "seq")
    late = feed.filter("seq > 10").select("user_id", "event_id", "seq", "gone")
    return changefeed.replay(start, late.unionAll(late), "user_id", "seq", F.lit(20), "gone")


@query("seq_gaps", """
    WITH s AS (SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events)
    SELECT user_id, event_id AS after_seq, nxt AS before_seq, nxt - event_id - 1 AS missing FROM s WHERE nxt - event_id > 1
""")
def seq_gaps(spark, d):
    out = changefeed.gaps(table(spark, d, "events").withColumn("seq", F.col("event_id").cast("decimal(20,0)")), "user_id", "seq")
    return out.select("user_id", *[F.col(c).cast("long").alias(c) for c in ("after_seq", "before_seq", "missing")])


@query("price_changes", """
    WITH p AS (SELECT user_id, event_id, event_type, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT user_id, event_id, event_type, before FROM p WHERE n > 1 AND event_type IS DISTINCT FROM before
""")
def price_changes(spark, d):
    return changefeed.changes(table(spark, d, "events").select("user_id", "event_id", "ts", "event_type"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "event_type", "before")


@query("evidence_clocks", """
    SELECT user_id, max(ts) FILTER (event_type = 'view') AS view_at, max(ts) FILTER (event_type = 'error') AS error_at FROM events GROUP BY user_id
""")
def evidence_clocks(spark, d):
    return inventory.clocks(table(spark, d, "events"), ["user_id"], "event_type", "ts", ["view", "error"])


@query("inventory_counts", """
    SELECT l_returnflag, l_linestatus, count(DISTINCT l_partkey) AS items, count(DISTINCT (l_orderkey, l_linenumber)) AS listings, count(DISTINCT l_suppkey) AS sellers FROM lineitem GROUP BY ALL
""")
def inventory_counts(spark, d):
    return inventory.counts(table(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_partkey", ["l_orderkey", "l_linenumber"], "l_suppkey")


@query("freshness_quantiles", """
    WITH a AS (SELECT o_orderpriority AS tier, epoch(TIMESTAMP '2001-09-01') - epoch(o_orderdate) AS age FROM orders WHERE o_orderstatus <> 'P')
    SELECT tier, quantile_cont(age, 0.5) AS p50, quantile_cont(age, 0.95) AS p95, max(age)::DOUBLE AS max_age, count(*) AS known FROM a GROUP BY tier
""")
def freshness_quantiles(spark, d):
    age = (F.unix_micros(ntz("2001-09-01 00:00:00").cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp"))) / F.lit(1e6)
    return inventory.freshness(table(spark, d, "orders").filter("o_orderstatus <> 'P'").withColumnRenamed("o_orderpriority", "tier"), ["tier"], age)


@query("freshness_state", """
    WITH l AS (SELECT user_id, max(ts) AS last FROM events GROUP BY user_id), a AS (SELECT user_id, CASE WHEN user_id % 10 <> 0 THEN epoch(TIMESTAMP '2024-01-31') - epoch(last) END AS age, ['T0', 'T1', 'T2'][user_id % 3 + 1] AS tier FROM l)
    SELECT user_id, tier, CASE WHEN age IS NULL THEN 'unknown' WHEN age <= CASE tier WHEN 'T0' THEN 900 WHEN 'T1' THEN 21600 ELSE 86400 END THEN 'within' ELSE 'breached' END AS state FROM a
""")
def freshness_state(spark, d):
    tier = F.array(F.lit("T0"), F.lit("T1"), F.lit("T2"))[(F.col("user_id") % 3).cast("int")]
    last = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last")).withColumn("tier", tier)
    age = F.when(F.col("user_id") % 10 != 0, (F.unix_micros(ntz("2024-01-31 00:00:00").cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))) / F.lit(1e6))
    return last.select("user_id", "tier", inventory.slo_state(age, F.col("tier"), inventory.DELTA_TARGET).alias("state"))


@query("coverage_ratio_nullable", """
    SELECT n_nationkey, CASE WHEN s.n IS NOT NULL AND c.n > 0 AND n_nationkey % 5 <> 0 THEN round(s.n::DOUBLE / c.n, 9) END AS coverage_ratio FROM nation
    LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON s_nationkey = n_nationkey LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey
""")
def coverage_ratio_nullable(spark, d):
    s = table(spark, d, "supplier").filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("certified"))
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("declared"))
    met = table(spark, d, "nation").join(s, "n_nationkey", "left").join(c, "n_nationkey", "left")
    return met.select("n_nationkey", F.round(coverage.ratio(F.col("certified"), F.col("declared"), F.col("n_nationkey") % 5 != 0), 9).alias("coverage_ratio"))


@query("certificate_status", """
    SELECT l_orderkey, count(*) AS partitions, count(*) FILTER (l_linestatus = 'F') AS complete_partitions,
        CASE WHEN bool_or(l_tax > 0.07) THEN 'invalid' WHEN bool_and(l_linestatus = 'F') AND bool_and(l_returnflag <> 'N') THEN 'complete' ELSE 'positive_only' END AS status FROM lineitem GROUP BY 1
""")
def certificate_status(spark, d):
    return inventory.certificates(table(spark, d, "lineitem"), ["l_orderkey"], F.col("l_linestatus") == "F", F.col("l_returnflag") != "N", F.col("l_tax") <= 0.07)


@query("source_health", """
    WITH h AS (SELECT l_suppkey, count(*) FILTER (l_linenumber < 7) AS attempts, count(*) FILTER (l_linenumber < 7 AND l_returnflag <> 'R') AS successes FROM lineitem GROUP BY 1)
    SELECT *, CASE WHEN attempts = 0 THEN 'unknown' WHEN successes = attempts THEN 'healthy' WHEN successes > 0 THEN 'degraded' ELSE 'failing' END AS health FROM h
""")
def source_health(spark, d):
    ok = F.when(F.col("l_linenumber") < 7, F.col("l_returnflag") != "R")
    return inventory.health(table(spark, d, "lineitem"), ["l_suppkey"], ok)


@query("display_offer", """
    SELECT l_partkey, arg_min(l_suppkey, (l_extendedprice, l_orderkey, l_linenumber)) AS l_suppkey, min(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1
""")
def display_offer(spark, d):
    offers = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_orderkey", "l_linenumber")
    return inventory.display_offer(offers, ["l_partkey"], F.struct("l_extendedprice", "l_orderkey", "l_linenumber")).select("l_partkey", "l_suppkey", "l_extendedprice")


@query("membership_single_effective", """
    SELECT l_partkey, l_suppkey, count(*) AS effective FROM lineitem WHERE l_shipdate <= TIMESTAMP '1999-06-01' AND TIMESTAMP '1999-06-01' < l_shipdate + INTERVAL 400 DAY GROUP BY ALL HAVING count(*) > 1
""")
def membership_single_effective(spark, d):
    now = ntz("1999-06-01 00:00:00")
    return inventory.effective_conflicts(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], (F.col("l_shipdate") <= now) & (now < F.col("l_shipdate") + F.expr("interval 400 days")))


@query("ownership_gate", """
    WITH e AS (SELECT l_orderkey AS transfer_id, l_suppkey AS dealer, l_linenumber FROM lineitem WHERE l_linenumber <= 2),
    m AS (SELECT transfer_id, bool_and(dealer % 10 <> 3) AS committed FROM e GROUP BY 1)
    SELECT transfer_id, committed, CASE WHEN committed THEN 2 ELSE 1 END AS epoch FROM m
""")
def ownership_gate(spark, d):
    rows = table(spark, d, "lineitem").filter("l_linenumber <= 2").select(F.col("l_orderkey").alias("transfer_id"), F.col("l_suppkey").alias("dealer"), F.lit(1).alias("from_epoch"), F.lit(2).alias("to_epoch"), F.concat(F.col("l_suppkey").cast("string"), F.lit("-G2")).alias("generation_id"))
    # One dealer in ten sends the receipt of a stale generation.
    receipts = rows.distinct().withColumn("generation_id", F.when(F.col("dealer") % 10 == 3, "STALE").otherwise(F.col("generation_id")))
    return inventory.ownership_gate(receipts, rows.distinct())


@query("fenced_writes", """
    SELECT l_orderkey, l_linenumber, l_linenumber % 2 + 1 = 2 AND l_suppkey % 4 = l_partkey % 4 AS accepted FROM lineitem
""")
def fenced_writes(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("listing_id"), (F.col("p_partkey") % 4).alias("dealer"))
    owners = parts.withColumn("epoch", F.lit(1)).unionAll(parts.withColumn("epoch", F.lit(2)))
    writes = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("listing_id"), (F.col("l_suppkey") % 4).alias("dealer"), (F.col("l_linenumber") % 2 + 1).alias("epoch"))
    return inventory.fenced_writes(writes, owners, F.lit(2)).select("l_orderkey", "l_linenumber", "accepted")


@query("bulk_manifest_parts", """
    SELECT o_orderkey // 500 AS part, count(*) AS records, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key, sha256(string_agg(sha256(o_orderkey || '|' || o_custkey || '|' || o_orderstatus), '' ORDER BY o_orderkey)) AS sha256 FROM orders GROUP BY 1
""")
def bulk_manifest_parts(spark, d):
    record = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    return inventory.bulk_parts(table(spark, d, "orders"), "o_orderkey", 500, record)


@query("export_footer", """
    WITH r AS (SELECT sha256('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS d, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders),
    runs AS (SELECT n // 4096 AS run, sha256(string_agg(d, '' ORDER BY n)) AS digest FROM r GROUP BY 1)
    SELECT (SELECT count(*) FROM orders) AS records, sha256(string_agg(digest, '' ORDER BY run)) AS sha256 FROM runs
""")
def export_footer(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus")).alias("record"))
    return exchange.footer(rows, "o_orderkey", "record")


@query("bitemporal_as_of", """
    WITH f AS (SELECT l_partkey, l_orderkey * 8 + l_linenumber AS fact_id, l_suppkey, l_shipdate AS valid_from, CASE WHEN l_linenumber < 6 THEN l_shipdate + INTERVAL 700 DAY END AS valid_to, l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS recorded_at FROM lineitem),
    h AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY recorded_at DESC, fact_id DESC) AS n FROM f WHERE valid_from <= TIMESTAMP '1998-06-01' AND (valid_to IS NULL OR TIMESTAMP '1998-06-01' < valid_to) AND recorded_at <= TIMESTAMP '1998-08-01')
    SELECT l_partkey, fact_id, l_suppkey FROM h WHERE n = 1
""")
def bitemporal_as_of(spark, d):
    facts = table(spark, d, "lineitem").select(
        "l_partkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("fact_id"), "l_suppkey", F.col("l_shipdate").alias("valid_from"),
        F.when(F.col("l_linenumber") < 6, F.col("l_shipdate") + F.expr("interval 700 days")).alias("valid_to"), (F.col("l_shipdate") + F.make_dt_interval(F.col("l_quantity").cast("int"))).alias("recorded_at"),
    )
    return inventory.as_of(facts, ["l_partkey"], ntz("1998-06-01 00:00:00"), ntz("1998-08-01 00:00:00")).select("l_partkey", "fact_id", "l_suppkey")


@query("family_votes", """
    SELECT lang, n_chars % 10 AS value, count(DISTINCT coalesce(CASE WHEN source IN ('src0', 'src1', 'src2') THEN 'family' END, 'source:' || source)) AS votes FROM documents GROUP BY ALL
""")
def family_votes(spark, d):
    rows = table(spark, d, "documents").select("lang", (F.col("n_chars") % 10).alias("value"), "source", F.when(F.col("source").isin("src0", "src1", "src2"), "family").alias("family"))
    return inventory.family_votes(rows, ["lang"], "value", "family", "source")


@query("field_divergence", """
    SELECT o_custkey, count(DISTINCT o_orderpriority) AS definitions FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1
""")
def field_divergence(spark, d):
    return coverage.conflicts(table(spark, d, "orders").filter("o_orderstatus = 'F'"), ["o_custkey"], F.col("o_orderpriority"))


@query("delivery_mode", """
    SELECT l_suppkey, count(*) AS items, CASE WHEN count(*) * 100 > 100000 OR count(*) * 0.9 > 900 / 2.0 THEN 'bulk' ELSE 'paged' END AS mode FROM lineitem GROUP BY 1
""")
def delivery_mode(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("items"))
    return n.withColumn("mode", inventory.delivery_mode(F.col("items") * 100, F.col("items") * 0.9, F.lit(900.0)))


@query("capacity_model", """
    WITH p AS (SELECT unnest([10000000.0, 100000000.0, 1000000000.0])::DOUBLE AS active)
    SELECT active, active / 86400 AS steady_rate, 2 * active / 86400 AS design_rate, 4 * active / 86400 AS recovery_rate, ceil(4 * active / 86400 * 0.8) AS peak_concurrency, ceil(greatest(1, 2 * active / 86400 / 250)) AS partitions FROM p
""")
def capacity_model(spark, d):
    profiles = spark.createDataFrame([(10_000_000.0,), (100_000_000.0,), (1_000_000_000.0,)], "active double")
    equations = {
        "peak_concurrency": "ceil(recovery_rate * seconds)", "steady_rate": "active / day", "design_rate": "headroom * steady_rate", "recovery_rate": "2 * design_rate",
        "partitions": "ceil(max(1, design_rate / per_partition))",
    }
    return capacity.evaluate(profiles, equations, {"day": 86400, "headroom": 2, "seconds": 0.8, "per_partition": 250}).select("active", "steady_rate", "design_rate", "recovery_rate", "peak_concurrency", "partitions")


@query("uint64_order", """
    SELECT event_id, CAST(18446744073709551615::HUGEINT - event_id * event_id AS VARCHAR) AS seq, rank() OVER (ORDER BY 18446744073709551615::HUGEINT - event_id * event_id) AS place FROM events
""")
def uint64_order(spark, d):
    text = (F.lit("18446744073709551615").cast("decimal(20,0)") - (F.col("event_id") * F.col("event_id")).cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")
    rows = table(spark, d, "events").select("event_id", text.alias("seq"))
    return order.ranked(rows.withColumn("n", canonical.uint64(F.col("seq"))), "n", "place", equal=True).drop("n")


@query("inventory_listing", """
    SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_type IN ('ECONOMY', 'STANDARD') AND p_retailprice > 905
""")
def inventory_listing(spark, d):
    """Filters of a listing view; its sort is over (size descending, key)."""
    rows = table(spark, d, "part").withColumns({"item_id": F.col("p_partkey"), "market_country": F.col("p_brand"), "vehicle_class": F.col("p_type"), "updated_at": F.col("p_retailprice")})
    out = inventory.listed(rows, ["Brand#1", "Brand#2", "Brand#3"], ["ECONOMY", "STANDARD"], updated_after=F.lit(905), sort=[("p_size", True)])
    return out.select("p_partkey", "p_brand", "p_size")


@query("partition_outcomes", "SELECT l_suppkey, l_returnflag, count(*) AS fetched_count, count(DISTINCT l_partkey) AS distinct_listing_count FROM lineitem GROUP BY ALL")
def partition_outcomes(spark, d):
    return inventory.partition_outcomes(table(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"], "l_partkey")


@query("latest_plan_page", """
    SELECT o_custkey AS plan_id, max(o_orderkey) AS "offset", arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderkey % 50 = 0) = 1
""")
def latest_plan_page(spark, d):
    pages = table(spark, d, "orders").select(F.col("o_custkey").alias("plan_id"), F.col("o_orderkey").alias("offset"), (F.col("o_orderkey") % 50 == 0).alias("total_tasks"), F.col("o_orderstatus").alias("status"))
    return coverage.latest_plan_pages(pages)[0].select("plan_id", "offset", "status")


@query("decision_revisions", """
    WITH now AS (SELECT o_custkey, count(*) AS revision FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    p AS (SELECT c_custkey, c_custkey % 7 AS expected, CASE WHEN c_custkey % 5 = 0 THEN 'perhaps' ELSE 'accepted' END AS status FROM customer)
    SELECT c_custkey AS candidate_id, CASE WHEN status = 'perhaps' THEN 'unknown_status' WHEN c_acctbal < 0 THEN 'candidate_not_live' WHEN expected <> coalesce(revision, 0) THEN 'stale_revision' END AS fault
    FROM p JOIN customer USING (c_custkey) LEFT JOIN now ON o_custkey = c_custkey
""")
def decision_revisions(spark, d):
    from ..operators import evidence

    done = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("candidate_id"), F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long").alias("revision"))
    c = table(spark, d, "customer").withColumnRenamed("c_custkey", "candidate_id")
    proposed = c.select("candidate_id", (F.col("candidate_id") % 7).alias("expected_revision"), F.when(F.col("candidate_id") % 5 == 0, "perhaps").otherwise("accepted").alias("status"), F.lit(None).cast("long").alias("target_id"), F.lit("a").alias("actor"), F.lit("r").alias("reason"))
    accepted, refused = evidence.decide(done, proposed, c.filter("c_acctbal >= 0"))
    return accepted.select("candidate_id", F.lit(None).cast("string").alias("fault")).unionAll(refused.select("candidate_id", "fault"))


@query("acquisition_allowed", """
    SELECT s_suppkey, s_suppkey % 3 <> 0 AND s_nationkey % 4 <> 0 AND s_acctbal >= 0 AND s_suppkey % 7 <> 1 AS allowed FROM supplier
""")
def acquisition_allowed(spark, d):
    """Bundles by supplier: a third retired, some nations out of scope, negative balances revoked, one in seven with a stale capability."""
    from ..operators import acquisition

    key, day = F.col("s_suppkey").cast("string"), lambda text: F.lit(text).cast("timestamp")
    strings = lambda *items: F.array(*[F.lit(i) for i in items])
    rows = table(spark, d, "supplier").select(
        "s_suppkey",
        F.struct(key.alias("source_id"), F.when(F.col("s_suppkey") % 3 == 0, "retired").otherwise("monitored").alias("lifecycle")).alias("source"),
        F.struct(key.alias("source_id"), key.alias("surface_id"), key.alias("admission_id")).alias("surface"),
        F.struct(key.alias("stream_id"), key.alias("source_id"), key.alias("surface_id"), key.alias("admission_id"), key.alias("capability_manifest_id"), F.lit("1").alias("scope_revision"), F.when(F.col("s_nationkey") % 4 == 0, strings("FR", "IT")).otherwise(strings("FR")).alias("market_countries"), strings("car").alias("vehicle_classes")).alias("stream"),
        F.struct(key.alias("admission_id"), key.alias("surface_id"), F.when(F.col("s_acctbal") >= 0, "approved").otherwise("revoked").alias("status"), F.lit(True).alias("acquire_inventory"), day("2026-01-01").alias("valid_from"), day("2026-12-01").alias("valid_until"), day("2026-06-01").alias("review_due_at"), strings("FR", "DE").alias("market_countries"), strings("car", "lcv").alias("vehicle_classes")).alias("admission"),
        F.struct(key.alias("capability_manifest_id"), key.alias("surface_id"), day("2026-01-01").alias("capabilities_verified_at"), F.when(F.col("s_suppkey") % 7 == 1, day("2026-01-02")).otherwise(day("2026-04-01")).alias("revalidate_at")).alias("capability"),
        F.struct(key.alias("stream_id"), key.alias("capability_manifest_id"), F.lit("1").alias("scope_revision"), F.lit(2).alias("max_partitions"), F.array(F.struct(F.lit("1").alias("partition_id"), F.lit("x").alias("partition_key"))).alias("partitions")).alias("plan"),
    )
    return rows.select("s_suppkey", acquisition.may_acquire(day("2026-02-01")).alias("allowed"))
