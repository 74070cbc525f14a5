"""Evidence, decisions, coverage, estimation and duplicates over the test tables.

Orders stand for observations (candidate = customer, country = nation, class = market segment, source type = order status); events
stand for evidence with retention.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import canonical, urls
from ..operators import coverage, estimation, evidence, graph
from .registry import ntz, query, table

NOW = "2024-01-20 00:00:00"


def _observations(spark, d):
    return table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))


def _evidence(spark, d):
    """Events with retention of 1 to 7 days, by event_id."""
    return table(spark, d, "events").withColumn("expires_at", F.col("ts") + F.make_dt_interval((F.col("event_id") % 7 + 1).cast("int")))


@query("coverage_grid", """
    WITH axes AS (SELECT n_nationkey, s.seg, t.st FROM nation, (SELECT DISTINCT c_mktsegment AS seg FROM customer) s, (SELECT unnest(['F', 'O', 'P']) AS st) t),
    facts AS (SELECT c_nationkey, c_mktsegment, o_orderstatus, count(DISTINCT c_custkey) AS candidates, count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN c_custkey END) AS urgent,
        array_to_string(list_sort(list_distinct(list(o_orderpriority))), ',') AS evidence_groups, max(o_orderdate) AS last_observed_at
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    SELECT n_nationkey AS country, seg AS vehicle_class, st AS source_type, coalesce(candidates, 0) AS candidates, coalesce(urgent, 0) AS urgent, coalesce(evidence_groups, '') AS evidence_groups,
        last_observed_at, CAST(NULL AS DOUBLE) AS coverage_ratio
    FROM axes LEFT JOIN facts ON n_nationkey = c_nationkey AND seg = c_mktsegment AND st = o_orderstatus
""")  # fmt: skip
def coverage_grid(spark, d):
    dims = {"country": "c_nationkey", "vehicle_class": "c_mktsegment", "source_type": "o_orderstatus"}
    facts = coverage.cells(_observations(spark, d), dims, "c_custkey", "o_orderpriority", "o_orderdate", {"o_orderpriority": ["1-URGENT"]}).withColumnRenamed("o_orderpriority_1-URGENT", "urgent")
    axes = [table(spark, d, "nation").select(F.col("n_nationkey").alias("country")), table(spark, d, "customer").select(F.col("c_mktsegment").alias("vehicle_class")).distinct(), spark.createDataFrame([(s,) for s in "FOP"], "source_type string")]
    grid = coverage.dense(facts, axes, ["candidates", "urgent"], ["evidence_groups"])
    return grid.withColumn("evidence_groups", F.array_join("evidence_groups", ","))


@query("coverage_rollup", """
    SELECT c_nationkey, c_mktsegment, count(DISTINCT c_custkey) AS candidates, count(*) AS observations FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_nationkey, c_mktsegment)
""")  # fmt: skip
def coverage_rollup(spark, d):
    """An extension: subtotals over the grid."""
    return _observations(spark, d).rollup("c_nationkey", "c_mktsegment").agg(F.countDistinct("c_custkey").alias("candidates"), F.count("*").alias("observations"))


@query("live_evidence", """
    SELECT event_id, user_id, event_type FROM events
    WHERE ts <= TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-20' < ts + to_days(CAST(event_id % 7 + 1 AS INTEGER))
""")
def live_evidence(spark, d):
    return evidence.live(_evidence(spark, d), ntz(NOW), "ts").select("event_id", "user_id", "event_type")


@query("candidate_fold", "SELECT user_id, event_type, min(ts) AS first_observed_at, max(ts) AS last_observed_at, count(*) AS observations FROM events GROUP BY ALL")
def candidate_fold(spark, d):
    return evidence.fold_candidates(table(spark, d, "events"), ["user_id", "event_type"], "ts")


@query("evidence_dedupe_min_expiry", """
    SELECT user_id, event_type, CAST(ts AS DATE) AS day, min(ts + to_days(CAST(event_id % 7 + 1 AS INTEGER))) AS expires_at, count(*) AS copies FROM events GROUP BY ALL
""")
def evidence_dedupe_min_expiry(spark, d):
    return evidence.dedupe_evidence(_evidence(spark, d).withColumn("day", F.to_date("ts")), ["user_id", "event_type", "day"])


@query("latest_decision", """
    SELECT c_custkey AS candidate_id, coalesce(arg_max(o_orderstatus, o_orderkey), 'unreviewed') AS decision_status, coalesce(max(o_orderkey), 0) AS revision
    FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') o ON c_custkey = o_custkey GROUP BY c_custkey
""")
def latest_decision(spark, d):
    decisions = table(spark, d, "orders").filter(F.col("o_orderdate") >= ntz("2001-01-01 00:00:00")).select(F.col("o_custkey").alias("candidate_id"), "o_orderkey", "o_orderstatus")
    return evidence.with_decision(table(spark, d, "customer").select(F.col("c_custkey").alias("candidate_id")), decisions, revision="o_orderkey", value="o_orderstatus")


@query("tombstone_anti_join", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey AND s.s_acctbal < 0) AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size > 40)
""")  # fmt: skip
def tombstone_anti_join(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").withColumns({"candidate_key": F.col("l_suppkey"), "evidence_key": F.col("l_partkey")})
    gone = table(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("candidate_key"))
    stale = table(spark, d, "part").filter("p_size > 40").select(F.col("p_partkey").alias("evidence_key"))
    return evidence.admit(rows, gone, stale)[0].drop("candidate_key", "evidence_key")


@query("suppress_cascade", """
    WITH ids AS (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0), bodies AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM ids))
    SELECT 'evidence' AS what, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM ids)
    UNION ALL SELECT 'artifacts', count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM bodies)
    UNION ALL SELECT 'suppressed_artifacts', count(*) FROM bodies
""")
def suppress_cascade(spark, d):
    facts = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("candidate_id"), F.col("l_partkey").alias("body_sha256"))
    none = facts.limit(0).select(F.col("candidate_id").alias("source_id"), F.col("candidate_id").alias("target_id"), "candidate_id")
    out = evidence.suppress(facts, none, none, table(spark, d, "part").select(F.col("p_partkey").alias("checksum")), table(spark, d, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("candidate_id")))
    counts = [out[what].agg(F.lit(what).alias("what"), F.count("*").alias("n")) for what in ("evidence", "artifacts", "suppressed_artifacts")]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@query("expire_split", """
    SELECT event_type, CASE WHEN ts + to_days(CAST(event_id % 7 + 1 AS INTEGER)) <= TIMESTAMP '2024-01-20' THEN 'expired' ELSE 'kept' END AS branch, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL
""")  # fmt: skip
def expire_split(spark, d):
    rows = _evidence(spark, d)
    kept, gone = evidence.expire(rows, ntz(NOW), "event_id")
    both = kept.select("event_id", F.lit("kept").alias("branch")).unionAll(gone.select("event_id", F.lit("expired").alias("branch")))
    return both.join(rows.select("event_id", "event_type"), "event_id").groupBy("event_type", "branch").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("relations_live", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE o_orderdate <= TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-01-01' < o_orderdate + INTERVAL 90 DAY
        AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
""")
def relations_live(spark, d):
    relations = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_orderkey").alias("evidence_id"), F.concat(F.lit("p"), F.col("l_partkey")).alias("source_id"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("target_id"))
    facts = table(spark, d, "orders").select(F.col("o_orderkey").alias("evidence_id"), F.col("o_orderdate").alias("observed_at"), (F.col("o_orderdate") + F.expr("interval 90 days")).alias("expires_at"))
    ends = table(spark, d, "part").filter("p_size <= 25").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("candidate_id")).unionAll(table(spark, d, "supplier").filter("s_acctbal >= 0").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("candidate_id")))
    return evidence.relations_live(relations, facts, ends, ntz("1999-01-01 00:00:00")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("export_candidates", """
    WITH live AS (SELECT user_id, min(ts + to_days(CAST(event_id % 7 + 1 AS INTEGER))) AS expires, arg_min(event_type, (ts, event_id)) AS method FROM events
        WHERE ts <= TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-20' < ts + to_days(CAST(event_id % 7 + 1 AS INTEGER)) GROUP BY user_id),
    every AS (SELECT user_id, max(ts) AS last_observed_at FROM events GROUP BY user_id)
    SELECT e.user_id AS candidate_id, CASE WHEN e.user_id % 11 = 0 THEN 'suppressed' WHEN expires IS NULL THEN 'no_live_evidence' END AS blocked,
        least(expires, last_observed_at + INTERVAL 30 DAY) AS review_due_at, method FROM every e LEFT JOIN live USING (user_id)
""")
def export_candidates(spark, d):
    rows = _evidence(spark, d).select(F.col("user_id").alias("candidate_id"), F.col("ts").alias("observed_at"), "expires_at", F.col("event_type").alias("method"), F.lit("1").alias("method_version"), F.col("event_id").alias("evidence_id"), F.array(F.lit("FR")).alias("countries"), F.array(F.lit("car")).alias("classes"))
    candidates = rows.groupBy("candidate_id").agg(F.max("observed_at").alias("last_observed_at")).withColumn("suppressed", F.col("candidate_id") % 11 == 0)
    none = rows.select("candidate_id", F.lit(1).alias("revision"), F.lit("accepted").alias("status")).limit(0)
    return evidence.exportable(candidates, rows, none, ntz(NOW)).select("candidate_id", "blocked", "review_due_at", "method")


@query("unknown_claims", """
    SELECT count(DISTINCT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_custkey END) AS source_type, count(DISTINCT CASE WHEN o_totalprice < 1000 THEN o_custkey END) AS locality,
        count(DISTINCT CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN o_custkey END) AS outside_profile FROM orders JOIN customer ON o_custkey = c_custkey
""")
def unknown_claims(spark, d):
    tests = {"source_type": F.col("o_orderpriority") == "4-NOT SPECIFIED", "locality": F.col("o_totalprice") < 1000, "outside_profile": ~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")}
    return coverage.unknown_claims(_observations(spark, d), "o_custkey", tests)


@query("enum_counts", """
    SELECT count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS F, count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS O,
        count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS P, count(DISTINCT CASE WHEN o_orderstatus = 'X' THEN o_custkey END) AS X FROM orders
""")
def enum_counts(spark, d):
    return coverage.enum_counts(table(spark, d, "orders"), "o_orderstatus", list("FOPX"), "o_custkey")


@query("work_debt", """
    SELECT o_orderstatus AS status, count(*) AS tasks, count(*) FILTER (o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('F')) AS human_required FROM orders GROUP BY ALL
""")
def work_debt(spark, d):
    rows = table(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "done").otherwise(F.col("o_orderstatus")))
    out = coverage.work_debt(rows.unionAll(rows.filter("o_orderkey < 100")), "o_orderkey", human=F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return out.withColumn("status", F.when(F.col("status") == "done", "F").otherwise(F.col("status")))


@query("oldest_pending", """
    SELECT o_orderpriority AS stratum, count(*) AS tasks, max(greatest(0, epoch(TIMESTAMP '2000-01-01') - epoch(o_orderdate)))::DOUBLE AS oldest_age_seconds, 0::BIGINT AS unknown_age
    FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY ALL
""")
def oldest_pending(spark, d):
    return coverage.oldest_pending(table(spark, d, "orders").withColumnRenamed("o_orderpriority", "stratum"), ntz("2000-01-01 00:00:00"), status="o_orderstatus", created="o_orderdate", terminal=("F",))


@query("ungenerated_frontier", """
    WITH plans AS (SELECT c_custkey AS plan_id, c_nationkey::BIGINT AS total_tasks FROM customer),
    made AS (SELECT plan_id, count(DISTINCT o_orderkey % 30) AS generated FROM orders JOIN plans ON o_custkey = plan_id WHERE o_orderstatus <> 'P' AND o_orderkey % 30 < total_tasks GROUP BY plan_id)
    SELECT plan_id, total_tasks, coalesce(generated, 0) AS generated, greatest(0, total_tasks - coalesce(generated, 0)) AS remaining FROM plans LEFT JOIN made USING (plan_id)
""")
def ungenerated_frontier(spark, d):
    plans = table(spark, d, "customer").select(F.col("c_custkey").alias("plan_id"), F.col("c_nationkey").cast("long").alias("total_tasks"))
    tasks = table(spark, d, "orders").select(F.col("o_custkey").alias("plan_id"), (F.col("o_orderkey") % 30).alias("planner_ordinal"), F.when(F.col("o_orderstatus") == "P", "x").alias("parent_task_key"))
    return coverage.ungenerated(plans, tasks)


@query("channel_summary", """
    WITH p AS (SELECT event_type, CASE WHEN event_type <> 'error' THEN CAST(props->>'k' AS BIGINT) END AS row_count, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value > 50 END AS complete FROM events)
    SELECT event_type, count(*) AS pages, sum(row_count)::BIGINT AS known_rows, count(*) FILTER (row_count IS NULL) AS unknown_rows, count(*) FILTER (complete) AS complete,
        count(*) FILTER (NOT complete) AS incomplete, count(*) FILTER (complete IS NULL) AS unknown_complete, count(*) FILTER (row_count > 50) AS row_limit_reached FROM p GROUP BY ALL
""")
def channel_summary(spark, d):
    e = F.col("event_type")
    rows = F.when(e != "error", F.get_json_object("props", "$.k").cast("long"))
    pages = table(spark, d, "events").select("event_type", rows.alias("row_count"), F.when(~e.isin("error", "view"), F.col("value") > 50).alias("complete"), F.when(rows > 50, F.array(F.lit("row_limit_reached"))).otherwise(F.array().cast("array<string>")).alias("warnings"))
    return coverage.channel_summary(pages, ["event_type"]).withColumn("row_limit_reached", F.coalesce(F.expr("warnings['row_limit_reached']"), F.lit(0))).drop("warnings")


@query("channel_pages_upsert", """
    SELECT user_id::VARCHAR || ':' || event_type AS page_id, min(ts + to_days(CAST(event_id % 7 + 1 AS INTEGER))) AS expires_at, min(ts) AS observed_at, arg_min(value, ts) AS value FROM events GROUP BY ALL
""")
def channel_pages_upsert(spark, d):
    rows = _evidence(spark, d).select(F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("page_id"), F.col("ts").alias("observed_at"), "expires_at", "value")
    return evidence.upsert_pages(rows)


@query("locality_flags", """
    SELECT n_nationkey, EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey) AS planned, EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000) AS attempted,
        EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9990) AS candidate_evidence FROM nation
""")
def locality_flags(spark, d):
    s = table(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    c = table(spark, d, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return coverage.locality_flags(table(spark, d, "nation").select("n_nationkey"), ["n_nationkey"], planned=s, attempted=s.filter("s_acctbal > 9000"), candidate_evidence=c.filter("c_acctbal > 9990"))


@query("name_ambiguity", "SELECT lower(p_name) AS name_key, count(DISTINCT p_brand) AS definitions FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def name_ambiguity(spark, d):
    return coverage.conflicts(table(spark, d, "part").withColumn("name_key", canonical.ascii_name_key(F.col("p_name"))), ["name_key"], F.col("p_brand"))


@query("duplicate_component", """
    WITH RECURSIVE walk AS (SELECT s_suppkey AS node, s_suppkey AS pos FROM supplier UNION SELECT node, pos // 2 FROM walk WHERE pos >= 8)
    SELECT node, min(pos) AS component FROM walk GROUP BY node
""")
def duplicate_component(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("a"))
    edges = s.filter("a >= 8").select("a", F.expr("a div 2").alias("b"))
    found = graph.components(edges)
    return s.select(F.col("a").alias("node")).join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


@query("cannot_link_conflicts", """
    WITH RECURSIVE walk AS (SELECT s_suppkey AS node, s_suppkey AS pos FROM supplier UNION SELECT node, pos // 2 FROM walk WHERE pos >= 8), label AS (SELECT node, min(pos) AS component FROM walk GROUP BY node)
    SELECT x.node AS source_id, y.node AS target_id, x.component FROM label x JOIN label y ON y.node = x.node + 5 AND x.component = y.component WHERE x.node >= 8 AND y.node >= 8
""")
def cannot_link_conflicts(spark, d):
    s = table(spark, d, "supplier").filter("s_suppkey >= 8")
    labels = graph.components(s.select(F.col("s_suppkey").alias("a"), F.expr("s_suppkey div 2").alias("b")))
    cannot = s.select(F.col("s_suppkey").alias("source_id"), (F.col("s_suppkey") + 5).alias("target_id"))
    return graph.cannot_link_conflicts(labels, cannot).select("source_id", "target_id", "component")


@query("chain_terminal", """
    WITH RECURSIVE walk AS (SELECT c_custkey AS node, c_custkey AS pos, 0 AS length FROM customer UNION ALL SELECT node, pos // 3, length + 1 FROM walk WHERE pos >= 9)
    SELECT node, min(pos) AS terminal, max(length)::BIGINT AS length, 'ok' AS status FROM walk GROUP BY node
""")
def chain_terminal(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("node"))
    return graph.chain_terminals(c, c.filter("node >= 9").select("node", F.expr("node div 3").alias("target")))


@query("parent_depth", """
    SELECT p_partkey AS code, 'parent_missing' AS fault FROM part WHERE p_partkey % 7 <> 3 AND p_partkey >= 5 AND (p_partkey // 5) % 7 = 3
""")
def parent_depth(spark, d):
    units = table(spark, d, "part").filter("p_partkey % 7 <> 3").select(F.col("p_partkey").alias("code"), F.expr("case when p_partkey >= 5 then p_partkey div 5 end").alias("parent_code"))
    return graph.parent_faults(units)


@query("constrained_clusters")
def constrained_clusters(spark, d):
    s = table(spark, d, "supplier").filter("s_suppkey >= 8")
    edges = s.select(F.col("s_suppkey").alias("a"), F.expr("s_suppkey div 2").alias("b"))
    cannot = s.filter("s_suppkey % 10 = 0").select(F.col("s_suppkey").alias("a"), (F.col("s_suppkey") + 1).alias("b"))
    return graph.constrained_clusters(edges, cannot, ["a", "b"])


@query("chapman_by_stratum", """
    WITH e AS (SELECT c_mktsegment AS stratum, o_custkey, bool_or(o_orderdate < TIMESTAMP '1998-01-01') AS l, bool_or(o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F') AS r
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL HAVING l OR r),
    n AS (SELECT stratum, count(*) FILTER (l) AS n1, count(*) FILTER (r) AS n2, count(*) FILTER (l AND r) AS m, count(*) AS observed FROM e GROUP BY stratum),
    f AS (SELECT *, (n1 + 1.0::DOUBLE) * (n2 + 1.0::DOUBLE) / (m + 1) - 1 AS est, sqrt((n1 + 1.0::DOUBLE) * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1.0::DOUBLE) * (m + 1) * (m + 2))) AS sd, n1 > 0 AND n2 > 0 AND m > 0 AND least(m, n1 - m, n2 - m) >= 20 AS ok,
        list_sort(list_filter([CASE WHEN n1 = 0 OR n2 = 0 THEN 'empty_capture_group' END, CASE WHEN m > 0 AND least(m, n1 - m, n2 - m) < 20 THEN 'insufficient_interval_support' END, CASE WHEN m = 0 THEN 'no_overlap' END], lambda x: x IS NOT NULL)) AS reasons FROM n)
    SELECT stratum, n1 AS n_left, n2 AS n_right, m AS overlap, observed, CASE WHEN ok THEN 'estimated' ELSE 'unknown' END AS status, array_to_string(reasons, ',') AS reasons, CASE WHEN ok THEN round(est, 6) END AS estimate,
        CASE WHEN ok THEN round(greatest(observed::DOUBLE, est - 1.959963984540054 * sd), 6) END AS lower, CASE WHEN ok THEN round(est + 1.959963984540054 * sd, 6) END AS upper FROM f
""")  # fmt: skip
def chapman_by_stratum(spark, d):
    split = ntz("1998-01-01 00:00:00")
    rows = _observations(spark, d).withColumnRenamed("c_mktsegment", "stratum")
    out = estimation.chapman(rows, "o_custkey", ["stratum"], F.col("o_orderdate") < split, (F.col("o_orderdate") >= split) & (F.col("o_orderstatus") == "F"))
    return out.withColumns({c: F.round(c, 6) for c in ("estimate", "lower", "upper")} | {"reasons": F.array_join("reasons", ",")})


@query("content_addressed_artifacts", "SELECT sha256(text) AS checksum, max(strlen(text)) AS bytes, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_addressed_artifacts(spark, d):
    return evidence.content_addressed(table(spark, d, "documents").filter("text is not null"), "text")


@query("candidate_keys", """
    SELECT page_id, sha256('[' || coalesce('"' || replace(replace(url, '\\', '\\\\'), '"', '\\"') || '"', 'null') || ',"source"]') AS candidate_key FROM pages
""")
def candidate_keys(spark, d):
    return table(spark, d, "pages").select("page_id", canonical.candidate_key(F.col("url"), F.lit("source")).alias("candidate_key"))


@query("evidence_integrity", "SELECT count(*) AS violations FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)")
def evidence_integrity(spark, d):
    return evidence.integrity(table(spark, d, "lineitem"), table(spark, d, "orders"), "l_orderkey", "o_orderkey").agg(F.count("*").alias("violations"))


@query("normalized_locators", r"""
    SELECT page_id, lower(regexp_extract(url, '^(\w+://[^/?#]*)', 1)) || coalesce(nullif(regexp_extract(url, '^\w+://[^/?#]*([^?#]*)', 1), ''), '/') || regexp_extract(url, '^\w+://[^/?#]*[^?#]*(.*)$', 1) AS locator FROM pages
""")
def normalized_locators(spark, d):
    return table(spark, d, "pages").select("page_id", urls.normalize_url("url").alias("locator"))


@query("bounded_hints", """
    WITH f AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events)
    SELECT user_id, first(event_id ORDER BY nth) AS event_id, count(DISTINCT event_type)::INTEGER AS n_hints FROM f GROUP BY user_id
""")
def bounded_hints(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", F.lit("").alias("label"), F.col("event_type").alias("hint"))
    return evidence.first_wins(rows, ["user_id"], ["ts", "event_id"], "hint").select("user_id", "event_id", F.size("hints").alias("n_hints"))
