"""The small models: every order of delivery ends alike, limits hold, golden values match."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparrowgrid.operators import capacity, changefeed, coverage, estimation, evidence, graph, inventory, order, planner, presence, queue
from sparrowgrid.streaming import leases


def event(i, at, kind="census", complete=True, present=False, verified=False):
    return (i, at, kind, complete, True, present, verified)


SCHEDULES = [
    ([event("C1", 10), event("C2", 20), event("C3", 30)], ("not_observed", 2)),
    ([event("C1", 10), event("C2", 20, complete=False), event("C3", 30)], ("absence_suspected", 1)),
    ([event("C1", 10), event("P1", 15, "positive"), event("C3", 30)], ("absence_suspected", 3)),
    ([event("C1", 10), event("W1", 12, "withdraw", verified=True), event("C3", 30)], ("withdrawn", 2)),
    ([event("C1", 10), event("W1", 12, "withdraw"), event("C2", 20)], ("not_observed", 2)),
    ([event("C1", 10), event("C2", 15), event("C3", 20)], ("not_observed", 2)),
    ([event("C1", 10), event("S1", 20, present=True, complete=False)], ("observed_present", 2)),
]


def test_presence_in_every_order(spark):
    rows, want = [], {}
    for k, (schedule, result) in enumerate(SCHEDULES):
        for n, order in enumerate(itertools.permutations([*schedule, schedule[0]])):
            rows += [(f"{k}-{n}", *e) for e in order]
            want[f"{k}-{n}"] = result
    df = spark.createDataFrame(rows, "key string, id string, at long, kind string, complete boolean, comparable boolean, present boolean, verified boolean")
    assert {r.key: (r.state, r.effects) for r in presence.states(df, "key", F.lit(10)).collect()} == want
    clash = spark.createDataFrame([("k", *event("C1", 10)), ("k", *event("C1", 20)), ("k", *event("C2", 20)), ("k", *event("C2", 20))], df.schema)
    assert [r.id for r in presence.conflicting_ids(clash, "key").collect()] == ["C1"]


def test_filtered_feed_at_every_cut(spark):
    log = [("A", "car", 10), ("B", "moto", 9), ("A", "car", 21), ("B", "car", 19), ("C", "car", 25), ("A", None, None), ("C", "car", 18)]
    feed = spark.createDataFrame([(k, n + 1, (c, p) if c else None) for n, (k, c, p) in enumerate(log)], "key string, seq int, after struct<class: string, price: int>")
    tests = [lambda a: (a["class"] == "car") & (a["price"] <= 20), lambda a: a["class"] == "moto", lambda a: F.lit(True)]
    plain = [lambda c, p: c == "car" and p <= 20, lambda c, p: c == "moto", lambda c, p: True]
    for visible, holds in zip(tests, plain):
        actions = [(r.seq, r.key, r.action) for r in changefeed.filtered(feed, "key", "seq", "after", visible).orderBy("seq").collect()]
        states = [{}]
        for k, c, p in log:
            states.append({**states[-1], k: (c, p)} if c else {x: v for x, v in states[-1].items() if x != k})
        seen = [{k for k, v in s.items() if holds(*v)} for s in states]
        for cut in range(len(states)):
            client = set(seen[cut])
            for seq, key, action in actions[cut:]:
                client = client | {key} if action == "upsert" else client - {key} if action == "remove" else client
                assert client == seen[seq]


def test_golden_estimate(spark):
    rows = [(k, "l") for k in range(400)] + [(k, "r") for k in range(200, 700)]
    df = spark.createDataFrame(rows * 2, "entity int, g string").withColumn("s", F.lit("one"))
    r = estimation.chapman(df, "entity", ["s"], F.col("g") == "l", F.col("g") == "r").first()
    assert (r.n_left, r.n_right, r.overlap, r.observed, r.status) == (400, 500, 200, 700, "estimated")
    assert abs(r.estimate - 998.5074626865671) < 1e-9 and abs(r.upper - r.estimate - 75.32567347334486) < 1e-6
    few = estimation.chapman(df.filter("entity < 210"), "entity", ["s"], F.col("g") == "l", F.col("g") == "r").first()
    assert few.status == "unknown" and few.estimate is None and few.reasons == ["insufficient_interval_support"]


def test_estimator_blocks(spark):
    now, start, end = (F.lit(t).cast("timestamp") for t in ("2026-06-01", "2026-01-01", "2026-03-01"))
    schema = "entity_id string, source_id string, identity_status string, review_status string, evidence_ref string, observed_at timestamp, expires_at timestamp, stratum struct<c: string>"
    rows = [(f"e{k}", s, "resolved", "accepted", f"{s}{k}", "2026-02-01", "2027-01-01", ("FR",)) for k in range(100) for s in ("a", "b") if (k < 70 if s == "a" else k >= 30)]
    gschema = "id string, sources array<string>, independent boolean, evidence_ref string, observed_at timestamp, expires_at timestamp, depends_on array<string>"
    groups = [("L", ["a"], True, "x", "2026-01-01", "2027-01-01", []), ("R", ["b"], True, "y", "2026-01-01", "2027-01-01", [])]

    def table(data, kind):
        base = spark.createDataFrame(data, kind.replace(" timestamp", " string"))
        return base.withColumns({c: F.col(c).cast("timestamp") for c in ("observed_at", "expires_at")})

    run = lambda r, g: estimation.estimate_stratum(table(r, schema), table(g, gschema), {"c": "FR"}, now, start, end).first()
    good = run(rows, groups)
    assert good.status == "estimated" and (good.n_left, good.n_right, good.overlap, good.observed) == (70, 70, 40, 100)
    bad = rows + [("e1", "c", "open", "accepted", " ", "2026-04-01", "2026-05-01", ("DE",))]
    r = run(bad, groups)
    assert r.status == "unknown" and r.observed == 100 and r.reasons == ["expired_capture", "invalid_capture_window", "missing_capture_evidence", "source_group_unknown", "stratum_mismatch", "unresolved_identity"]
    r = run(rows, [groups[0], ("R", ["b", "a"], False, "", "2026-01-01", "2026-02-01", ["L"])])
    assert r.status == "unknown" and {"dependent_capture_groups", "expired_independence_evidence", "independence_not_declared", "missing_independence_evidence", "shared_source_between_groups"} <= set(r.reasons)
    assert "two_independent_groups_required" in run(rows, groups[:1]).reasons


def test_round_robin_pages_equal_the_whole_order(spark):
    rng = random.Random(4)
    for _ in range(3):
        lengths = [rng.choice([0, 1, 2, 5, 5, 9]) for _ in range(6)]
        whole = sorted(((i, lane) for lane, n in enumerate(lengths) for i in range(n)))
        lanes = spark.createDataFrame([*enumerate(lengths)], "lane long, length long")
        for offset in range(0, len(whole) + 1, 4):
            page = sorted((r.ordinal, r["index"], r.lane) for r in planner.round_robin_page(lanes, "lane", "length", offset, 5).collect())
            assert page == [(offset + k, *x) for k, x in enumerate(whole[offset : offset + 5])]


def test_deep_page_of_a_large_frontier(spark):
    lanes = spark.createDataFrame([(0, 2), (1, 4_000_000), (2, 4_000_000)], "lane long, length long")
    page = planner.round_robin_page(lanes, "lane", "length", 7_999_999, 3).collect()
    assert sorted((r.ordinal, r.lane, r["index"]) for r in page) == [(7_999_999, 2, 3_999_998), (8_000_000, 1, 3_999_999), (8_000_001, 2, 3_999_999)]


def test_templates(spark):
    fill = lambda t: spark.range(1).select(planner.fill_template(F.lit(t), F.lit("Lyon"), F.lit("car")).alias("x")).first().x
    for t in ("{vehicle_term} in {locality}", "{{x}} {locality}", "{{{locality}}}"):
        assert fill(t) == t.format(locality="Lyon", vehicle_term="car")


def test_frontier_of_profiles(spark):
    from sparrowgrid.schemas import PROFILE

    s = {"id": "s1", "family": "f", "evidence_group": "g", "priority": 5, "access_mode": "public_web", "source_type": "auction", "seed_urls": ["https://a.example.com/", "https://a.example.com/"], "query_templates": {"fr": ["{vehicle_term} {locality}", "dealers {locality} {{vehicle_term}}"]}, "notes": "", "source_ids": ["x"], "vehicle_classes": ["car", "lcv"]}
    p = {"schema_version": "1", "country": "FR", "name": "n", "languages": ["fr"], "vehicle_classes": ["car", "lcv"], "geography": None, "strategies": [s], "vocabulary": {"fr": {"car": ["auto", "voiture"], "lcv": ["fourgon"]}}, "sources": [], "blind_spots": [], "review_days": 30}
    profiles = spark.createDataFrame([p], PROFILE)
    assert [(r.seeds, r.queries) for r in planner.query_count(profiles).collect()] == [(1, 4)]
    places = spark.createDataFrame([("FR", "01", "Lyon", None), ("FR", "02", "Nice", "Sud")], "country string, code string, name string, region string")
    queries = sorted(r.query for r in planner.query_tasks(profiles, places).collect())
    assert len(queries) == 8 and "voiture Nice, Sud, FR" in queries and "dealers Lyon, FR {vehicle_term}" in queries


def test_claims_follow_the_queue(spark):
    rng = random.Random(9)
    tasks = [(k, rng.randrange(5), rng.randrange(3), rng.randrange(3)) for k in range(60)]
    last = {s: rng.randrange(2) for s in range(5)}
    df = spark.createDataFrame([(k, s, c, p, last[s]) for k, s, c, p in tasks], "task_key int, stratum int, created_at int, priority int, last_claim int")
    order, seq, waiting, turn = [], 10, list(tasks), dict(last)
    while waiting:
        t = min(waiting, key=lambda x: (turn[x[1]], x[2], -x[3], x[0]))
        waiting.remove(t)
        order.append(t[0])
        turn[t[1]] = seq = seq + 1
    assert [r.task_key for r in queue.claim_order(df).orderBy("claim").collect()] == order


def test_leases():
    class R:
        def __init__(self, action, at=0.0, token=None, until=0.0, status=None):
            self.action, self.at, self.token, self.lease_until, self.status = action, at, token, until, status

    state, answers = (None, None, 0.0, 0), []
    for r in (R("enqueue"), R("enqueue"), R("claim", 1, "t1", 10), R("claim", 2, "t2", 20), R("finish", 11, "t1", status="done"), R("claim", 12, "t2", 20), R("finish", 13, "t1", status="done"), R("finish", 13, "t2", status="partial"), R("requeue", 14)):
        state, answer = leases.apply(state, r)
        answers.append(answer)
    assert answers == ["accepted", "known", "accepted", "refused", "fenced", "accepted", "fenced", "accepted", "accepted"] and state == ("pending", None, 0.0, 2)


def test_lease_stream(spark, tmp_path):
    rows = [("a", 1, 0.0, "enqueue", None, 0.0, None), ("a", 2, 1.0, "claim", "t", 9.0, None), ("a", 3, 2.0, "finish", "t", 0.0, "done"), ("b", 4, 1.0, "claim", "t", 9.0, None)]
    spark.createDataFrame(rows, leases.REQUEST).write.parquet(str(tmp_path / "in"))
    from sparrowgrid.streaming import tables

    out = tables.drain(leases.answers(spark.readStream.schema(leases.REQUEST).parquet(str(tmp_path / "in"))), "leases")
    assert {(r.seq, r.answer, r.status) for r in out.collect()} == {(1, "accepted", "pending"), (2, "accepted", "running"), (3, "accepted", "done"), (4, "refused", None)}


def test_finish_under_fence(spark):
    tasks = spark.createDataFrame([("a", "running", "", 0.0, "t", 9.0), ("b", "running", "", 0.0, "t", 1.0), ("c", "pending", "", 0.0, None, None)], "task_key string, status string, reason string, not_before double, lease_token string, lease_until double")
    said = spark.createDataFrame([("a", "t", "done", "", 0.0), ("b", "t", "done", "", 0.0)], "task_key string, lease_token string, status string, reason string, retry_at double")
    after, fenced = queue.finish(tasks, said, F.lit(5.0))
    assert {r.task_key: r.status for r in after.collect()} == {"a": "done", "b": "running", "c": "pending"} and [r.task_key for r in fenced.collect()] == ["b"]
    back = queue.requeue(after, spark.createDataFrame([("a", "r"), ("c", "r")], "task_key string, reason string"))
    assert {r.task_key: r.status for r in back.collect()} == {"a": "done", "b": "running", "c": "pending"}


def test_constrained_clusters(spark):
    edges = spark.createDataFrame([("A", "B", 1), ("B", "C", 2), ("X", "Y", 3)], "a string, b string, n int")
    cannot = spark.createDataFrame([("A", "C")], "a string, b string")
    out = {r.node: r.cluster for r in graph.constrained_clusters(edges, cannot, ["n"]).collect()}
    assert out == {"A": "A", "B": "A", "X": "X", "Y": "X"} or out == {"A": "A", "B": "A", "C": "C", "X": "X", "Y": "X"}
    free = {r.node: r.cluster for r in graph.constrained_clusters(edges, cannot.limit(0), ["n"]).collect()}
    assert free == {"A": "A", "B": "A", "C": "A", "X": "X", "Y": "X"}


def test_chains_and_parents(spark):
    nodes = spark.createDataFrame([(x,) for x in "ABCDEFG"], "node string")
    step = spark.createDataFrame([("A", "B"), ("B", "C"), ("D", "E"), ("E", "D")], "node string, target string")
    out = {r.node: (r.terminal, r.status) for r in graph.chain_terminals(nodes, step).collect()}
    assert out == {"A": ("C", "ok"), "B": ("C", "ok"), "C": ("C", "ok"), "D": (None, "cycle_or_too_deep"), "E": (None, "cycle_or_too_deep"), "F": ("F", "ok"), "G": ("G", "ok")}
    units = spark.createDataFrame([("1", None), ("2", "1"), ("3", "9"), ("4", "5"), ("5", "4")], "code string, parent_code string")
    assert {(r.code, r.fault) for r in graph.parent_faults(units).collect()} == {("3", "parent_missing"), ("4", "cycle_or_too_deep"), ("5", "cycle_or_too_deep")}


def test_frontier_expansion(spark):
    links = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "d"), ("b", "a"), ("c", "e"), ("e", "f")], "source string, target string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert {(r.url, r.depth) for r in graph.expand_frontier(seeds, links, 2, 2).collect()} == {("a", 0), ("b", 1), ("c", 1), ("e", 2)}


def test_ownership_needs_both_sides(spark):
    schema = "transfer_id string, dealer string, from_epoch int, to_epoch int, generation_id string"
    want = spark.createDataFrame([("T1", "D1", 1, 2, "D1-G2"), ("T1", "D2", 1, 2, "D2-G2")], schema)
    for rows, epoch in (([], 1), ([0], 1), ([1], 1), ([0, 1], 2)):
        got = spark.createDataFrame([want.collect()[k] for k in rows], schema)
        assert inventory.ownership_gate(got, want).first().epoch == epoch
    stale = want.withColumn("generation_id", F.when(F.col("dealer") == "D2", "OLD").otherwise(F.col("generation_id")))
    assert inventory.ownership_gate(stale, want).first().epoch == 1


def test_empty_coverage_is_zero_with_an_unknown_ratio(spark):
    facts = spark.createDataFrame([], "country string, class string, candidates long, groups array<string>")
    axes = [spark.createDataFrame([(c,) for c in ("ES", "FR", "DE", "NL", "BE", "CH")], "country string"), spark.createDataFrame([(k,) for k in range(32)], "class int").withColumn("class", F.col("class").cast("string"))]
    grid = coverage.dense(facts, axes, ["candidates"], ["groups"])
    assert grid.count() == 192 and grid.filter("candidates = 0 and coverage_ratio is null and size(groups) = 0").count() == 192


def test_claims_do_not_cross(spark):
    rows = spark.createDataFrame([(1, ["FR"], ["car"], "g", 1), (1, ["DE"], ["lcv"], "h", 2), (2, ["FR"], ["car", "lcv"], "g", 3)], "id int, countries array<string>, classes array<string>, g string, at int")
    found = {(r.country, r["class"]): (r.candidates, r.evidence_groups) for r in coverage.cells(rows, {"country": "countries", "class": "classes"}, "id", "g", "at").collect()}
    assert found == {("FR", "car"): (2, ["g"]), ("FR", "lcv"): (1, ["g"]), ("DE", "lcv"): (1, ["h"])}


def test_capacity(spark):
    p = spark.createDataFrame([(10.0,)], "x double")
    r = capacity.evaluate(p, {"c": "ceil(b / 3)", "b": "a * x + max(1, 2)", "lost": "nowhere + 1"}, {"a": 2}).first()
    assert (r.b, r.c) == (22.0, 8.0) and "lost" not in r.asDict()
    for bad in ("__import__('os')", "x ** 2", "x if x else 1"):
        with pytest.raises(ValueError):
            capacity.evaluate(p, {"y": bad}, {})


def test_admission_and_outcome(spark):
    base = {"kind": "fetch", "bound": False, "access_mode": "public_web", "exclusion": None, "host_allowed": True, "policy_expires_at": 10.0, "depth": 1, "max_depth": 3, "origin_ready_at": 0.0}
    cases = [({}, None), ({"kind": "query"}, "human_or_approved_search_provider_required"), ({"access_mode": "manual_review"}, "method_requires_independent_access_review"), ({"exclusion": "media_or_asset"}, "outside_discovery_boundary"), ({"host_allowed": False}, "host_not_in_explicit_policy"), ({"policy_expires_at": 5.0}, "policy_expired"), ({"depth": 4}, "depth_budget_requires_review"), ({"origin_ready_at": 6.0}, "shared_origin_cooldown"), ({"kind": "query", "exclusion": "x"}, "human_or_approved_search_provider_required")]
    df = spark.createDataFrame([base | c for c, _ in cases], "kind string, bound boolean, access_mode string, exclusion string, host_allowed boolean, policy_expires_at double, depth int, max_depth int, origin_ready_at double")
    assert [r.r and r.r.reason for r in df.select(queue.admission(F.lit(5.0)).alias("r")).collect()] == [w for _, w in cases]
    ok = {"http_status": 200, "deferred_children": 0, "is_channel": False, "complete": None, "warnings": [], "signals": [(None, False, False)], "repeated_cursor": False}
    cases = [({}, ("done", "")), ({"http_status": 429}, ("retry", "http_429")), ({"http_status": 503}, ("retry", "http_503")), ({"http_status": 404}, ("blocked", "http_404_not_discovery_evidence")), ({"deferred_children": 1}, ("partial", "frontier_deferred_by_depth_or_child_budget")), ({"is_channel": True}, ("partial", "channel_limits_or_uncertainty")), ({"signals": []}, ("partial", "no_candidate_hints_not_proof_of_absence")), ({"signals": [], "is_channel": True, "complete": True}, ("done", "")), ({"signals": [("closed_claim", False, False)]}, ("partial", "access_or_activity_claim_requires_review")), ({"repeated_cursor": True}, ("partial", "channel_repeated_cursor"))]
    df = spark.createDataFrame([ok | c for c, _ in cases], "http_status int, deferred_children int, is_channel boolean, complete boolean, warnings array<string>, signals array<struct<access_state: string, requires_access_review: boolean, truncated_or_dynamic: boolean>>, repeated_cursor boolean")
    assert [(r.r.state, r.r.reason) for r in df.select(queue.outcome().alias("r")).collect()] == [w for _, w in cases]


def test_relations_are_refused_with_reasons(spark):
    now = F.lit("2026-01-10").cast("timestamp")
    facts = spark.createDataFrame([("e1", "c1", "2026-01-01", "2026-02-01"), ("e2", "c1", "2026-01-01", "2026-01-05")], "evidence_id string, candidate_id string, o string, x string").select("evidence_id", "candidate_id", F.col("o").cast("timestamp").alias("observed_at"), F.col("x").cast("timestamp").alias("expires_at"))
    people = spark.createDataFrame([("c1", False), ("c2", False), ("c3", True)], "candidate_id string, suppressed boolean")
    rows = [("c1", "c2", "operates", "e1", "a"), ("c1", "c1", "operates", "e1", "a"), ("c1", "c3", "operates", "e1", "a"), ("c1", "c2", "likes", "e1", "a"), ("c1", "c2", "operates", "e2", "a")]
    ok, wrong = evidence.relate(spark.createDataFrame(rows, "source_id string, target_id string, kind string, evidence_id string, actor string"), facts, people, now)
    assert ok.count() == 1 and {r.fault for r in wrong.collect()} == {"distinct_candidates_and_actor_required", "candidate_not_live", "unknown_kind", "evidence_not_available"}


@pytest.mark.parametrize("ranges", [1, 2, 3, 5, 16, 200])
def test_order_by_ranges(spark, ranges):
    values = [None, float("-inf"), float("inf")] + [float(k * k % 97) for k in range(300)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id long, v double")
    # A long expression as key: it is evaluated once a row, not for each bound.
    rows = order.ranked(df.withColumn("k", F.regexp_replace(F.col("v").cast("string"), "x", "").cast("double")), "k", "place", equal=True, ranges=ranges)
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
    key = [float("-inf") if v is None else v for v in values]
    nulls = sum(v is None for v in values)
    want = {k: 1 if v is None else 1 + nulls + sum(x < v for x, y in zip(key, values) if y is not None) for k, v in enumerate(values)}
    assert {r.id: r.place for r in rows.collect()} == want
    sums = order.before(df.filter("v = 4 or id > 290"), "id", "id", "sum", ranges=ranges).collect()
    assert all(r["sum"] == sum(x.id for x in sums if x.id < r.id) for r in sums)
