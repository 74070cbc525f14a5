from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sparrowgrid import cli
from sparrowgrid.operators import acquisition, coverage, evidence, inventory, planner, queue
from sparrowgrid.schemas import OBSERVATION
from sparrowgrid.store import Store

NAMES = [c.split()[0] for c in OBSERVATION.replace("\n", " ").split(",")]


def observations(spark, *changes):
    base = {"locator": "https://a.example.com/", "kind": "source", "method": "m", "method_version": "1", "origin_locator": "https://a.example.com/", "evidence_group": "g", "observed_at": "2026-01-01 00:00:00", "expires_at": "2026-02-01 00:00:00", "policy_ref": "p", "countries": ["FR"], "classes": ["car"], "source_type": "dealer_owned", "locality_code": "", "locality_country": "", "signals": "{}", "body_sha256": None}
    schema = OBSERVATION.replace("TIMESTAMP", "STRING")
    df = spark.createDataFrame([tuple((base | c)[n] for n in NAMES) for c in changes], schema)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("observed_at", "expires_at")})


def at(day):
    return F.lit(f"2026-01-{day:02d} 00:00:00").cast("timestamp")


def test_life_of_a_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    b = {"locator": "https://b.example.com/"}
    assert store.ingest(observations(spark, {}, {}, {"observed_at": "2026-01-05 00:00:00"}, b), at(6)).count() == 0
    rows = {r.locator: r for r in store.candidates().collect()}
    assert len(rows) == 2 and str(rows["https://a.example.com/"].last_observed_at) == "2026-01-05 00:00:00"
    assert store.table("evidence").count() == 3
    # A shorter retention shrinks, a longer one doesn't stretch.
    store.ingest(observations(spark, {"expires_at": "2026-01-20 00:00:00"}, b | {"expires_at": "2027-01-01 00:00:00"}), at(6))
    assert store.table("evidence").count() == 3 and store.table("evidence").filter("expires_at = timestamp'2026-01-20'").count() == 1
    before = store.versions()
    assert store.ingest(observations(spark, {}, {"kind": "nothing"}), at(6)).count() == 1 and store.versions() == before
    ids = {r.locator: r.candidate_id for r in store.candidates().collect()}
    a, b = ids["https://a.example.com/"], ids["https://b.example.com/"]
    propose = lambda *rows: spark.createDataFrame(rows, "candidate_id string, expected_revision long, status string, target_id string, actor string, reason string")
    assert store.decide(propose((a, 0, "duplicate_candidate", b, "x", "same")), at(7)).count() == 0
    refused = store.decide(propose((a, 0, "accepted", None, "x", "late"), (b, 0, "accepted", a, "x", "r"), (b, 0, "perhaps", None, "x", "r")), at(7))
    assert {r.fault for r in refused.collect()} == {"stale_revision", "target_only_with_duplicate", "unknown_status"}
    out = {r.candidate_id: r for r in store.export(at(8)).collect()}
    assert out[a].blocked is None and out[a].decision_status == "duplicate_candidate" and str(out[a].review_due_at) == "2026-01-20 00:00:00"
    evidence_id = store.table("evidence").filter(F.col("candidate_id") == b).first().evidence_id
    relation = spark.createDataFrame([("r1", a, b, "cannot_link", evidence_id, "x")], "relation_id string, source_id string, target_id string, kind string, evidence_id string, actor string").withColumn("recorded_at", at(8))
    assert store.relate(relation, at(8)).count() == 0
    assert store.decide(propose((b, 0, "accepted", None, "x", "r")), at(9)).first().fault == "violates_cannot_link"
    assert store.expire(at(25)) == 1 and store.expire(at(25)) == 0
    assert store.ingest(observations(spark, {}), at(26)).count() == 0 and store.table("evidence").count() == 2
    store.suppress(spark.createDataFrame([(a,)], "candidate_id string"), at(26))
    assert store.table("evidence").count() == 1 and store.table("relations").count() == 0 and store.table("decisions").count() == 0
    store.ingest(observations(spark, {"observed_at": "2026-01-09 00:00:00"}), at(27))
    assert store.table("evidence").count() == 1 and {r.candidate_id: r.blocked for r in store.export(at(27)).collect()} == {a: "suppressed", b: None}
    assert not any(store.doctor().values())


def test_artifacts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    put = lambda *rows: store.put_artifacts(spark.createDataFrame([(bytearray(b), e) for b, e in rows], "body binary, e string").select("body", F.col("e").cast("timestamp").alias("expires_at")))
    put((b"x", "2026-03-01"), (b"y", "2026-02-01"))
    put((b"x", "2026-02-15"))
    assert sorted(str(r.expires_at)[:10] for r in store.table("artifacts").collect()) == ["2026-02-01", "2026-02-15"]


def test_a_lost_race_changes_nothing(spark, tmp_path, monkeypatch):
    one, two = (Store(spark, str(tmp_path / "s")) for _ in range(2))
    one.ingest(observations(spark, {}), at(2))
    stale = two.versions()
    one.ingest(observations(spark, {"locator": "https://b.example.com/"}), at(2))
    monkeypatch.setattr(two, "versions", lambda: stale)
    with pytest.raises(Exception):  # noqa: B017
        two.commit({"log": two.table("log")})
    assert one.table("evidence").count() == 2


def test_commands(spark, tmp_path, capsys):
    page = tmp_path / "p.html"
    page.write_text("<meta name=generator content='Drupal 10'><a href='/stock'>Stock</a>")
    cli.main(["inspect-file", "--file", str(page), "--origin", "https://a.example.com/", "--content-type", "text/html"])
    cli.main(["technology", "--file", str(page), "--origin", "https://a.example.com/", "--content-type", "text/html"])
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert out[0]["locator"] == "https://a.example.com/stock" and out[1]["detections"][0]["name"] == "Drupal"
    lines = tmp_path / "o.jsonl"
    observations(spark, {}).withColumn("signals", F.lit("{}")).toJSON().saveAsTextFile(str(lines))
    cli.main(["ingest", "--store", str(tmp_path / "s"), "--file", str(lines), "--now", "2026-01-02"])
    cli.main(["coverage", "--store", str(tmp_path / "s"), "--countries", "FR,DE", "--now", "2026-01-02"])
    cells = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert sum(c.get("candidates", 0) for c in cells) == 1 and len(cells) == 2 * 4 * 8 + 1
    cli.main(["export", "--store", str(tmp_path / "s"), "--now", "2026-01-02"])
    cli.main(["expire", "--store", str(tmp_path / "s"), "--now", "2026-03-02"])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"evidence_removed": 1}
    with pytest.raises(SystemExit) as e:
        cli.main(["doctor", "--store", str(tmp_path / "s")])
    assert e.value.code == 0


def bundle(**changes):
    whole = {
        "source": {"source_id": "s", "lifecycle": "onboarding"}, "surface": {"source_id": "s", "surface_id": "u", "admission_id": "a"},
        "stream": {"stream_id": "t", "source_id": "s", "surface_id": "u", "admission_id": "a", "capability_manifest_id": "c", "scope_revision": "1", "market_countries": ["FR"], "vehicle_classes": ["car"]},
        "admission": {"admission_id": "a", "surface_id": "u", "status": "approved", "acquire_inventory": True, "valid_from": "2026-01-05", "valid_until": "2026-03-05", "review_due_at": "2026-02-20", "market_countries": ["FR", "DE"], "vehicle_classes": ["car"]},
        "capability": {"capability_manifest_id": "c", "surface_id": "u", "capabilities_verified_at": "2026-01-05", "revalidate_at": "2026-02-05"},
        "plan": {"stream_id": "t", "capability_manifest_id": "c", "scope_revision": "1", "max_partitions": 2, "partitions": [{"partition_id": "1", "partition_key": "x"}]},
    }
    for path, value in changes.items():
        record, name = path.split("__")
        whole[record] = whole[record] | {name: value}
    return whole


def test_acquisition(spark):
    cases = [
        ({}, []), ({"admission__valid_until": "2026-01-01"}, ["admission_review", "admission_window"]), ({"admission__vehicle_classes": ["lcv"]}, ["scope_classes"]), ({"stream__source_id": "z"}, ["source"]),
        ({"plan__scope_revision": "2"}, ["scope_revision"]), ({"capability__revalidate_at": "2026-01-04"}, ["capability_window"]), ({"plan__partitions": [{"partition_id": "1", "partition_key": "x"}] * 3}, ["partition_budget", "partition_ids", "partition_keys"]),
    ]
    rows = [json.dumps(bundle(**c)) for c, _ in cases] + [json.dumps(bundle(**c)) for c in ({"source__lifecycle": "retired"}, {"admission__status": "revoked"}, {"admission__acquire_inventory": False})]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, j string").select("k", F.from_json("j", acquisition.BUNDLE).alias("b")).select("k", "b.*")
    out = df.select("k", acquisition.faults().alias("f"), *[acquisition.may_acquire(F.lit(t).cast("timestamp")).alias(n) for t, n in (("2026-01-05", "first"), ("2026-02-05", "capability_over"), ("2026-01-04", "early"))]).orderBy("k").collect()
    assert [r.f for r in out[: len(cases)]] == [w for _, w in cases]
    assert [r.first for r in out] == [True] + [False] * 9 and not any(r.capability_over or r.early for r in out)
    tables = [df.limit(1).select(f"{n}.*") for n in ("source", "surface", "stream", "admission", "capability", "plan")]
    assert acquisition.bundles(*tables).select(F.size(acquisition.faults()).alias("n")).first().n == 0


def test_page_windows_are_resumed_once(spark):
    work = spark.createDataFrame([("a", "partial", 3, 2, "9", "S"), ("b", "done", 3, 2, "9", "S"), ("c", "deferred", 2, 2, "9", "S"), ("d", "partial", 3, 2, "9", "S"), ("e", "partial", 3, 2, "9", "S")], "task_key string, status string, channel_page int, max_pages int, cursor string, scope string")
    receipts = spark.createDataFrame([("d", "b1"), ("e", "b0")], "task_key string, binding string")
    reviews = spark.createDataFrame([(k, "b1", "T" if k == "x" else "S", "me", "r") for k in "abcde"] + [("a", "b2", "T", "me", "r")], "task_key string, binding string, scope string, actor string, reason string")
    fresh, refused = queue.resume_window(work, receipts, reviews)
    assert [r.supersedes for r in fresh.collect()] == ["a"]
    assert {(r.task_key, r.fault) for r in refused.collect()} == {("b", "nothing_to_resume"), ("c", "not_page_window_debt"), ("e", "resumed_with_another_review"), ("a", "scope_changed")}


def test_schedules_plans_and_views(spark):
    s = spark.createDataFrame([("s", 100, 10, 0, 1)], "schedule_id string, next_at long, interval_seconds long, offset long, last_tick long")
    done = spark.createDataFrame([("s", True, 7, 5)], "schedule_id string, complete boolean, next_offset long, turn long")
    assert tuple(planner.advance(s, done).first()) == ("s", 110, 10, 0, 5)
    assert tuple(planner.advance(s, done.withColumn("complete", F.lit(False))).first()) == ("s", 100, 10, 7, 5)
    runs = spark.createDataFrame([("s", k, "p", 1, True) for k in range(5)], "schedule_id string, due_at int, plan_id string, tasks_generated int, generation_complete boolean")
    seen = planner.inspect_schedule(s, runs, 3).first()
    assert [g.due_at for g in seen.generations] == [0, 1, 2] and seen.truncated
    pages = spark.createDataFrame([("p", 0, 10), ("p", 5, 10), ("q", 0, 4), ("q", 4, 5)], "plan_id string, offset int, total_tasks int")
    last, wrong = coverage.latest_plan_pages(pages)
    assert [(r.plan_id, r.offset) for r in last.collect()] == [("p", 5)] and [r.plan_id for r in wrong.collect()] == ["q"]
    view = spark.createDataFrame([(1, "FR", "car", "x", 5), (2, "DE", "car", "x", 9), (3, "FR", "lcv", "y", 7), (4, "FR", "car", "x", None)], "item_id int, market_country string, vehicle_class string, presence_state string, updated_at int")
    assert [r.item_id for r in inventory.listed(view, ["FR"], ["car", "lcv"], sort=[("updated_at", True)]).collect()] == [3, 1, 4]
    assert inventory.listed(view, updated_after=F.lit(6)).count() == 2
    assert evidence.technology_claims(spark.createDataFrame([(1, "https://a.example.com/")], "page_id long, origin string"), spark.createDataFrame([(1, [("cms", "X")], [("https://a.example.com/stock", "a[1]", "r")], "unknown")], "page_id long, detections array<struct<category: string, name: string>>, inventory_surfaces array<struct<locator: string, selector: string, rule: string>>, dynamic_rendering_required string")).count() == 2


def test_schedules_policies_and_work(spark, tmp_path):
    from sparrowgrid import agenda

    store = Store(spark, str(tmp_path / "a"))
    spec = {"schedule_id": "s1", "profiles": [], "localities": [], "starts_at": "2026-01-01T00:00:00Z", "interval_seconds": 86400}
    assert agenda.register_schedule(store, spec, "me", at(1))["created"] and not agenda.register_schedule(store, spec, "you", at(2))["created"]
    with pytest.raises(agenda.Conflict):
        agenda.register_schedule(store, spec | {"interval_seconds": 60}, "me", at(2))
    for bad in ({"interval_seconds": 0}, {"interval_seconds": True}, {"schedule_id": "-"}, {"starts_at": "2026-01-01T00:00:00"}, {"more": 1}):
        with pytest.raises(ValueError):
            agenda.register_schedule(store, spec | {"schedule_id": "s2"} | bad, "me", at(2))
    assert agenda.due(store, at(3)).count() == 3
    windows = agenda.due(store, at(2)).select("schedule_id", "due_at", F.lit("p").alias("plan_id"), F.lit(5).cast("long").alias("tasks_generated"), F.lit(True).alias("generation_complete"))
    agenda.generated(store, windows)
    assert agenda.due(store, at(3)).count() == 1
    agenda.set_paused(store, "s1", True, "me", "review", at(3))
    assert agenda.due(store, at(9)).count() == 0 and agenda.inspect(store).first().paused
    agenda.set_paused(store, "s1", False, "me", "go on", at(4))
    assert agenda.due(store, at(3)).count() == 1 and [r.action for r in store.table("schedule_events").orderBy("seq").collect()] == ["registered", "paused", "resumed"]
    with pytest.raises(agenda.Conflict):
        agenda.set_paused(store, "none", True, "me", "x", at(4))
    ref = agenda.register_policy(store, "p1", {"hosts": ["a.example.com"]}, at(1))
    agenda.register_policy(store, "p1", {"hosts": ["a.example.com"]}, at(2))
    with pytest.raises(agenda.Conflict):
        agenda.register_policy(store, "p1", {"hosts": []}, at(2))
    asked = spark.createDataFrame([("p1", ref["checksum"]), ("p1", "x"), ("p2", "x")], "policy_ref string, checksum string")
    assert [r.fault for r in agenda.check_policies(store, asked).orderBy("policy_ref", F.desc("checksum")).collect()].count(None) == 1
    agenda.revoke_policy(store, "p1", "me", "ended", at(5))
    assert {r.fault for r in agenda.check_policies(store, asked).collect()} == {"revoked_policy", "changed_policy", "unknown_policy"}
    with pytest.raises(agenda.Conflict):
        agenda.register_policy(store, "p1", {"hosts": ["a.example.com"]}, at(6))
    tasks = spark.createDataFrame([(f"t{k}", "{}", ["pending", "blocked", "partial"][k % 3], k >= 4) for k in range(8)], "task_key string, payload string, status string, deferred boolean")
    assert agenda.save_plan(store, "plan", 8, 0, None, tasks, at(1)).count() == 0 and agenda.save_plan(store, "plan", 8, 0, None, tasks, at(1)).count() == 0
    assert store.table("tasks").count() == 8 and store.table("plans").count() == 2
    assert agenda.save_plan(store, "plan", 8, 0, None, tasks.withColumn("payload", F.lit("other")), at(1)).count() == 8
    agenda.requeue(store, ["t0", "t1", "t2"], "again")
    assert {r.task_key: r.status for r in store.table("tasks").collect()} == {f"t{k}": "pending" if k < 3 or k % 3 == 0 else ["", "blocked", "partial"][k % 3] for k in range(8)}
    assert agenda.release(store, 3) == 3 and store.table("tasks").filter("deferred").count() == 1


def test_tables_that_are_added_to_have_parts(spark, tmp_path, monkeypatch):
    import sparrowgrid.store as module

    monkeypatch.setattr(module, "MOST_PARTS", 3)
    store = Store(spark, str(tmp_path / "p"))
    for k in range(5):
        store.commit({}, {"log": spark.createDataFrame([("k", str(k))], "kind string, entity string").withColumn("recorded_at", at(1))})
    assert sorted(r.entity for r in store.table("log").collect()) == list("01234") and len(store.versions()[1]["log"]) == 2
