"""Schedules, policies, plans and work of a store. Definitions never change; what happens to them is added as events, and state is a fold over these."""

from __future__ import annotations

import json
import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.canonical import canonical_json, digest
from .operators import planner, queue
from .store import Store

# Bounds.
MOST_SCHEDULES, MOST_INTERVAL, MOST_SPEC, MOST_ACTOR, MOST_REASON = 1000, 366 * 86400, 8 * 1024 * 1024, 256, 2000
SPEC = {"schedule_id", "profiles", "localities", "starts_at", "interval_seconds"}
OPTIONS = {"channels", "catalogues"}


class Conflict(ValueError):
    """What is asked for contradicts what is stored."""


def _said(actor: str, reason: str = "-") -> None:
    if not isinstance(actor, str) or not actor.strip() or len(actor) > MOST_ACTOR or re.search(r"[\x00-\x1f]", actor):
        raise ValueError("actor")
    if not isinstance(reason, str) or not reason.strip() or len(reason) > MOST_REASON:
        raise ValueError("reason")


def _row(store: Store, table: str, now: Column, **values) -> DataFrame:
    """One row of a table, recorded now."""
    df = store.spark.range(1)
    known = {f.name: f.dataType for f in store.table(table).schema}
    return df.select(*[(now if name == "recorded_at" else F.lit(values.get(name))).cast(kind).alias(name) for name, kind in known.items()])


def _event(store: Store, schedule_id: str, action: str, actor: str, reason: str, now: Column) -> DataFrame:
    seq = store.table("schedule_events").count()
    return _row(store, "schedule_events", now, schedule_id=schedule_id, seq=seq, action=action, actor=actor, reason=reason)


def register_schedule(store: Store, spec: dict, actor: str, now: Column) -> dict:
    """Add a schedule. The same definition again changes nothing; another one under its id is a Conflict."""
    _said(actor)
    if not isinstance(spec, dict) or not SPEC <= spec.keys() <= SPEC | OPTIONS:
        raise ValueError("schedule fields")
    name, step = spec["schedule_id"], spec["interval_seconds"]
    if not isinstance(name, str) or not re.fullmatch("[A-Za-z0-9][A-Za-z0-9_.:-]{0,127}", name):
        raise ValueError("schedule id")
    if type(step) is not int or not 1 <= step <= MOST_INTERVAL:
        raise ValueError("interval")
    start = datetime.fromisoformat(str(spec["starts_at"]).replace("Z", "+00:00"))
    if start.tzinfo is None:
        raise ValueError("start without an offset")
    text = canonical_json(spec)
    if len(text.encode()) > MOST_SPEC:
        raise ValueError("definition too long")
    # At most MOST_SCHEDULES rows.
    held = {r.schedule_id: r.checksum for r in store.table("schedules").select("schedule_id", "checksum").collect()}
    mark = digest(spec)
    if held.get(name, mark) != mark:
        raise Conflict("a schedule's definition never changes: pause it and register another")
    if name not in held:
        if len(held) >= MOST_SCHEDULES:
            raise ValueError("too many schedules")
        row = _row(store, "schedules", now, schedule_id=name, spec=text, checksum=mark, starts_at=start, interval_seconds=step, actor=actor)
        store.commit({}, {"schedules": row, "schedule_events": _event(store, name, "registered", actor, "immutable definition", now)})
    return {"schedule_id": name, "created": name not in held, "checksum": mark}


def set_paused(store: Store, schedule_id: str, paused: bool, actor: str, reason: str, now: Column) -> dict:
    """Stop or go on with a schedule's future windows; tasks that exist stay."""
    _said(actor, reason)
    if not store.table("schedules").filter(F.col("schedule_id") == schedule_id).limit(1).count():
        raise Conflict("unknown schedule")
    store.commit({}, {"schedule_events": _event(store, schedule_id, "paused" if paused else "resumed", actor, reason, now)})
    return {"schedule_id": schedule_id, "paused": paused, "existing_tasks_cancelled": False}


def schedules(store: Store) -> DataFrame:
    """Schedules with whether they are paused, by their last event."""
    last = store.table("schedule_events").groupBy("schedule_id").agg(F.max_by("action", "seq").alias("_last"))
    return store.table("schedules").join(last, "schedule_id", "left").withColumn("paused", F.coalesce(F.col("_last") == "paused", F.lit(False))).drop("_last")


def inspect(store: Store, most: int = 1000) -> DataFrame:
    return planner.inspect_schedule(schedules(store), store.table("generations"), most)


def due(store: Store, now: Column) -> DataFrame:
    """schedule_id, due_at of the windows that are due and not generated."""
    return planner.due_windows(schedules(store), store.table("generations"), now)


def generated(store: Store, windows: DataFrame) -> DataFrame:
    """Record generated windows (schedule_id, due_at, plan_id, tasks_generated, generation_complete); a window that is recorded already stays as it is."""
    fresh = windows.join(store.table("generations").select("schedule_id", "due_at"), ["schedule_id", "due_at"], "left_anti")
    store.commit({}, {"generations": fresh})
    return fresh


def register_policy(store: Store, policy_ref: str, body: dict, now: Column) -> dict:
    """Add a policy. Its checksum never changes, and a revoked one does not come back."""
    new = _row(store, "policies", now, policy_ref=policy_ref, checksum=digest(body), body=canonical_json(body))
    held = store.table("policies").join(store.table("revocations").select("policy_ref", F.lit(True).alias("revoked")).distinct(), "policy_ref", "left").withColumn("revoked", F.coalesce("revoked", F.lit(False)))
    added, refused = queue.register_policies(held, new)
    if refused.limit(1).count():
        raise Conflict("policy is revoked or has another checksum")
    store.commit({}, {"policies": added})
    return {"policy_ref": policy_ref, "checksum": digest(body)}


def revoke_policy(store: Store, policy_ref: str, actor: str, reason: str, now: Column) -> None:
    _said(actor, reason)
    if not store.table("policies").filter(F.col("policy_ref") == policy_ref).limit(1).count():
        raise Conflict("unknown policy")
    store.commit({}, {"revocations": _row(store, "revocations", now, policy_ref=policy_ref, actor=actor, reason=reason)})


def check_policies(store: Store, asked: DataFrame) -> DataFrame:
    """asked (policy_ref, checksum) with ``fault``: unknown_policy, changed_policy, revoked_policy, or null if work may go on under it."""
    held = store.table("policies").select("policy_ref", F.col("checksum").alias("_held"))
    gone = store.table("revocations").select("policy_ref").distinct().withColumn("_gone", F.lit(True))
    met = asked.join(held, "policy_ref", "left").join(gone, "policy_ref", "left")
    fault = F.when(F.col("_held").isNull(), "unknown_policy").when(F.col("_held") != F.col("checksum"), "changed_policy").when(F.col("_gone"), "revoked_policy")
    return met.withColumn("fault", fault).drop("_held", "_gone")


def save_plan(store: Store, plan_id: str, total: int, offset: int, next_offset: int | None, tasks: DataFrame, now: Column) -> DataFrame:
    """Add a page of a plan and its tasks (task_key, payload and what else the table has). Returns conflicts: keys with another payload; then nothing is written."""
    names = store.table("tasks").columns
    rows = tasks.withColumns({"plan_id": F.lit(plan_id)} | {c: F.lit(v) for c, v in (("status", "pending"), ("reason", ""), ("not_before", 0.0), ("channel_page", None), ("max_pages", None), ("deferred", False)) if c not in tasks.columns})
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in store.table("tasks").schema])
    added, wrong = queue.enqueue(store.table("tasks"), rows)
    if wrong.limit(1).count():
        return wrong
    store.commit({}, {"plans": _row(store, "plans", now, plan_id=plan_id, total_tasks=total, offset=offset, next_offset=next_offset), "tasks": added.select(*names)})
    return wrong


def requeue(store: Store, keys: list[str], reason: str) -> None:
    """Blocked and partial tasks go back to pending."""
    _said("-", reason)
    wanted = store.spark.createDataFrame([(k, reason) for k in keys], "task_key string, reason string")
    store.commit({"tasks": queue.requeue(store.table("tasks"), wanted)})


def release(store: Store, limit: int) -> int:
    """Take up to ``limit`` deferred tasks into the queue; how many."""
    tasks = store.table("tasks")
    picked = queue.release(tasks.filter("deferred"), tasks.filter("not deferred"), limit).select("task_key").withColumn("_on", F.lit(True))
    n = picked.count()
    store.commit({"tasks": tasks.join(picked, "task_key", "left").withColumn("deferred", F.col("deferred") & F.col("_on").isNull()).drop("_on")})
    return n


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)
