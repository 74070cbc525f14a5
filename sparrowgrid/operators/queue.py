"""Work ordering and admission. Orders are total (a key breaks every tie), so results don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import order


def _number(df: DataFrame, column: str) -> Column:
    """A column as a number in the same order: times as microseconds."""
    kind = df.schema[column].dataType.simpleString()
    return F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith("timestamp") else F.col(column).cast("double")


def claim_order(tasks: DataFrame, last_claim: str = "last_claim", stratum: str = "stratum", created: str = "created_at", priority: str = "priority", key: str = "task_key") -> DataFrame:
    """tasks with ``claim``: the place in which each would be claimed from a static queue.

    A claim takes the stratum that was claimed longest ago, then the oldest task, the highest priority and the key. So the first tasks of all
    strata come before any second one: strata go round by their rank, ordered by their last claim at first and by their previous turn after.
    """
    inside = Window.partitionBy(stratum).orderBy(created, F.desc(priority), key)
    ranked = tasks.withColumn("_round", F.row_number().over(inside))
    # The order of strata in their first round holds in all later rounds.
    first = ranked.filter("_round = 1")
    heads = order.ranked(first.withColumns({"_back": -F.col(priority), "_number": _number(first, last_claim)}), "_number", "_turn", (last_claim, created, "_back", key)).select(stratum, "_turn")
    met = ranked.join(heads, stratum)
    sizes = met.groupBy("_round").agg(F.count("*").alias("n"))
    before = order.before(sizes, "_round", "n", "_before").select("_round", "_before")
    place = F.row_number().over(Window.partitionBy("_round").orderBy("_turn"))
    return met.join(before, "_round").withColumn("claim", F.coalesce("_before", F.lit(0)) + place).drop("_round", "_turn", "_before")


def admit_budget(requests: DataFrame, policy: str, budget: Column, order: list[str]) -> DataFrame:
    """requests with ``spent`` (place within the policy) and ``admitted``: the first ``budget`` of each policy."""
    spent = F.row_number().over(Window.partitionBy(policy).orderBy(*order)).cast("long")
    return requests.withColumn("spent", spent).withColumn("admitted", F.col("spent") <= budget)


def throttle(requests: DataFrame, origin: str, at: Column, key: str, interval: float) -> DataFrame:
    """origin and the keys admitted when a request is refused before the origin's next time, which refusals don't move.

    The state depends on what was admitted, so a window function can't express it: each origin's requests are folded in order.
    """
    ordered = F.array_sort(F.collect_list(F.struct(at.cast("double").alias("at"), F.col(key).alias("key"))))
    element = requests.select(F.col(key)).schema[0].dataType.simpleString()
    start = F.struct(F.lit(float("-inf")).alias("next"), F.expr(f"cast(array() as array<{element}>)").alias("kept"))
    fold = F.aggregate("requests", start, lambda s, r: F.when(r["at"] >= s["next"], F.struct((r["at"] + F.lit(float(interval))).alias("next"), F.array_append(s["kept"], r["key"]).alias("kept"))).otherwise(s))
    folded = requests.groupBy(origin).agg(ordered.alias("requests")).select(origin, F.size("requests").cast("long").alias("asked"), fold.alias("f"))
    return folded.select(origin, "asked", F.size("f.kept").cast("long").alias("admitted"), F.col("f.next").alias("next_at"), F.col("f.kept").alias("keys"))


def cooldown(current: DataFrame, updates: DataFrame) -> DataFrame:
    """origin, next_at: the later time wins."""
    return current.select("origin", "next_at").unionAll(updates.select("origin", "next_at")).groupBy("origin").agg(F.max("next_at").alias("next_at"))


def enqueue(existing: DataFrame, new: DataFrame, key: str = "task_key", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """(to append, conflicts): equal payloads are idempotent, a key with another payload is an error."""
    once = new.dropDuplicates([key, payload])
    clash = once.groupBy(key).agg(F.countDistinct(payload).alias("n")).filter("n > 1").select(key)
    old = existing.select(key, F.col(payload).alias("_old"))
    met = once.join(old, key, "left").join(clash.withColumn("_clash", F.lit(True)), key, "left")
    wrong = met.filter(F.coalesce("_clash", F.lit(False)) | (F.col("_old").isNotNull() & (F.col("_old") != F.col(payload))))
    return met.filter("_old is null and _clash is null").drop("_old", "_clash"), wrong.drop("_old", "_clash")


def expire_leases(tasks: DataFrame, now: Column) -> DataFrame:
    """Running tasks whose lease has ended go to retry."""
    over = (F.col("status") == "running") & (F.col("lease_until") <= now)
    return tasks.withColumns({
        "reason": F.when(over, "lease_expired").otherwise(F.col("reason")), "not_before": F.when(over, now).otherwise(F.col("not_before")),
        "lease_token": F.when(~over, F.col("lease_token")), "lease_until": F.when(~over, F.col("lease_until")), "status": F.when(over, "retry").otherwise(F.col("status")),
    })


def finish(tasks: DataFrame, outcomes: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(tasks after, fenced outcomes): an outcome (task_key, lease_token, status, reason, retry_at) counts only under its live lease."""
    said = outcomes.select("task_key", F.col("lease_token").alias("_token"), F.col("status").alias("_status"), F.col("reason").alias("_reason"), F.col("retry_at").alias("_retry"))
    met = tasks.join(said, "task_key", "left")
    held = (F.col("status") == "running") & (F.col("lease_token") == F.col("_token")) & (F.col("lease_until") > now)
    after = met.withColumns({
        "reason": F.when(held, F.col("_reason")).otherwise(F.col("reason")), "not_before": F.when(held, F.coalesce("_retry", F.lit(0.0))).otherwise(F.col("not_before")),
        "lease_token": F.when(~F.coalesce(held, F.lit(False)), F.col("lease_token")), "lease_until": F.when(~F.coalesce(held, F.lit(False)), F.col("lease_until")),
        "status": F.when(held, F.col("_status")).otherwise(F.col("status")),
    }).drop("_token", "_status", "_reason", "_retry")
    ok = met.filter(held).select("task_key", F.col("_token").alias("lease_token"))
    return after, outcomes.join(ok, ["task_key", "lease_token"], "left_anti")


def requeue(tasks: DataFrame, keys: DataFrame) -> DataFrame:
    """Only blocked and partial tasks go back to pending."""
    met = tasks.join(keys.select("task_key", F.col("reason").alias("_reason")), "task_key", "left")
    back = F.col("_reason").isNotNull() & F.col("status").isin("blocked", "partial")
    return met.withColumns({"reason": F.when(back, F.col("_reason")).otherwise(F.col("reason")), "not_before": F.when(back, F.lit(0.0)).otherwise(F.col("not_before")), "status": F.when(back, "pending").otherwise(F.col("status"))}).drop("_reason")


def release(deferred: DataFrame, tasks: DataFrame, limit: int, page: str = "channel_page", most: str = "max_pages") -> DataFrame:
    """The next ``limit`` deferred tasks by key, but for channel work beyond its page window and what is queued already."""
    due = deferred.filter(F.coalesce(page, F.lit(0)) <= F.coalesce(most, F.lit(0))).orderBy("task_key").limit(limit)
    return due.join(tasks.select("task_key"), "task_key", "left_anti")


def admission(now: Column) -> Column:
    """(state, reason) of a task before it is fetched; null when it may go on. The first rule that holds decides."""
    rule = lambda state, reason: F.struct(F.lit(state).alias("state"), F.lit(reason).alias("reason"))
    return (
        F.when((F.col("kind") == "query") & ~F.col("bound"), rule("blocked", "human_or_approved_search_provider_required"))
        .when((F.col("access_mode") == "permission_required") | ((F.col("access_mode") == "manual_review") & ~F.col("bound")), rule("blocked", "method_requires_independent_access_review"))
        .when(F.col("exclusion").isNotNull(), rule("blocked", "outside_discovery_boundary"))
        .when(~F.col("host_allowed"), rule("blocked", "host_not_in_explicit_policy"))
        .when(F.col("policy_expires_at") <= now, rule("blocked", "policy_expired"))
        .when(F.col("depth") > F.col("max_depth"), rule("blocked", "depth_budget_requires_review"))
        .when(F.col("origin_ready_at") > now, rule("retry", "shared_origin_cooldown"))
    )


def outcome() -> Column:
    """(state, reason) after a fetch; the first rule that holds decides."""
    rule = lambda state, reason: F.struct(F.lit(state).alias("state"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    status = F.col("http_status")
    has = lambda test: F.exists("signals", test)
    return (
        F.when((status == 429) | (status >= 500), rule("retry", F.concat(F.lit("http_"), status.cast("string"))))
        .when(status != 200, rule("blocked", F.concat(F.lit("http_"), status.cast("string"), F.lit("_not_discovery_evidence"))))
        .when(F.col("deferred_children") > 0, rule("partial", "frontier_deferred_by_depth_or_child_budget"))
        .when(F.col("is_channel") & (~F.coalesce("complete", F.lit(False)) | (F.size("warnings") > 0)), rule("partial", "channel_limits_or_uncertainty"))
        .when((F.size("signals") == 0) & ~F.coalesce(F.col("is_channel") & F.col("complete"), F.lit(False)), rule("partial", "no_candidate_hints_not_proof_of_absence"))
        .when(has(lambda s: s["access_state"].isNotNull()), rule("partial", "access_or_activity_claim_requires_review"))
        .when(has(lambda s: F.coalesce(s["requires_access_review"], F.lit(False))), rule("partial", "surface_requires_access_review"))
        .when(has(lambda s: F.coalesce(s["truncated_or_dynamic"], F.lit(False))), rule("partial", "document_hints_truncated_or_dynamic"))
        .when(F.col("repeated_cursor"), rule("partial", "channel_repeated_cursor"))
        .otherwise(rule("done", ""))
    )


def retry_at(value: Column, now: Column) -> Column:
    """Retry-After as epoch seconds: digits (1 at least), an HTTP date, else 60 seconds on."""
    date = F.unix_timestamp(F.try_to_timestamp(F.regexp_extract(value, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))).cast("double")
    digits = F.when(F.trim(value).rlike(r"^\d{1,18}$"), now + F.greatest(F.lit(1), F.trim(value).cast("long")))
    return F.coalesce(digits, F.when(date.isNotNull(), F.greatest(now + 1, date)), now + 60)


def backoff_bound(attempt: Column, cap: int = 900) -> Column:
    """The most seconds that a retry waits; full jitter draws below it."""
    return F.least(F.lit(float(cap)), F.pow(F.lit(2.0), attempt))


def register_policies(existing: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to append, refused): a policy's checksum never changes, and a revoked one does not come back."""
    met = new.join(existing.select("policy_ref", F.col("checksum").alias("_old"), "revoked"), "policy_ref", "left")
    wrong = (F.col("_old") != F.col("checksum")) | F.col("revoked")
    return met.filter("_old is null").drop("_old", "revoked"), met.filter(wrong).drop("_old", "revoked")


def resume_window(work: DataFrame, receipts: DataFrame, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new tasks, refused) of reviews that open one more page window for channel work that ran out of pages.

    work: task_key, status, channel_page, max_pages, cursor, scope (canonical text of source and parameters); reviews: task_key, binding (digest), scope, actor, reason.
    A task is resumed once; the same review again is idempotent, another one is refused, and neither may change the source or its parameters.
    """
    done = receipts.select("task_key", F.col("binding").alias("_before"))
    met = reviews.join(work.select("task_key", "status", "channel_page", "max_pages", "cursor", F.col("scope").alias("_scope")), "task_key", "left").join(done, "task_key", "left")
    fault = F.coalesce(
        F.when((F.trim("actor") == "") | (F.trim("reason") == ""), F.lit("actor_and_reason_required")),
        F.when(F.col("_before").isNotNull() & (F.col("_before") != F.col("binding")), F.lit("resumed_with_another_review")),
        F.when(F.col("_before").isNull() & (F.col("status").isNull() | ~F.col("status").isin("deferred", "blocked", "partial")), F.lit("nothing_to_resume")),
        F.when(F.col("_before").isNull() & (F.col("scope") != F.col("_scope")), F.lit("scope_changed")),
        F.when(F.col("_before").isNull() & (F.col("cursor").isNull() | (F.col("channel_page") <= F.col("max_pages"))), F.lit("not_page_window_debt")),
    )
    met = met.withColumn("fault", fault)
    fresh = met.filter("fault is null and _before is null").select(F.concat(F.lit("resume:"), F.sha2(F.concat(F.lit('["'), F.col("task_key"), F.lit('","'), F.col("binding"), F.lit('"]')), 256)).alias("task_key"), F.col("task_key").alias("supersedes"), "binding", "cursor", F.lit(1).alias("channel_page"))
    return fresh, met.filter("fault is not null").select(*reviews.columns, "fault")


def listing(tasks: DataFrame, limit: int, status: str | None = None) -> DataFrame:
    return (tasks if status is None else tasks.filter(F.col("status") == status)).orderBy("task_key").limit(limit)
