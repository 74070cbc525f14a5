"""Evidence: liveness, folds, decisions, tombstones, relations and what may be exported.

Evidence is live on [observed_at, expires_at). All predicates are plain column comparisons, so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CLASSES, CONTRACT_COUNTRIES, KINDS, RELATION_KINDS, SOURCE_TYPES


def is_live(now: Column, observed: str = "observed_at", expires: str = "expires_at") -> Column:
    return (F.col(observed) <= now) & (now < F.col(expires))


def live(df: DataFrame, now: Column, observed: str = "observed_at", expires: str = "expires_at") -> DataFrame:
    return df.filter(is_live(now, observed, expires))


def fold_candidates(df: DataFrame, keys: list[str], observed: str = "observed_at") -> DataFrame:
    """First and last observation of each candidate, by instant, in whatever order observations come."""
    return df.groupBy(*keys).agg(F.min(observed).alias("first_observed_at"), F.max(observed).alias("last_observed_at"), F.count("*").alias("observations"))


def dedupe_evidence(df: DataFrame, keys: list[str], expires: str = "expires_at") -> DataFrame:
    """One row for each evidence key; retention only shrinks."""
    return df.groupBy(*keys).agg(F.min(expires).alias(expires), F.count("*").alias("copies"))


def latest_decision(decisions: DataFrame, key: str = "candidate_id", revision: str = "revision", value: str = "status") -> DataFrame:
    return decisions.groupBy(key).agg(F.max_by(value, revision).alias("decision_status"), F.max(revision).alias("revision"))


def with_decision(candidates: DataFrame, decisions: DataFrame, key: str = "candidate_id", **names: str) -> DataFrame:
    found = candidates.drop("decision_status", "revision").join(latest_decision(decisions, key, **names), key, "left")
    return found.withColumns({"decision_status": F.coalesce("decision_status", F.lit("unreviewed")), "revision": F.coalesce("revision", F.lit(0))})


def admit(observations: DataFrame, deletion_ledger: DataFrame, expired: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(admitted, rejected): suppressed candidates and expired evidence don't come back."""
    gone = deletion_ledger.select("candidate_key").distinct()
    stale = expired.select("evidence_key").distinct()
    admitted = observations.join(gone, "candidate_key", "left_anti").join(stale, "evidence_key", "left_anti")
    rejected = observations.join(gone.withColumn("_gone", F.lit(True)), "candidate_key", "left").join(stale.withColumn("_stale", F.lit(True)), "evidence_key", "left")
    rejected = rejected.filter("_gone or _stale").withColumn("reason", F.when(F.col("_gone"), "candidate_suppressed").otherwise("evidence_expired")).drop("_gone", "_stale")
    return admitted, rejected


def expire(df: DataFrame, now: Column, key: str = "evidence_key", expires: str = "expires_at") -> tuple[DataFrame, DataFrame]:
    """(kept, tombstones): what has expired at now leaves a tombstone."""
    return df.filter(F.col(expires) > now), df.filter(F.col(expires) <= now).select(key).distinct().withColumn("expired_at", now)


def suppress(evidence: DataFrame, relations: DataFrame, decisions: DataFrame, artifacts: DataFrame, suppressed: DataFrame) -> dict[str, DataFrame]:
    """Take suppressed candidates (candidate_id) out of every derived table, and artifacts that their evidence shares."""
    ids = suppressed.select("candidate_id").distinct()
    bodies = evidence.join(ids, "candidate_id", "left_semi").filter("body_sha256 is not null").select(F.col("body_sha256").alias("checksum")).distinct()
    ends = ids.withColumnRenamed("candidate_id", "_end")
    return {
        "evidence": evidence.join(ids, "candidate_id", "left_anti"),
        "relations": relations.join(ends, relations["source_id"] == ends["_end"], "left_anti").join(ends, relations["target_id"] == ends["_end"], "left_anti"),
        "decisions": decisions.join(ids, "candidate_id", "left_anti"),
        "artifacts": artifacts.join(bodies, "checksum", "left_anti"),
        "suppressed_artifacts": bodies,
    }


def relations_live(relations: DataFrame, evidence: DataFrame, exportable: DataFrame, now: Column) -> DataFrame:
    """Relations whose evidence is live and both of whose ends (candidate_id of exportable) may be exported."""
    alive = live(evidence, now).select("evidence_id").distinct()
    ends = exportable.select(F.col("candidate_id").alias("_end")).distinct()
    out = relations.join(alive, "evidence_id", "left_semi")
    return out.join(ends, out["source_id"] == ends["_end"], "left_semi").join(ends, out["target_id"] == ends["_end"], "left_semi")


def relate(relations: DataFrame, evidence: DataFrame, candidates: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused): a new relation needs a known kind, two different live candidates, an actor and live evidence of one of them."""
    alive = live(evidence, now).select("evidence_id", F.col("candidate_id").alias("_owner")).distinct()
    known = candidates.filter("not suppressed").select(F.col("candidate_id").alias("_end")).distinct()
    met = relations.join(alive, "evidence_id", "left")
    met = met.join(known.withColumnRenamed("_end", "_source"), F.col("source_id") == F.col("_source"), "left").join(known.withColumnRenamed("_end", "_target"), F.col("target_id") == F.col("_target"), "left")
    fault = F.coalesce(
        F.when(~F.col("kind").isin(*RELATION_KINDS), F.lit("unknown_kind")),
        F.when((F.col("source_id") == F.col("target_id")) | (F.trim("actor") == ""), F.lit("distinct_candidates_and_actor_required")),
        F.when(F.col("_source").isNull() | F.col("_target").isNull(), F.lit("candidate_not_live")),
        F.when(F.col("_owner").isNull() | ((F.col("_owner") != F.col("source_id")) & (F.col("_owner") != F.col("target_id"))), F.lit("evidence_not_available")),
    )
    met = met.withColumn("fault", fault).drop("_owner", "_source", "_target").distinct()
    return met.filter("fault is null").drop("fault"), met.filter("fault is not null")


def validate_observations(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine with the first fault). Nothing is dropped."""
    text = lambda name, most: F.col(name).isNull() | (F.trim(name) == "") | (F.length(name) > most)
    fault = F.coalesce(
        F.when(F.col("observed_at").isNull() | F.col("expires_at").isNull() | ~(F.col("expires_at") > F.col("observed_at")), F.lit("expiry_must_follow_observation")),
        F.when(~F.col("kind").isin(*KINDS) | ~F.col("source_type").isin(*SOURCE_TYPES), F.lit("unknown_kind_or_source_type")),
        F.when(F.exists("countries", lambda c: ~c.rlike("^[A-Z]{2}$")), F.lit("country_shape")),
        F.when(F.exists("classes", lambda c: ~c.isin(*CLASSES)), F.lit("class_outside_scope")),
        F.when(text("method", 256) | text("method_version", 64) | text("evidence_group", 256) | text("policy_ref", 256), F.lit("text_bounds")),
        F.when((F.length("locality_code") > 128) | ~F.col("locality_country").rlike("^([A-Z]{2})?$"), F.lit("locality")),
        F.when(F.length("signals") > 16384, F.lit("signals_bound")),
        F.when(~F.col("body_sha256").rlike("^[a-f0-9]{64}$"), F.lit("checksum_shape")),
    )
    marked = df.withColumns({"fault": fault, "countries": F.array_sort(F.array_distinct("countries")), "classes": F.array_sort(F.array_distinct("classes"))})
    return marked.filter("fault is null").drop("fault"), marked.filter("fault is not null")


def project_rows(rows: DataFrame) -> DataFrame:
    """Parsed rows (signals as JSON) to claims: a country only if two upper-case letters, classes and source type only if known."""
    get = lambda path: F.get_json_object("signals", path)
    country, kind = get("$.claimed_country"), get("$.claimed_source_type")
    listed = F.from_json(get("$.claimed_vehicle_classes"), "array<string>")
    return rows.withColumns({
        "countries": F.when(country.rlike(r"^\p{Lu}{2}$"), F.array(country)).otherwise(F.array().cast("array<string>")),
        "classes": F.array_sort(F.array_distinct(F.filter(F.coalesce(listed, F.array().cast("array<string>")), lambda c: c.isin(*CLASSES)))),
        "source_type": F.when(kind.isin(*SOURCE_TYPES), kind).otherwise(F.lit("unknown")),
    })


def exportable(candidates: DataFrame, evidence: DataFrame, decisions: DataFrame, now: Column) -> DataFrame:
    """candidate_id, blocked reason (null if exportable), review_due_at, method, method_version, countries, classes of every candidate.

    Duplicate chains are checked apart (``graph.chain_terminals``, ``graph.cannot_link_conflicts``).
    """
    outside = F.exists("countries", lambda c: ~c.isin(*CONTRACT_COUNTRIES))
    facts = live(evidence, now).groupBy("candidate_id").agg(
        F.min("expires_at").alias("_expires"), F.min_by(F.struct("method", "method_version"), F.struct("observed_at", "evidence_id")).alias("_first"),
        F.max(outside).alias("_outside"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("countries")))).alias("countries"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("classes")))).alias("classes"), F.array_sort(F.collect_set("evidence_id")).alias("evidence_refs"),
    )
    met = with_decision(candidates, decisions).join(facts, "candidate_id", "left")
    reason = F.coalesce(F.when(F.col("suppressed"), F.lit("suppressed")), F.when(F.col("_expires").isNull(), F.lit("no_live_evidence")), F.when(F.col("_outside"), F.lit("country_outside_contract")))
    return met.select(
        "candidate_id", reason.alias("blocked"), F.least("_expires", F.col("last_observed_at") + F.expr("interval 30 days")).alias("review_due_at"),
        "_first.method", "_first.method_version", "countries", "classes", "evidence_refs", "decision_status",
    )


def content_addressed(df: DataFrame, body: str, expires: str | None = None, suppressed: DataFrame | None = None) -> DataFrame:
    """Artifacts by content hash; copies collapse and the earliest expiry counts. Bodies are hashed before anything is shuffled."""
    hashed = df.select(F.sha2(F.col(body).cast("binary"), 256).alias("checksum"), F.octet_length(body).alias("bytes"), *([F.col(expires)] if expires else []))
    out = hashed.groupBy("checksum").agg(F.max("bytes").cast("long").alias("bytes"), F.count("*").alias("copies"), *([F.min(expires).alias(expires)] if expires else []))
    return out.join(suppressed.select("checksum").distinct(), "checksum", "left_anti") if suppressed is not None else out


def upsert_pages(pages: DataFrame) -> DataFrame:
    """Channel pages by id; the earliest expiry counts, the rest is the first delivery's."""
    rest = [c for c in pages.columns if c not in ("page_id", "expires_at")]
    found = pages.groupBy("page_id").agg(F.min("expires_at").alias("expires_at"), F.min_by(F.struct(*rest), "observed_at").alias("_rest"))
    return found.select("page_id", "expires_at", "_rest.*")


def first_wins(rows: DataFrame, keys: list[str], order: list[str], hint: str | None = None) -> DataFrame:
    """Of rows with equal keys the first in order stays, with the first label that is not empty and up to 8 hints of 4096 characters together.

    Rows and hints are folded by key with a map-side combine; of hints only the distinct ones of a key come together, each once.
    """
    place = F.struct(*order)
    label = F.col("label") != ""
    rest = [c for c in rows.columns if c not in (*keys, "label")]
    out = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), place).alias("_row"), F.coalesce(F.min_by(F.when(label, F.col("label")), F.when(label, place)), F.lit("")).alias("label"))
    out = out.select(*keys, "label", "_row.*")
    if hint:
        seen = rows.filter(F.col(hint).isNotNull()).groupBy(*keys, F.col(hint).alias("_hint")).agg(F.min(place).alias("_at"))
        listed = seen.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_hint"))), lambda x: x["_hint"]).alias("_seen"))
        start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("chars"))
        # Each next hint is taken if there is room for it.
        fold = F.aggregate("_seen", start, lambda acc, x: F.when((F.size(acc["kept"]) < 8) & (acc["chars"] + F.length(x) <= 4096), F.struct(F.array_append(acc["kept"], x).alias("kept"), (acc["chars"] + F.length(x)).alias("chars"))).otherwise(acc))
        folded = listed.select(*[F.col(k).alias(f"_{k}") for k in keys], fold["kept"].alias("hints"), (F.size(fold["kept"]) < F.size("_seen")).alias("hints_truncated"))
        met = None
        for k in keys:
            same = F.col(k).eqNullSafe(F.col(f"_{k}"))
            met = same if met is None else met & same
        out = out.join(folded, met, "left").drop(*[f"_{k}" for k in keys]).withColumns({"hints": F.coalesce("hints", F.array().cast("array<string>")), "hints_truncated": F.coalesce("hints_truncated", F.lit(False))})
    return out.select(*rows.columns, *(("hints", "hints_truncated") if hint else ()))


def integrity(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows of child whose reference has no parent."""
    keys = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def decide(decisions: DataFrame, proposed: DataFrame, live_candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused with reason) of proposed decisions (candidate_id, expected_revision, status, target_id, actor, reason).

    A decision counts only on the revision that it was made on, a target only with a duplicate and only if it is live. Of several proposals on one revision
    the first by actor and reason is taken: the others are stale. Cycles and constraints are checked with ``graph``.
    """
    now = decisions.groupBy("candidate_id").agg(F.max("revision").alias("_revision"))
    alive = live_candidates.select("candidate_id").distinct()
    met = proposed.join(now, "candidate_id", "left").join(alive.withColumn("_alive", F.lit(True)), "candidate_id", "left")
    met = met.join(alive.select(F.col("candidate_id").alias("target_id"), F.lit(True).alias("_target")), "target_id", "left")
    nth = F.row_number().over(Window.partitionBy("candidate_id", "expected_revision").orderBy("actor", "reason", "status"))
    duplicate = F.col("status") == "duplicate_candidate"
    fault = F.coalesce(
        F.when((F.trim("actor") == "") | (F.trim("reason") == ""), F.lit("actor_and_reason_required")),
        F.when(~F.col("status").isin("accepted", "duplicate_candidate", "rejected", "needs_evidence"), F.lit("unknown_status")),
        F.when(~duplicate & F.col("target_id").isNotNull(), F.lit("target_only_with_duplicate")),
        F.when(F.col("_alive").isNull(), F.lit("candidate_not_live")),
        F.when(duplicate & (F.col("_target").isNull() | (F.col("target_id") == F.col("candidate_id"))), F.lit("target_not_live")),
        F.when(F.col("expected_revision") != F.coalesce("_revision", F.lit(0)), F.lit("stale_revision")),
        F.when(F.col("_nth") > 1, F.lit("stale_revision")),
    )
    met = met.withColumn("_nth", nth).withColumn("fault", fault)
    accepted = met.filter("fault is null").select("candidate_id", (F.col("expected_revision") + 1).alias("revision"), "status", F.col("actor").alias("actor_ref"), "reason", "target_id")
    return accepted, met.filter("fault is not null").select(*proposed.columns, "fault")


def technology_claims(pages: DataFrame, scans: DataFrame) -> DataFrame:
    """Rows in the shape of parsed claims for pages (page_id, origin) whose technology scan shows anything; surfaces need a review."""
    met = pages.select("page_id", "origin").join(scans, "page_id").filter("size(detections) > 0 or size(inventory_surfaces) > 0 or dynamic_rendering_required = 'true'")
    own = met.select("page_id", F.col("origin").alias("locator"), F.lit("source").alias("kind"), F.lit("technology_observation").alias("relation"), F.lit("").alias("label"),
                     F.to_json(F.struct(F.lit("technology_signatures").alias("assertion_method"), F.lit("unverified").alias("claim_status"), F.lit("document").alias("evidence_selector"), "detections")).alias("signals"))
    surfaces = met.select("page_id", F.explode("inventory_surfaces").alias("s")).select("page_id", "s.locator", F.lit("source").alias("kind"), F.lit("inventory_surface").alias("relation"), F.lit("").alias("label"),
                     F.to_json(F.struct(F.col("s.rule").alias("assertion_method"), F.lit("unverified").alias("claim_status"), F.col("s.selector").alias("evidence_selector"), F.lit(True).alias("requires_access_review"))).alias("signals"))
    return own.unionByName(surfaces)
