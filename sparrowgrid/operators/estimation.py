"""Two-group capture-recapture. An estimate is given only when nothing speaks against it; the reasons are listed otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The smallest cell that an interval is given for, and the normal quantile of 95 %.
LEAST_CELL = 20
Z95 = 1.959963984540054


def capture_faults(now: Column, start: Column, end: Column) -> Column:
    """Sorted reasons against one capture record; the capture window is closed at both ends."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    checks = {
        "expired_capture": F.col("expires_at") <= now,
        "invalid_capture_window": ~((start <= F.col("observed_at")) & (F.col("observed_at") <= end) & (F.col("observed_at") < F.col("expires_at"))),
        "missing_capture_evidence": blank("evidence_ref"),
        "source_group_unknown": F.col("group_id").isNull(),
        "stratum_mismatch": ~F.col("in_stratum"),
        "unresolved_identity": blank("entity_id") | ~F.col("identity_status").eqNullSafe("resolved"),
        "unreviewed_capture": ~F.col("review_status").eqNullSafe("accepted"),
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))


def group_faults(groups: DataFrame, now: Column) -> DataFrame:
    """One row: the sorted reasons against the groups (id, sources, independent, evidence_ref, observed_at, expires_at, depends_on)."""
    checks = {
        "dependent_capture_groups": F.size(F.coalesce("depends_on", F.array().cast("array<string>"))) > 0,
        "expired_independence_evidence": F.col("expires_at") <= now,
        "independence_not_declared": ~F.col("independent").eqNullSafe(True),
        "invalid_independence_window": ~(F.col("observed_at") < F.col("expires_at")) | (F.col("observed_at") > now),
        "missing_independence_evidence": F.col("evidence_ref").isNull() | (F.trim("evidence_ref") == ""),
    }
    own = groups.select(F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))).alias("reason"))
    number = groups.agg(F.when(F.count("*") != 2, F.lit("two_independent_groups_required")).alias("reason"))
    double = groups.groupBy("id").count().filter("count > 1").select(F.lit("duplicate_group_ids").alias("reason"))
    shared = groups.select("id", F.explode("sources").alias("s")).groupBy("s").agg(F.countDistinct("id").alias("n")).filter("n > 1").select(F.lit("shared_source_between_groups").alias("reason"))
    return own.unionAll(number).unionAll(double).unionAll(shared).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def chapman(captures: DataFrame, entity: str, stratum: list[str], left: Column, right: Column, reasons: Column | None = None) -> DataFrame:
    """Per stratum: counts, overlap, observed, estimate with interval, status and sorted reasons.

    left and right tell, row by row, whether a capture belongs to a group; an entity counts once per group. reasons: an
    aggregate expression giving an array of faults of the stratum's records, if any.
    """
    entities = captures.groupBy(*stratum, entity).agg(F.max(left).alias("l"), F.max(right).alias("r")).filter("l or r")
    counts = entities.groupBy(*stratum).agg(F.count_if("l").alias("n_left"), F.count_if("r").alias("n_right"), F.count_if(F.col("l") & F.col("r")).alias("overlap"), F.count("*").alias("observed"))
    if reasons is not None:
        counts = captures.groupBy(*stratum).agg(reasons.alias("_given")).join(counts, stratum, "left").fillna(0, ["n_left", "n_right", "overlap", "observed"])
    n1, n2, m = (F.col(c).cast("double") for c in ("n_left", "n_right", "overlap"))
    found = F.array_compact(F.array(
        F.when((F.col("n_left") == 0) | (F.col("n_right") == 0), F.lit("empty_capture_group")),
        F.when((F.col("overlap") > 0) & (F.least("overlap", F.col("n_left") - F.col("overlap"), F.col("n_right") - F.col("overlap")) < LEAST_CELL), F.lit("insufficient_interval_support")),
        F.when(F.col("overlap") == 0, F.lit("no_overlap")),
    ))
    given = F.coalesce(F.col("_given"), F.array().cast("array<string>")) if reasons is not None else F.array().cast("array<string>")
    out = counts.withColumn("reasons", F.array_sort(F.array_distinct(F.concat(found, given))))
    usable = F.size("reasons") == 0
    estimate = (n1 + 1) * (n2 + 1) / (m + 1) - 1
    margin = F.lit(Z95) * F.sqrt((n1 + 1) * (n2 + 1) * (n1 - m) * (n2 - m) / ((m + 1) * (m + 1) * (m + 2)))
    return out.select(
        *stratum, "n_left", "n_right", "overlap", "observed", F.when(usable, F.lit("estimated")).otherwise(F.lit("unknown")).alias("status"), "reasons",
        F.when(usable, estimate).alias("estimate"), F.when(usable, F.greatest(F.col("observed").cast("double"), estimate - margin)).alias("lower"), F.when(usable, estimate + margin).alias("upper"),
    )


def estimate_stratum(records: DataFrame, groups: DataFrame, stratum: dict[str, str], now: Column, start: Column, end: Column) -> DataFrame:
    """The full estimator for one stratum: faults of groups and records block it, observed counts are given all the same.

    records: entity_id, identity_status, review_status, source_id, evidence_ref, observed_at, expires_at, stratum (struct).
    """
    sources = groups.select(F.col("id").alias("group_id"), F.explode("sources").alias("source_id"))
    same = None
    for name, value in stratum.items():
        test = F.col(f"stratum.{name}") == F.lit(value)
        same = test if same is None else same & test
    met = records.join(sources.groupBy("source_id").agg(F.max("group_id").alias("group_id")), "source_id", "left").withColumn("in_stratum", F.coalesce(same, F.lit(False)))
    met = met.withColumn("faults", capture_faults(now, start, end))
    shared = met.filter("group_id is not null").groupBy("evidence_ref").agg(F.countDistinct("group_id").alias("n")).filter("n > 1").agg(F.count("*").alias("n"))
    shared = shared.select(F.when(F.col("n") > 0, F.array(F.lit("shared_capture_evidence_between_groups"))).otherwise(F.array().cast("array<string>")).alias("shared"))
    ids = groups.agg(F.min("id").alias("left_id"), F.max("id").alias("right_id"))
    # One row each: group faults, shared evidence, group ids.
    met = met.crossJoin(F.broadcast(group_faults(groups, now).withColumnRenamed("reasons", "group_reasons"))).crossJoin(F.broadcast(shared)).crossJoin(F.broadcast(ids)).withColumn("all", F.lit("all"))
    good = F.size("faults") == 0
    every = F.array_union(F.array_distinct(F.flatten(F.collect_set("faults"))), F.array_union(F.first("group_reasons"), F.first("shared")))
    return chapman(met, "entity_id", ["all"], good & (F.col("group_id") == F.col("left_id")), good & (F.col("group_id") == F.col("right_id")), every).drop("all")
