"""Whether inventory may be acquired: six control records must agree, and the admission must hold now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lifecycle states in which a source works.
OPERATIONAL = ("onboarding", "monitored", "degraded")

BUNDLE = """
    source STRUCT<source_id: STRING, lifecycle: STRING>, surface STRUCT<source_id: STRING, surface_id: STRING, admission_id: STRING>,
    stream STRUCT<stream_id: STRING, source_id: STRING, surface_id: STRING, admission_id: STRING, capability_manifest_id: STRING, scope_revision: STRING, market_countries: ARRAY<STRING>, vehicle_classes: ARRAY<STRING>>,
    admission STRUCT<admission_id: STRING, surface_id: STRING, status: STRING, acquire_inventory: BOOLEAN, valid_from: TIMESTAMP, valid_until: TIMESTAMP, review_due_at: TIMESTAMP, market_countries: ARRAY<STRING>, vehicle_classes: ARRAY<STRING>>,
    capability STRUCT<capability_manifest_id: STRING, surface_id: STRING, capabilities_verified_at: TIMESTAMP, revalidate_at: TIMESTAMP>,
    plan STRUCT<stream_id: STRING, capability_manifest_id: STRING, scope_revision: STRING, max_partitions: INT, partitions: ARRAY<STRUCT<partition_id: STRING, partition_key: STRING>>>
"""


def within(small: Column, large: Column) -> Column:
    return F.size(F.array_except(small, large)) == 0


def faults() -> Column:
    """Sorted names of what does not agree in a row of BUNDLE; empty if the bundle is coherent."""
    c = F.col
    distinct = lambda field: F.size(F.array_distinct(F.transform("plan.partitions", lambda p: p[field]))) == F.size("plan.partitions")
    holds = {
        "admission_review": (c("admission.valid_from") <= c("admission.review_due_at")) & (c("admission.review_due_at") <= c("admission.valid_until")),
        "admission_window": c("admission.valid_from") < c("admission.valid_until"),
        "capability_manifest": (c("stream.capability_manifest_id") == c("capability.capability_manifest_id")) & (c("capability.capability_manifest_id") == c("plan.capability_manifest_id")),
        "capability_window": c("capability.capabilities_verified_at") < c("capability.revalidate_at"),
        "partition_budget": F.size("plan.partitions") <= c("plan.max_partitions"),
        "partition_ids": distinct("partition_id"),
        "partition_keys": distinct("partition_key"),
        "plan_stream": c("plan.stream_id") == c("stream.stream_id"),
        "scope_classes": within(c("stream.vehicle_classes"), c("admission.vehicle_classes")),
        "scope_countries": within(c("stream.market_countries"), c("admission.market_countries")),
        "scope_revision": c("plan.scope_revision") == c("stream.scope_revision"),
        "source": (c("source.source_id") == c("surface.source_id")) & (c("surface.source_id") == c("stream.source_id")),
        "surface": (c("surface.surface_id") == c("stream.surface_id")) & (c("stream.surface_id") == c("admission.surface_id")) & (c("admission.surface_id") == c("capability.surface_id")),
        "surface_admission": (c("surface.admission_id") == c("stream.admission_id")) & (c("stream.admission_id") == c("admission.admission_id")),
    }
    return F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in holds.items()]))


def may_acquire(now: Column) -> Column:
    c = F.col
    current = (c("admission.valid_from") <= now) & (now < F.least("admission.valid_until", "admission.review_due_at"))
    capable = (c("capability.capabilities_verified_at") <= now) & (now < c("capability.revalidate_at"))
    return (F.size(faults()) == 0) & c("source.lifecycle").isin(*OPERATIONAL) & (c("admission.status") == "approved") & c("admission.acquire_inventory") & current & capable


def bundles(sources: DataFrame, surfaces: DataFrame, streams: DataFrame, admissions: DataFrame, capabilities: DataFrame, plans: DataFrame) -> DataFrame:
    """One bundle for each stream, from the six record tables; what is missing is a null struct, and so a fault."""
    whole = lambda df, name, key: df.select(F.struct("*").alias(name), F.col(key).alias(f"_{name}"))
    out = streams.select(F.struct("*").alias("stream"))
    for df, name, key, at in (
        (sources, "source", "source_id", "stream.source_id"), (surfaces, "surface", "surface_id", "stream.surface_id"), (admissions, "admission", "admission_id", "stream.admission_id"),
        (capabilities, "capability", "capability_manifest_id", "stream.capability_manifest_id"), (plans, "plan", "stream_id", "stream.stream_id"),
    ):
        out = out.join(whole(df, name, key), F.col(at) == F.col(f"_{name}"), "left").drop(f"_{name}")
    return out
