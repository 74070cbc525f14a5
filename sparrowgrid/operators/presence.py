"""Presence of listings through comparable censuses: absence needs two complete misses at least a cadence apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(events: Column, cadence: Column) -> Column:
    """struct<state, effects, last_positive_at, first_absence_at> of an array of struct<at, id, kind, complete, comparable, present, verified>.

    Events are taken in order of (at, id). A positive, or a census that saw the listing, resets; a census that is incomplete or not comparable clears the
    first miss; a first miss suspects, a second one a cadence later concludes; a verified withdrawal wins over misses.
    """
    number = F.lit(None).cast("long")
    start = F.struct(F.lit("observed_present").alias("state"), F.lit(0).alias("effects"), F.lit(0).cast("long").alias("last_positive_at"), number.alias("first_absence_at"), F.lit(0).cast("long").alias("last_effective_at"))

    def step(s, e):
        seen = (e["kind"] == "positive") | ((e["kind"] == "census") & F.coalesce(e["present"], F.lit(False)))
        gone = (e["kind"] == "withdraw") & F.coalesce(e["verified"], F.lit(False))
        census = (e["kind"] == "census") & ~F.coalesce(e["present"], F.lit(False))
        usable = census & F.coalesce(e["complete"], F.lit(False)) & F.coalesce(e["comparable"], F.lit(False))
        miss = usable & (e["at"] > s["last_positive_at"]) & (s["state"] != "withdrawn")
        first = miss & (s["state"] != "not_observed") & s["first_absence_at"].isNull()
        second = miss & (s["state"] != "not_observed") & s["first_absence_at"].isNotNull() & (e["at"] - s["first_absence_at"] >= cadence)
        state = F.when(seen, "observed_present").when(gone, "withdrawn").when(first, "absence_suspected").when(second, "not_observed").otherwise(s["state"])
        absence = F.when(seen | gone | (census & ~usable), number).when(first, e["at"]).otherwise(s["first_absence_at"])
        after = F.struct(
            state.alias("state"), (s["effects"] + (state != s["state"]).cast("int")).alias("effects"), F.when(seen, e["at"]).otherwise(s["last_positive_at"]).alias("last_positive_at"),
            absence.alias("first_absence_at"), F.when(seen | gone | miss, e["at"]).otherwise(s["last_effective_at"]).alias("last_effective_at"),
        )
        return F.when(e["at"] < s["last_effective_at"], s).otherwise(after)

    return F.aggregate(F.array_sort(events), start, step)


EVENT = ["at", "id", "kind", "complete", "comparable", "present", "verified"]


def states(events: DataFrame, key: str, cadence: Column) -> DataFrame:
    """key, state, effects, events. Repeated deliveries of an event count once; events: EVENT columns, of one scope."""
    listed = F.array_distinct(F.collect_list(F.struct(*EVENT)))
    return events.groupBy(key).agg(listed.alias("_e")).select(key, fold(F.col("_e"), cadence).alias("f"), F.size("_e").alias("events")).select(key, "f.state", "f.effects", "f.last_positive_at", "events")


def conflicting_ids(events: DataFrame, key: str) -> DataFrame:
    """Event ids that carry different payloads."""
    return events.groupBy(key, "id").agg(F.countDistinct(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in EVENT])).alias("payloads")).filter("payloads > 1")


def miss_pairs(certificates: DataFrame, key: str, closed: str, cadence: Column) -> DataFrame:
    """Consecutive complete runs of one comparison key, with whether their gap reaches the cadence (in the units of ``closed``)."""
    w = Window.partitionBy(key).orderBy(closed)
    return certificates.withColumn("previous", F.lag(closed).over(w)).filter("previous is not null").withColumn("usable", F.col(closed) - F.col("previous") >= cadence)


def basis_allowed(state: Column, basis: Column) -> Column:
    """Which presence state may rest on which basis."""
    pairs = (("observed_present", "positive"), ("absence_suspected", "single_miss"), ("not_observed", "two_miss"), ("withdrawn", "withdrawal"), ("observed_present", "census_positive"))
    test = F.lit(False)
    for s, b in pairs:
        test = test | ((state == s) & (basis == b))
    return test
