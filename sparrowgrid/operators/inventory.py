"""Inventory and serving queries: counts, freshness, certificates, offers, membership, ownership, bulk parts, bitemporal reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Freshness targets in seconds by tier, from delta and from census.
DELTA_TARGET = {"T0": 15 * 60, "T1": 6 * 3600, "T2": 24 * 3600}
CENSUS_TARGET = {"T0": 24 * 3600, "T1": 72 * 3600, "T2": 7 * 24 * 3600}
#: Fixed value: beyond so many items a snapshot is delivered in bulk.
BULK_ITEMS = 100_000


def counts(df: DataFrame, by: list[str], item: str, listing: list[str], seller: str) -> DataFrame:
    """Distinct items, listings and sellers: three different grains, counted in one pass."""
    return df.groupBy(*by).agg(F.countDistinct(item).alias("items"), F.countDistinct(*listing).alias("listings"), F.countDistinct(seller).alias("sellers"))


def freshness(df: DataFrame, by: list[str], age: Column) -> DataFrame:
    """Exact p50, p95 and maximum of ages."""
    return df.withColumn("_age", age).groupBy(*by).agg(F.percentile("_age", F.lit(0.5)).alias("p50"), F.percentile("_age", F.lit(0.95)).alias("p95"), F.max("_age").alias("max_age"), F.count("_age").alias("known"))


def slo_state(age: Column, tier: Column, targets: dict[str, int]) -> Column:
    """within, breached, or unknown without an age or a target."""
    target = F.coalesce(*[F.when(tier == t, F.lit(s)) for t, s in targets.items()])
    return F.when(age.isNull() | target.isNull(), "unknown").when(age <= target, "within").otherwise("breached")


def certificates(partitions: DataFrame, run: list[str], complete: Column, closed: Column, valid: Column) -> DataFrame:
    """Status of each run: complete only if all partitions are and the enumeration is closed; invalid if one is not valid."""
    found = partitions.groupBy(*run).agg(F.bool_and(complete).alias("_all"), F.bool_and(closed).alias("_closed"), F.bool_and(valid).alias("_valid"), F.count("*").alias("partitions"), F.count_if(complete).alias("complete_partitions"))
    status = F.when(~F.col("_valid"), "invalid").when(F.col("_all") & F.col("_closed"), "complete").otherwise("positive_only")
    return found.select(*run, "partitions", "complete_partitions", status.alias("status"))


def display_offer(offers: DataFrame, listing: list[str], rank: Column) -> DataFrame:
    """The one offer of each listing that ranks least; rank is a struct that ends in the offer's id."""
    names = [c for c in offers.columns if c not in listing]
    return offers.groupBy(*listing).agg(F.min_by(F.struct(*names), rank).alias("_o")).select(*listing, "_o.*")


def effective_conflicts(memberships: DataFrame, listing: list[str], effective: Column) -> DataFrame:
    """Listings with more than one effective membership."""
    return memberships.filter(effective).groupBy(*listing).agg(F.count("*").alias("effective")).filter("effective > 1")


def ownership_gate(receipts: DataFrame, expected: DataFrame) -> DataFrame:
    """transfer_id, epoch: the new epoch only if both sides' receipts are all there and all match, else the old one.

    expected: transfer_id, dealer, from_epoch, to_epoch, generation_id; receipts the same.
    """
    named = receipts.select(F.col("transfer_id").alias("transfer_id"), "dealer", F.col("from_epoch").alias("_from"), F.col("to_epoch").alias("_to"), F.col("generation_id").alias("_generation"))
    match = F.coalesce((F.col("_from") == F.col("from_epoch")) & (F.col("_to") == F.col("to_epoch")) & (F.col("_generation") == F.col("generation_id")), F.lit(False))
    met = expected.join(named, ["transfer_id", "dealer"], "left").withColumn("_match", match)
    done = met.groupBy("transfer_id").agg(F.bool_and("_match").alias("committed"), F.min("from_epoch").alias("_old"), F.min("to_epoch").alias("_new"))
    return done.select("transfer_id", "committed", F.when(F.col("committed"), F.col("_new")).otherwise(F.col("_old")).alias("epoch"))


def fenced_writes(writes: DataFrame, owners: DataFrame, epoch: Column) -> DataFrame:
    """writes (dealer, epoch, listing_id) with ``accepted``: current epoch and current owner only."""
    now = owners.filter(F.col("epoch") == epoch).select("listing_id", F.col("dealer").alias("_owner"))
    return writes.join(now, "listing_id", "left").withColumn("accepted", F.coalesce((F.col("epoch") == epoch) & (F.col("dealer") == F.col("_owner")), F.lit(False))).drop("_owner")


def bulk_parts(df: DataFrame, key: str, size: int, record: Column) -> DataFrame:
    """Manifest of parts of ``size`` keys' range each: count, key range and checksum over the ordered record digests."""
    rows = df.select(F.floor(F.col(key) / size).cast("long").alias("part"), F.col(key).alias("_k"), F.sha2(record, 256).alias("_d"))
    # A part's range bounds its group; only digests are gathered.
    found = rows.groupBy("part").agg(F.count("*").alias("records"), F.min("_k").alias("first_key"), F.max("_k").alias("last_key"), F.array_sort(F.collect_list(F.struct("_k", "_d"))).alias("_r"))
    return found.select("part", "records", "first_key", "last_key", F.sha2(F.array_join(F.transform("_r", lambda x: x["_d"]), ""), 256).alias("sha256"))


def as_of(facts: DataFrame, keys: list[str], valid: Column, recorded: Column) -> DataFrame:
    """What was believed at ``recorded`` about ``valid``: facts valid then and recorded by then, the latest record of each key."""
    held = facts.filter((F.col("valid_from") <= valid) & (F.col("valid_to").isNull() | (valid < F.col("valid_to"))) & (F.col("recorded_at") <= recorded))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("recorded_at"), F.desc("fact_id")))
    return held.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def family_votes(df: DataFrame, by: list[str], value: str, family: str, source: str) -> DataFrame:
    """Votes for each value: copies within a family count once; a source without a family is its own."""
    return df.groupBy(*by, value).agg(F.countDistinct(F.coalesce(F.col(family), F.concat(F.lit("source:"), F.col(source)))).alias("votes"))


def delivery_mode(items: Column, traversal_seconds: Column, ttl_seconds: Column) -> Column:
    return F.when((items > BULK_ITEMS) | (traversal_seconds > ttl_seconds / 2), "bulk").otherwise("paged")


def health(df: DataFrame, by: list[str], ok: Column) -> DataFrame:
    """Source health, apart from presence: healthy, degraded (some fail), failing (all fail), unknown (no attempt)."""
    found = df.groupBy(*by).agg(F.count(ok).alias("attempts"), F.count_if(ok).alias("successes"))
    state = F.when(F.col("attempts") == 0, "unknown").when(F.col("successes") == F.col("attempts"), "healthy").when(F.col("successes") > 0, "degraded").otherwise("failing")
    return found.withColumn("health", state)


def valid_interval(start: Column, end: Column) -> Column:
    """Half-open; an open end is allowed."""
    return start.isNotNull() & (end.isNull() | (start < end))


def clocks(df: DataFrame, by: list[str], kind: str, at: str, kinds: list[str]) -> DataFrame:
    """One clock for each kind of evidence; each advances only on its own."""
    return df.groupBy(*by).agg(*[F.max(F.when(F.col(kind) == k, F.col(at))).alias(f"{k}_at") for k in kinds])


def listed(df: DataFrame, countries: list[str] | None = None, classes: list[str] | None = None, states: list[str] | None = None, updated_after: Column | None = None, sort: list[tuple[str, bool]] = (), key: str = "item_id") -> DataFrame:
    """Filters and sort of an inventory or listing view; None leaves a dimension open, the key breaks every tie."""
    tests = [(F.col(c).isin(*v)) for c, v in (("market_country", countries), ("vehicle_class", classes), ("presence_state", states)) if v is not None]
    tests += [] if updated_after is None else [F.col("updated_at") > updated_after]
    for test in tests:
        df = df.filter(test)
    return df.orderBy(*[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in sort], key)


def partition_outcomes(rows: DataFrame, run: list[str], listing: str) -> DataFrame:
    """Per partition: fetched and distinct listings; and the union of all partitions counts a listing once."""
    return rows.groupBy(*run).agg(F.count("*").alias("fetched_count"), F.countDistinct(listing).alias("distinct_listing_count"))
