"""Large deterministic frontiers: size by formula, pages by arithmetic, ragged round robin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import order


#: Fixed value: the longest page.
MOST_PAGE = 1_000_000


def round_robin(items: DataFrame, lane: str, index: str) -> DataFrame:
    """items with ``ordinal`` (from 0): first items of all lanes, then the second ones, in lane order.

    index is the place within the lane. Rounds are numbered by their sizes, so no window spans all items.
    """
    sizes = items.groupBy(index).agg(F.count("*").alias("_n"))
    before = order.before(sizes, index, "_n", "_before").select(index, "_before")
    place = F.row_number().over(Window.partitionBy(index).orderBy(lane)) - 1
    return items.withColumn("_place", place).join(before, index).withColumn("ordinal", F.col("_before") + F.col("_place")).drop("_before", "_place")


def consumed(lengths: Column, rounds: Column) -> Column:
    """Items that so many complete rounds take from a lane."""
    return F.least(lengths, rounds)


def round_robin_page(lanes: DataFrame, lane: str, length: str, offset: int, limit: int) -> DataFrame:
    """lane, index, ordinal of items [offset, offset + limit) of the round robin, without building those before.

    limit is at most ``MOST_PAGE``. Only the table of lanes is read: the items of complete rounds are a sum of minima, and the page's first and last round come from the
    distinct lengths. Then just the rounds of the page are laid out.
    """
    if not 0 < limit <= MOST_PAGE:
        raise ValueError(f"a page has 1 to {MOST_PAGE} items")
    # Up to each length: how many lanes end there, so how many items all rounds up to it have.
    steps = lanes.filter(F.col(length) > 0).groupBy(F.col(length).alias("upto")).agg(F.count("*").alias("ends"))
    w = Window.orderBy("upto")
    total = F.sum("ends").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    alive = total - F.coalesce(F.sum("ends").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    low = F.coalesce(F.lag("upto").over(w), F.lit(0))
    steps = steps.select("upto", low.alias("low"), alive.alias("alive"))
    steps = steps.withColumn("start", F.coalesce(F.sum(F.col("alive") * (F.col("upto") - F.col("low"))).over(Window.orderBy("upto").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    end = offset + limit
    first = F.greatest(F.col("low"), F.col("low") + F.expr(f"cast(({offset} - start) div alive as bigint)"))
    last = F.least(F.col("upto") - 1, F.col("low") + F.expr(f"cast(({end - 1} - start) div alive as bigint)"))
    touched = steps.filter((F.col("start") < end) & (F.col("start") + F.col("alive") * (F.col("upto") - F.col("low")) > offset)).select("*", first.alias("_first"), last.alias("_last")).filter("_first <= _last")
    rounds = touched.select("start", "alive", "low", F.explode(F.sequence("_first", "_last")).alias("index")).select("index", (F.col("start") + F.col("alive") * (F.col("index") - F.col("low"))).alias("_before"))
    # The page has at most limit / alive + 1 rounds of each kind, so at most MOST_PAGE rows of two numbers are sent along.
    placed = lanes.select(lane, length).crossJoin(F.broadcast(rounds)).filter(F.col(length) > F.col("index"))
    placed = placed.withColumn("ordinal", F.col("_before") + F.row_number().over(Window.partitionBy("index").orderBy(lane)) - 1)
    return placed.filter((F.col("ordinal") >= offset) & (F.col("ordinal") < end)).select(lane, "index", "ordinal")


def frontier_size(groups: DataFrame, country: str, seeds: str, places: str, queries: str) -> DataFrame:
    """Per country: seeds + places * queries summed over its strategies."""
    return groups.groupBy(country).agg(F.sum(F.col(seeds) + F.col(places) * F.col(queries)).alias("total_tasks"))


def query_count(profiles: DataFrame) -> DataFrame:
    """country, strategy, seeds, queries: a template with the class placeholder counts once per term of its classes, any other once."""
    s = profiles.select("country", "vocabulary", F.explode("strategies").alias("s"))
    templates = s.select("country", F.col("s.id").alias("strategy"), "vocabulary", F.col("s.vehicle_classes").alias("classes"), F.explode_outer("s.query_templates").alias("language", "templates"))
    templates = templates.select("country", "strategy", "classes", F.expr("vocabulary[language]").alias("terms"), F.explode_outer("templates").alias("template"))
    terms = F.aggregate(F.transform("classes", lambda c: F.size(F.col("terms")[c])), F.lit(0), lambda a, x: a + x)
    # {{ and }} are escapes of the template format.
    bare = F.regexp_replace(F.regexp_replace("template", r"\{\{", ""), r"\}\}", "")
    n = F.when(F.col("template").isNull(), 0).when(bare.contains("{vehicle_term}"), terms).otherwise(1)
    counted = templates.groupBy("country", "strategy").agg(F.sum(n).cast("long").alias("queries"))
    seeds = s.select("country", F.col("s.id").alias("strategy"), F.size(F.array_distinct("s.seed_urls")).cast("long").alias("seeds"))
    return seeds.join(counted, ["country", "strategy"])


def fill_template(template: Column, locality: Column, term: Column) -> Column:
    """str.format of the two placeholders, with doubled braces as escapes."""
    # Placeholders are taken out before doubled closing braces, since one may follow the other.
    marks = (("{{", "\u0001"), ("{locality}", "\u0003"), ("{vehicle_term}", "\u0004"), ("}}", "\u0002"))
    out = template
    for text, mark in marks:
        out = F.replace(out, F.lit(text), F.lit(mark))
    for mark, text in (("\u0001", F.lit("{")), ("\u0002", F.lit("}")), ("\u0003", locality), ("\u0004", term)):
        out = F.replace(out, F.lit(mark), text)
    return out


def query_tasks(profiles: DataFrame, localities: DataFrame) -> DataFrame:
    """country, strategy, locality_code, language, classes, query, lane order columns: every search query of the frontier.

    The frontier is a product by definition; take ``frontier_size`` first, and ``round_robin_page`` where a page is enough.
    """
    s = profiles.select("country", "vocabulary", F.posexplode(F.array_sort("strategies", lambda a, b: F.when(a["priority"] != b["priority"], b["priority"] - a["priority"]).otherwise(F.when(a["id"] < b["id"], -1).otherwise(1)))).alias("strategy_lane", "s"))
    t = s.select("country", "vocabulary", "strategy_lane", "s", F.explode(F.array_sort(F.map_entries("s.query_templates"))).alias("e"))
    t = t.select("*", F.posexplode("e.value").alias("template_index", "template"))
    uses = F.regexp_replace(F.regexp_replace("template", r"\{\{", ""), r"\}\}", "").contains("{vehicle_term}")
    classes = F.when(uses, F.array_sort("s.vehicle_classes")).otherwise(F.array(F.lit(None).cast("string")))
    t = t.select("*", F.explode(classes).alias("class")).withColumn("terms", F.when(F.col("class").isNull(), F.array(F.lit(""))).otherwise(F.expr("vocabulary[e.key][class]")))
    t = t.select("*", F.posexplode("terms").alias("term_index", "term"))
    place = F.concat(F.col("name"), F.when(F.col("region").isNotNull(), F.concat(F.lit(", "), F.col("region"))).otherwise(F.lit("")), F.lit(", "), F.col("country"))
    return t.join(localities.select("country", F.col("code").alias("locality_code"), "name", "region"), "country").select(
        "country", F.col("s.id").alias("strategy"), "strategy_lane", "locality_code", F.col("e.key").alias("language"), "template_index", "class", "term_index",
        F.when(F.col("class").isNull(), F.array_sort("s.vehicle_classes")).otherwise(F.array("class")).alias("classes"), fill_template(F.col("template"), place, F.col("term")).alias("query"),
    )


def page_meta(plans: DataFrame, offset: Column, limit: Column) -> DataFrame:
    """offset, next_offset (null at the end) and complete of a page of each plan (total_tasks)."""
    after = F.least(F.col("total_tasks"), offset + limit)
    return plans.withColumns({"offset": offset, "next_offset": F.when(after < F.col("total_tasks"), after), "complete": after >= F.col("total_tasks")})


def keyset_page(df: DataFrame, keys: list[str], after: tuple, limit: int) -> DataFrame:
    """The next ``limit`` rows by keys after a cursor; the comparison is by tuple and reaches the scan."""
    test = F.lit(False)
    for k in range(len(keys)):
        equal = F.lit(True)
        for j in range(k):
            equal = equal & (F.col(keys[j]) == F.lit(after[j]))
        test = test | (equal & (F.col(keys[k]) > F.lit(after[k])))
    if len(keys) == 1:
        test = F.col(keys[0]) > F.lit(after[0])
    return df.filter(test).orderBy(*keys).limit(limit)


def due_windows(schedules: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """schedule_id, due_at of the windows due at now and not generated yet, oldest first kept by their order: backlog is never skipped."""
    first, step = F.col("starts_at").cast("long"), F.col("interval_seconds").cast("long")
    last = first + F.expr("cast(floor(({} - cast(starts_at as bigint)) / interval_seconds) as bigint)".format("cast(_now as bigint)")) * step
    open_ = schedules.withColumn("_now", now).filter("not paused and starts_at <= _now")
    windows = open_.select("schedule_id", F.explode(F.sequence(first, last, step)).alias("_at")).select("schedule_id", F.timestamp_seconds("_at").alias("due_at"))
    return windows.join(done.select("schedule_id", "due_at"), ["schedule_id", "due_at"], "left_anti")


def shares(due: DataFrame, max_tasks: int, max_schedules: int) -> DataFrame:
    """Due schedules (schedule_id, last_tick, next_at, size) in their order of turn, each with the tasks it gets of ``max_tasks``.

    A share depends on what the ones before took, so the ordered list, at most max_schedules long, is folded.
    """
    n = min(max_schedules, max_tasks)
    picked = due.orderBy("last_tick", "next_at", "schedule_id").limit(n)
    ordered = picked.agg(F.array_sort(F.collect_list(F.struct("last_tick", "next_at", "schedule_id", "size"))).alias("due"))
    start = F.struct(F.lit(max_tasks).cast("long").alias("left"), F.size("due").cast("long").alias("turns"), F.expr("cast(array() as array<bigint>)").alias("given"))

    def give(s, x):
        share = F.when(s["left"] > 0, F.least(x["size"].cast("long"), F.greatest(F.lit(1).cast("long"), F.floor(s["left"] / s["turns"]).cast("long")))).otherwise(F.lit(0).cast("long"))
        return F.struct((s["left"] - share).alias("left"), (s["turns"] - 1).alias("turns"), F.array_append(s["given"], share).alias("given"))

    folded = ordered.select("due", F.aggregate("due", start, give)["given"].alias("given"))
    return folded.select(F.posexplode(F.arrays_zip("due", "given")).alias("turn", "x")).select("turn", "x.due.schedule_id", "x.given")


def inspect_schedule(schedules: DataFrame, generations: DataFrame, most: int = 1000) -> DataFrame:
    """Schedules with their first ``most`` generations by due time, and whether there are more."""
    nth = F.row_number().over(Window.partitionBy("schedule_id").orderBy("due_at"))
    kept = generations.withColumn("_nth", nth).groupBy("schedule_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("_nth") <= most, F.struct("due_at", "plan_id", "tasks_generated", "generation_complete")))).alias("generations"), (F.max("_nth") > most).alias("truncated")
    )
    return schedules.join(kept, "schedule_id", "left").withColumn("truncated", F.coalesce("truncated", F.lit(False)))


def advance(schedules: DataFrame, pages: DataFrame) -> DataFrame:
    """Schedules (next_at, offset, last_tick) after generated pages (schedule_id, complete, next_offset, turn): a window goes on until it is complete."""
    met = schedules.join(pages.select("schedule_id", "complete", F.col("next_offset").alias("_offset"), "turn"), "schedule_id", "left")
    done = F.coalesce("complete", F.lit(False))
    return met.withColumns({
        "next_at": F.when(done, F.col("next_at") + F.col("interval_seconds")).otherwise(F.col("next_at")), "offset": F.when(done, F.lit(0)).otherwise(F.coalesce("_offset", F.col("offset"))),
        "last_tick": F.coalesce("turn", F.col("last_tick")),
    }).drop("complete", "_offset", "turn")
