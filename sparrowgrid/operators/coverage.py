"""Coverage over dense grids. Counts may be zero, ratios without a known denominator are null, and claims never cross-multiply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TERMINAL


def cells(observations: DataFrame, dims: dict[str, str], candidate: str, group: str, observed: str, kinds: dict[str, list[str]] | None = None) -> DataFrame:
    """Facts by cell. dims: output name -> column; an array column is exploded within its own row only."""
    out = observations
    for name, source in dims.items():
        array = observations.schema[source].dataType.simpleString().startswith("array")
        out = out.withColumn(name, F.explode(source) if array else F.col(source))
    counts = [F.countDistinct(F.when(F.col(c) == v, F.col(candidate))).alias(f"{c}_{v}") for c, values in (kinds or {}).items() for v in values]
    return out.groupBy(*dims).agg(F.countDistinct(candidate).alias("candidates"), F.array_sort(F.collect_set(group)).alias("evidence_groups"), F.max(observed).alias("last_observed_at"), *counts)


def dense(facts: DataFrame, axes: list[DataFrame], zero: list[str], empty: list[str] = ()) -> DataFrame:
    """facts on the full grid of axes (each a small table of one column): counts of ``zero`` are 0 and arrays of ``empty`` are empty where nothing is known."""
    grid = axes[0]
    for axis in axes[1:]:
        grid = grid.crossJoin(axis)
    out = grid.join(facts, grid.columns, "left")
    fill = {c: F.coalesce(c, F.lit(0)) for c in zero} | {c: F.coalesce(c, F.array().cast(facts.schema[c].dataType)) for c in empty}
    return out.withColumns(fill).withColumn("coverage_ratio", F.lit(None).cast("double"))


def ratio(certified: Column, declared: Column, comparable: Column | None = None) -> Column:
    """certified / declared, null unless both are known, comparable and the denominator is positive."""
    known = certified.isNotNull() & declared.isNotNull() & (declared > 0)
    return F.when(known if comparable is None else known & comparable, certified.cast("double") / declared)


def unknown_claims(observations: DataFrame, candidate: str, conditions: dict[str, Column]) -> DataFrame:
    """One row: in how many distinct candidates each dimension is unknown."""
    return observations.agg(*[F.countDistinct(F.when(c, F.col(candidate))).alias(name) for name, c in conditions.items()])


def enum_counts(df: DataFrame, column: str, values: list[str], candidate: str) -> DataFrame:
    """Distinct candidates for each value of a closed vocabulary, zero included."""
    return df.agg(*[F.countDistinct(F.when(F.col(column) == v, F.col(candidate))).alias(v) for v in values])


def human_required(access_mode: Column, kind: Column, channel: Column) -> Column:
    return (access_mode == "permission_required") | (channel.isNull() & ((kind == "query") | (access_mode == "manual_review")))


def work_debt(tasks: DataFrame, key: str = "task_key", status: str = "status", human: Column | None = None) -> DataFrame:
    """status, tasks, human_required; a task counts once."""
    once = tasks.dropDuplicates([key])
    wanted = F.lit(False) if human is None else human
    return once.groupBy(status).agg(F.count("*").alias("tasks"), F.count_if(wanted & ~F.col(status).isin(*TERMINAL)).alias("human_required"))


def oldest_pending(tasks: DataFrame, now: Column, by: str = "stratum", status: str = "status", created: str = "created_at", terminal: tuple = TERMINAL) -> DataFrame:
    """Per stratum: pending tasks, the oldest age in seconds (not below 0), and how many ages are unknown."""
    age = F.greatest(F.lit(0.0), (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(created).cast("timestamp"))) / 1e6)
    waiting = tasks.filter(~F.col(status).isin(*terminal))
    return waiting.groupBy(by).agg(F.count("*").alias("tasks"), F.max(age).alias("oldest_age_seconds"), F.count_if(F.col(created).isNull()).alias("unknown_age"))


def ungenerated(plans: DataFrame, tasks: DataFrame) -> DataFrame:
    """Per plan: total_tasks, generated (distinct ordinals in range of tasks without a parent) and remaining, not below 0."""
    made = tasks.filter("parent_task_key is null").join(plans.select("plan_id", "total_tasks"), "plan_id").filter("planner_ordinal >= 0 and planner_ordinal < total_tasks")
    made = made.groupBy("plan_id").agg(F.countDistinct("planner_ordinal").alias("generated"))
    return plans.select("plan_id", "total_tasks").join(made, "plan_id", "left").select(
        "plan_id", "total_tasks", F.coalesce("generated", F.lit(0)).alias("generated"), F.greatest(F.lit(0), F.col("total_tasks") - F.coalesce("generated", F.lit(0))).alias("remaining")
    )


def conflicts(df: DataFrame, keys: list[str], definition: Column) -> DataFrame:
    """Keys with more than one definition."""
    return df.groupBy(*keys).agg(F.countDistinct(definition).alias("definitions")).filter("definitions > 1")


def locality_flags(supplied: DataFrame, keys: list[str], **marks: DataFrame) -> DataFrame:
    """supplied with a boolean for each named table that holds its keys."""
    out = supplied
    for name, table in marks.items():
        out = out.join(table.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return out


def channel_summary(pages: DataFrame, by: list[str]) -> DataFrame:
    """Pages, rows known and unknown, tri-state completeness and warning counts."""
    counted = pages.groupBy(*by).agg(
        F.count("*").alias("pages"), F.sum("row_count").alias("known_rows"), F.count_if(F.col("row_count").isNull()).alias("unknown_rows"),
        F.count_if(F.col("complete")).alias("complete"), F.count_if(~F.col("complete")).alias("incomplete"), F.count_if(F.col("complete").isNull()).alias("unknown_complete"),
    )
    warned = pages.select(*by, F.explode("warnings").alias("w")).groupBy(*by, "w").count()
    warned = warned.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("w", "count")))).alias("warnings"))
    return counted.join(warned, by, "left")


def latest_plan_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(last page of each plan by offset, plans whose pages disagree on their total)."""
    names = [c for c in pages.columns if c != "plan_id"]
    found = pages.groupBy("plan_id").agg(F.max_by(F.struct(*names), "offset").alias("_p"), F.countDistinct("total_tasks").alias("_totals"))
    return found.filter("_totals = 1").select("plan_id", "_p.*"), found.filter("_totals > 1").select("plan_id", F.col("_totals").alias("totals"))
