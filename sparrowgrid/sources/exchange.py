"""Imports and exports: observations, profiles, ordered JSON lines with a rolling checksum, bulk parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import order
from ..operators.evidence import validate_observations
from ..schemas import OBSERVATION, PROFILE, SOURCE_TYPES

#: Fixed value: the longest line of an import.
MOST_LINE = 64 * 1024


def read_observations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) of JSON lines. A malformed or too long line fails the read: an import is all or nothing."""
    lines = spark.read.text(path).select(F.when(F.octet_length("value") > MOST_LINE, F.raise_error(F.lit("line too long"))).otherwise(F.col("value")).alias("value"))
    parsed = lines.select(F.from_json("value", OBSERVATION, {"mode": "FAILFAST"}).alias("o")).select("o.*")
    return validate_observations(parsed)


def write_atomically(df: DataFrame, path: str) -> None:
    """Parquet under a name that must not exist yet; Spark commits all files or none."""
    df.write.mode("errorifexists").parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE).option("mode", "FAILFAST").json(path, multiLine=True)


def profile_faults(profiles: DataFrame) -> DataFrame:
    """country, fault: strategies that cite unknown sources, classes or modes out of vocabulary, languages without words."""
    s = profiles.select("country", "vehicle_classes", "languages", "vocabulary", F.col("sources.id").alias("known"), F.explode("strategies").alias("s"))
    rules = {
        "unknown_source": F.size(F.array_except("s.source_ids", "known")) > 0,
        "class_outside_profile": F.size(F.array_except("s.vehicle_classes", "vehicle_classes")) > 0,
        "source_type": ~F.col("s.source_type").isin(*SOURCE_TYPES),
        "priority": ~F.col("s.priority").between(0, 100),
        "template_language": F.size(F.array_except(F.map_keys("s.query_templates"), "languages")) > 0,
        "vocabulary": F.size(F.array_except("languages", F.map_keys("vocabulary"))) > 0,
    }
    return s.select("country", F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))).alias("fault")).distinct()


def footer(records: DataFrame, key: str, record: str) -> DataFrame:
    """One row: how many records, and a checksum over them in key order: the digest of the digests of runs of 4096, each over its records' digests.

    key: a number, each once. No task holds more than a run's digests, and the last one the runs' (64 bytes for 4096 records).
    """
    rows = records.select(F.col(key).alias("k"), F.sha2(F.col(record), 256).alias("d"))
    runs = order.ranked(rows, "k", "n").groupBy(F.expr("(n - 1) div 4096").alias("run")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("k", "d"))).alias("r"))
    runs = runs.select("run", "n", F.sha2(F.array_join(F.transform("r", lambda x: x["d"]), ""), 256).alias("digest"))
    whole = runs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("records"), F.array_sort(F.collect_list(F.struct("run", "digest"))).alias("r"))
    return whole.select("records", F.sha2(F.array_join(F.transform("r", lambda x: x["digest"]), ""), 256).alias("sha256"))


def write_lines(header: DataFrame, records: DataFrame, receipts: DataFrame, foot: DataFrame, path: str) -> None:
    """JSON lines in four ordered sections, each a folder: header, records by key, deletion receipts, footer."""
    for section, df in (("0-header", header), ("1-records", records), ("2-receipts", receipts), ("3-footer", foot)):
        df.write.mode("errorifexists").option("compression", "gzip").json(f"{path}/{section}")


def write_bulk(df: DataFrame, key: str, parts: int, path: str) -> None:
    """gzip JSON lines in parts of key ranges, ordered within each."""
    df.repartitionByRange(parts, key).sortWithinPartitions(key).write.mode("errorifexists").option("compression", "gzip").json(path)
