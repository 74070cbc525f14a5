"""The folder that driver and executors share, names that don't clash, and memory that workers don't keep."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's own setting by which an action's shuffle files go when it is done. What is read again later is in Parquet by then.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ready(spark: SparkSession) -> SparkSession:
    """Make checkpoint() usable: the session's spark.checkpoint.dir. On a single machine, as in tests, a folder of it where none is named."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (spark.sparkContext.master or "").startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sparrowgrid-"))
    return spark


def through_parquet(df: DataFrame, name: str, written: list[str] | None = None) -> DataFrame:
    """df written to the shared folder as Parquet and read again: lineage ends there. written: gets the path, for ``discard``."""
    spark = ready(df.sparkSession)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    if written is not None:
        written.append(path)
    return spark.read.parquet(path)


def discard(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete tables that nothing reads any more."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def apart(df: DataFrame, key: str) -> DataFrame:
    """df with its key computed anew, so that a join on it has an exchange of its own: Spark can then split a hot key on the other side."""
    return df.withColumn(key, F.col(key) + F.lit(0))


def free(taken: Iterable[str], name: str) -> str:
    """name, with underscores before it until no column of ``taken`` is called so (Spark's names ignore case)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def bucket_count(docs: DataFrame, size: float = 10e6) -> int:
    """One bucket for every ``size`` bytes that the planner expects of the input, 12 at least."""
    expected = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(1 << 20, max(12, math.ceil(expected / size)))


def give_back() -> None:
    """What this process has freed goes back to the system: a Python worker waits for its next task beside the JVM, whose stages may need the memory."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    # Not every C library has it.
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
