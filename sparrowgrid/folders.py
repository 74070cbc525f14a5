"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def ready(spark: SparkSession) -> SparkSession:
    """Make checkpoint() usable: the session's spark.checkpoint.dir. On a single machine, as in tests, a folder of it where none is named."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (spark.sparkContext.master or "").startswith("local["):
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sparrowgrid-"))
    return spark


def fresh(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{ready(spark).sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
