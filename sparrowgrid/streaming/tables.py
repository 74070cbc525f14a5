"""Streams over the same operators: file streams in, tables out, with effects that count once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..folders import fresh as shared_path
from ..operators import presence

#: Buckets of keys in a ledger: a batch reads those that it touches.
BUCKETS = 64


def read(spark: SparkSession, path: str, time: str = "ts", files: int = 1) -> DataFrame:
    """A Parquet file stream with its time as a proper timestamp, so that it can carry a watermark."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files)
    if not _is_folder(spark, path):
        # A stream watches folders: of this one, only the file.
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    source = reader.parquet(path)
    return source.withColumn(time, F.col(time).cast("timestamp"))


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is available now, and read what it wrote; each batch is written under its own id, so a repeat replaces itself."""
    spark = stream.sparkSession
    path, schema = shared_path(spark, name), stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/data/*") if _any(spark, f"{path}/data") else spark.createDataFrame([], schema)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def _any(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def dedupe(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """At-least-once to once, within the delay of late copies."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def live_split(stream: DataFrame, now: Column, expires: str) -> DataFrame:
    """Each row with its branch: kept or expired."""
    return stream.withColumn("branch", F.when(F.col(expires) > now, "kept").otherwise("expired"))


def tumbling(stream: DataFrame, time: str, width: str, delay: str, by: list[str]) -> DataFrame:
    """An extension: counts by tumbling windows."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width), *by).count()


def presence_ledger(stream: DataFrame, key: str, cadence: int) -> DataFrame:
    """Presence by a ledger: each batch is appended, and the keys that it touches are folded again from all their events.

    A watermark would drop late evidence that is still within retention; a ledger lets it correct earlier conclusions.
    """
    spark = stream.sparkSession
    path = shared_path(spark, "presence")
    names = [key, *presence.EVENT]

    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.select(*names, bucket.alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/ledger/batch={batch_id}")
        # At most BUCKETS numbers; the folders of other buckets are not read.
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]
        ledger = spark.read.parquet(f"{path}/ledger").filter((F.col("batch") <= batch_id) & F.col("bucket").isin(touched)).select(*names) if touched else batch.select(*names)
        states = presence.states(ledger.join(batch.select(key).distinct(), key, "left_semi"), key, F.lit(cadence))
        states.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/states/batch_id={batch_id}")

    stream.writeStream.foreachBatch(apply).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(f"{path}/states")
    return found.groupBy(key).agg(F.max_by(F.struct("state", "effects", "events"), "batch").alias("s")).select(key, "s.*")
