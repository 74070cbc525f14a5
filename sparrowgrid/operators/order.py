"""Orders over whole tables without a window that spans them: ranges of a key, a window inside each, and sums over the ranges before."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a table is cut into.
RANGES = 200


def _cut(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """df with ``_range``, the range of a numeric key (0 for null). Bounds are quantiles, one row of at most ``ranges`` numbers: fixed before anything is dealt, so that a task that is run again deals alike.

    A key is compared with the ends of blocks of bounds, then with those of its block, in columns of their own: the key's own expression, however long, is evaluated once a row.
    """
    at = [k / ranges for k in range(1, ranges)]
    number = F.col(key).cast("double")
    bounds = sorted({float(b) for b in df.agg(F.percentile_approx(number, at, 10_000)).first()[0] or []})
    width = math.isqrt(len(bounds)) + 1
    beyond = lambda b: (F.col("_at") > b).cast("int")
    block = sum((beyond(F.lit(b)) for b in bounds[width - 1 :: width]), F.lit(0))
    padded = F.array(*[F.lit(b) for b in [*bounds, *[math.inf] * width]])
    inside = sum((beyond(F.get(padded, F.col("_block") * width + k)) for k in range(width)), F.lit(0))
    return df.withColumn("_at", number).withColumn("_block", block).withColumn("_range", F.coalesce(F.col("_block") * width + inside, F.lit(0))).drop("_at", "_block")


def before(df: DataFrame, key: str, value: str, name: str, ranges: int = RANGES) -> DataFrame:
    """df with ``name``: the sum of value over all rows of a smaller key. Keys are numbers, each once."""
    cut = _cut(df, key, ranges)
    sums = cut.groupBy("_range").agg(F.sum(value).alias("_sum"))
    # At most ``ranges`` rows.
    earlier = sums.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cut.withColumn("_inside", inside).join(F.broadcast(earlier), "_range").withColumn(name, F.col("_earlier") + F.col("_inside")).drop("_range", "_inside", "_earlier")


def ranked(df: DataFrame, key: str, name: str, ties: tuple[str, ...] = (), ranges: int = RANGES, equal: bool = False) -> DataFrame:
    """df with ``name``: its place from 1 in the order of key, then ties; with ``equal``, rows of one key share the first place (as rank does). Null keys come first."""
    cut = _cut(df, key, ranges)
    sums = cut.groupBy("_range").agg(F.count("*").alias("_sum"))
    earlier = sums.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    w = Window.partitionBy("_range").orderBy(key, *(() if equal else ties))
    place = F.rank().over(w) if equal else F.row_number().over(w)
    return cut.withColumn("_place", place).join(F.broadcast(earlier), "_range").withColumn(name, (F.col("_earlier") + F.col("_place")).cast("long")).drop("_range", "_place", "_earlier")
