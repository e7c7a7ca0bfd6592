"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.session import checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: White space of the words of ops 6 and 10: blank and the ASCII controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def query(name: str, sql: str | None = None):
    """Registers a query of this subpackage and, where SQL can say the same, its DuckDB text."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def narrow_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """What is written inside passes at most ``size`` at a time to a Python worker: Spark's default is 64 MB, which stands in the executor and in the worker. The session's own bound holds again after."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, survives lost executors, keeps column pruning."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = None
    for k in keys:
        one = F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        cond = one if cond is None else cond & one
    return cond


def gapless(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Numbers 0, 1, ... along ``order`` within each group, with no task that holds a whole group.

    One range exchange orders the rows; what a partition holds of a group is counted, and the counts of the partitions
    before give its offset. ``monotonically_increasing_id`` has the partition in its upper 31 bits and the place in the lower 33.
    """
    place = (F.col("_at") % F.lit(1 << 33)).alias("_place")
    part = F.shiftright("_at", 33).alias("_part")
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id())
    ranged = stored(ranged, "gapless").select("*", place, part).drop("_at")
    runs = ranged.groupBy(group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    # one row for each group and partition: no more of them than tasks, so this window stays small
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = ranged.alias("l").join(offsets.alias("r"), null_safe("l", "r", [group, "_part"]))
    return joined.select("l.*", (F.col("l._place") - F.col("r._first") + F.col("r._offset")).alias(name)).drop("_place", "_part")
