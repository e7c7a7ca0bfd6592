"""Event-time operators: windowed counts, distinct within a watermark, interval joins, bounded follows. Each takes a stream or a table and means the same on both."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

WINDOWS = ("tumbling", "sliding", "session")


def seconds(time) -> Column:
    return F.col(time).cast("timestamp").cast("double")


def on_clock(rows: DataFrame, time: str) -> DataFrame:
    """Watermarks need times with a zone: those of a stream without one are read in the session's zone."""
    return rows.withColumn(time, F.col(time).cast("timestamp")) if rows.isStreaming else rows


def windowed_counts(events: DataFrame, kind: str, by: Sequence[str] = (), time: str = "ts", size: str = "1 hour", slide: str = "15 minutes", gap: str = "30 minutes",
                    delay: str = "10 minutes", value: str | None = None) -> DataFrame:
    """Rows (and the sum of ``value``) per group and tumbling, sliding or session window; rows without a time are in no window.

    On a stream the watermark closes a window ``delay`` after its end and drops what comes later; on a table it has no effect.
    """
    if kind not in WINDOWS:
        raise ValueError(f"kind must be one of {WINDOWS}")
    w = {"tumbling": lambda: F.window(time, size), "sliding": lambda: F.window(time, size, slide), "session": lambda: F.session_window(time, gap)}[kind]()
    counted = [F.count("*").alias("n"), *([F.sum(value).alias("total")] if value else [])]
    kind_of_time = events.schema[time].dataType
    timed = on_clock(events, time).filter(F.col(time).isNotNull()).withWatermark(time, delay)
    grouped = timed.groupBy(*by, w.alias("w")).agg(*counted)
    return grouped.select(*by, F.col("w.start").cast(kind_of_time).alias("window_start"), F.col("w.end").cast(kind_of_time).alias("window_end"), *grouped.columns[len(by) + 1:])


def rounds_with_watermark(rows: DataFrame, round_col: str, time: str, delay_seconds: float, lag: int = 2) -> DataFrame:
    """Rows with ``watermark``: the time (in seconds) before which a stream that reads one round a micro-batch drops what it gets in this round.

    It is the largest time up to ``lag`` rounds before, less the delay: late rows are judged by the watermark that the micro-batch before had.
    """
    most = rows.groupBy(round_col).agg(F.max(seconds(time)).alias("_most"))  # one row a round
    w = Window.orderBy(round_col).rowsBetween(Window.unboundedPreceding, -lag)
    marks = most.select(round_col, (F.floor(F.max("_most").over(w) * 1000) / 1000 - delay_seconds).alias("watermark"))
    return rows.join(F.broadcast(marks), round_col)


def late_rows(rows: DataFrame, round_col: str, time: str = "ts", size_seconds: int = 3600, delay_seconds: float = 600, lag: int = 2) -> DataFrame:
    """Batch account of the rows that a stream of tumbling windows drops: their window ended before the watermark."""
    end = (F.floor(seconds(time) / size_seconds) + 1) * size_seconds
    return rounds_with_watermark(rows, round_col, time, delay_seconds, lag).filter(end <= F.col("watermark")).drop("watermark")


def distinct_within(rows: DataFrame, keys: Sequence[str], time: str = "ts", delay: str = "10 minutes", delay_seconds: float = 600, order: Sequence[str] = ()) -> DataFrame:
    """Rows whose keys did not occur within the delay before them.

    On a stream the state of a key goes when the watermark has passed its first row by the delay. On a table a row counts as a repeat if the
    row of its keys before it is at most the delay older. Both agree wherever a key's repeats lie within the delay of its first row and its
    next new row lies beyond what the watermark has passed.
    """
    if rows.isStreaming:
        return on_clock(rows, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
    before = F.lag(seconds(time)).over(Window.partitionBy(*keys).orderBy(time, *order))
    return rows.withColumn("_gap", seconds(time) - before).filter(F.col("_gap").isNull() | (F.col("_gap") > delay_seconds)).drop("_gap")


def interval_join(left: DataFrame, right: DataFrame, by: str, lower: int, upper: int, left_time: str = "left_ts", right_time: str = "right_ts", delay: str = "10 minutes") -> DataFrame:
    """Pairs with equal ``by`` whose right time is ``lower`` to ``upper`` seconds after the left time, both included.

    On streams two watermarks bound what either side has to keep. On tables both sides meet on the key and a stretch of time as long as the
    interval, so a key that holds many rows is spread over its stretches.
    """
    if left.isStreaming or right.isStreaming:
        a = on_clock(left, left_time).withWatermark(left_time, delay).withColumnRenamed(by, "_left_by")
        b = on_clock(right, right_time).withWatermark(right_time, delay)
        within = (F.col(right_time) >= F.col(left_time) + F.expr(f"INTERVAL {lower} SECONDS")) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {upper} SECONDS"))
        return a.join(b, (F.col("_left_by") == F.col(by)) & within).drop("_left_by")
    width = max(1, upper - lower)
    first, last = F.floor((seconds(left_time) + lower) / width), F.floor((seconds(left_time) + upper) / width)
    a = left.filter(F.col(left_time).isNotNull()).withColumn("_stretch", F.explode(F.sequence(first, last)))
    b = right.withColumn("_stretch", F.floor(seconds(right_time) / width))
    apart = seconds(right_time) - seconds(left_time)
    return a.join(b, [by, "_stretch"]).filter(apart.between(lower, upper)).drop("_stretch")


class _Follow(StatefulProcessor):
    """Keys of one project that are planned or done, and how many were planned."""

    def __init__(self, key: str, budget: int):
        self.key, self.budget = key, budget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", StructType([StructField("key", StringType())]), StructType([StructField("planned", IntegerType())]))
        self.used = handle.getValueState("used", StructType([StructField("n", IntegerType())]))

    def handleInitialState(self, key, initial: pd.DataFrame, timer_values) -> None:
        for k in initial[self.key].dropna():
            self.seen.updateValue((k,), (0,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        used = self.used.get()[0] if self.used.exists() else 0
        for pdf in rows:
            keep = []
            for i, k in enumerate(pdf[self.key]):
                if used < self.budget and k is not None and not self.seen.containsKey((k,)):
                    self.seen.updateValue((k,), (1,))
                    used += 1
                    keep.append(i)
            if keep:
                yield pdf.iloc[keep]
        self.used.update((used,))

    def close(self) -> None:
        pass


def follow_stream(candidates: DataFrame, project: str, key: str, budget: int = 12, done: DataFrame | None = None) -> DataFrame:
    """Streaming follows: in order of arrival a project's new keys are let through until its budget is used; done keys cost nothing. Needs the RocksDB state store."""
    seed = None if done is None else done.select(project, key).groupBy(project)
    return candidates.groupBy(project).transformWithStateInPandas(_Follow(key, budget), candidates.schema, "Append", "None", initialState=seed)


def drained(stream: DataFrame, path: str, checkpoint: str, seconds_at_most: int = 600) -> DataFrame:
    """Runs a stream over all that is there into a Parquet table, and the table. A failed run goes on from its checkpoint."""
    q = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    if not q.awaitTermination(seconds_at_most):
        q.stop()
        raise TimeoutError(f"the stream took more than {seconds_at_most} s")
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
