"""Event-time operators: streams give what their batch twins give, and late rows are those that the twin names."""

import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from attestra.operators.ledger import follow_budget
from attestra.streaming import windows as W


def fresh():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def rounds_on_disk(rows, rounds):
    """One file a round, in the order in which a file stream reads them."""
    import time

    at = fresh()
    for i in rounds:
        rows.filter(F.col("round") == i).drop("round").coalesce(1).write.mode("append").parquet(at)
        time.sleep(1.1)  # files are read by their time of change
    return at


@pytest.fixture(scope="module")
def events(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "ts", "user_id", "event_type")


def closing(spark, events, days=400):
    """A row so late in time that it closes every window before it."""
    return events.limit(1).select("event_id", (F.col("ts") + F.expr(f"INTERVAL {days} DAYS")).alias("ts"), F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"))


def read(spark, rows, at):
    return spark.readStream.schema(rows.drop("round").schema).option("maxFilesPerTrigger", 1).parquet(at)


@pytest.mark.parametrize("kind", W.WINDOWS)
def test_windows_in_order_lose_nothing(spark, events, kind):
    """Rounds that follow the clock: no row is late, and every closed window equals the table's."""
    rows = events.withColumn("round", F.ntile(3).over(Window.orderBy("ts")))
    rows = rows.unionByName(closing(spark, events).withColumn("round", F.lit(4)))
    by = ["user_id"] if kind == "session" else ["event_type"]
    stream = W.windowed_counts(read(spark, rows, rounds_on_disk(rows, range(1, 5))), kind, by)
    got = W.drained(stream, fresh(), fresh())
    want = W.windowed_counts(events, kind, by)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_are_those_of_the_twin(spark, events):
    rows = events.withColumn("round", (F.col("event_id") * 7 % 40 / 8).cast("int"))
    rows = rows.unionByName(closing(spark, events).withColumn("round", F.lit(5))).unionByName(closing(spark, events, 500).withColumn("round", F.lit(6)))
    stream = W.windowed_counts(read(spark, rows, rounds_on_disk(rows, range(7))), "tumbling", ["event_type"])
    got = W.drained(stream, fresh(), fresh())
    late = W.late_rows(rows, "round")
    assert late.count() > 0
    want = W.windowed_counts(rows.join(late.select("event_id", "ts"), ["event_id", "ts"], "left_anti").filter("event_type <> 'end'"), "tumbling", ["event_type"])
    assert sorted(map(tuple, got.filter("event_type <> 'end'").collect())) == sorted(map(tuple, want.collect()))


def test_distinct_within_the_watermark(spark, events):
    """Every row comes again a minute later, in the same round or the next; state of old keys goes."""
    again = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 MINUTE"))
    rows = events.withColumn("key", F.col("event_id").cast("string")).unionByName(again.withColumn("key", F.col("event_id").cast("string")))
    rows = rows.withColumn("round", F.ntile(3).over(Window.orderBy("ts")))
    stream = W.distinct_within(read(spark, rows, rounds_on_disk(rows, range(1, 4))), ["key"])
    q = stream.writeStream.format("memory").queryName("distinct_out").option("checkpointLocation", fresh()).trigger(availableNow=True).start()
    assert q.awaitTermination(200)
    want = W.distinct_within(rows, ["key"], order=["event_id"])
    assert sorted(r.key for r in spark.table("distinct_out").collect()) == sorted(r.key for r in want.collect())
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert kept[-1] < events.count() / 10  # keys older than the delay are forgotten


def test_interval_join_of_streams(spark, events):
    rows = events.withColumn("round", F.ntile(2).over(Window.orderBy("ts")))
    at = rounds_on_disk(rows, (1, 2))

    def sides(e):
        return (e.filter("event_type = 'click'").select("user_id", F.col("event_id").alias("left_id"), F.col("ts").alias("left_ts")),
                e.filter("event_type <> 'click'").select("user_id", F.col("event_id").alias("right_id"), F.col("ts").alias("right_ts")))

    stream = W.interval_join(*sides(read(spark, rows, at)), "user_id", -300, 7200)
    got = W.drained(stream, fresh(), fresh())
    want = W.interval_join(*sides(events), "user_id", -300, 7200)
    plain = sides(events)
    every = plain[0].join(plain[1], "user_id").filter((F.unix_micros("right_ts") - F.unix_micros("left_ts")).between(-300 * 10**6, 7200 * 10**6))
    pairs = lambda df: sorted((r.left_id, r.right_id) for r in df.collect())
    assert pairs(got) == pairs(want) == pairs(every) and want.count() > 0


def test_follow_stream(spark):
    """Micro-batches use up a project's budget; done keys cost nothing and repeats count once."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = spark.createDataFrame([(f"p{i % 3}", f"k{i * 5 % 17}" if i % 11 else None, i, i // 40) for i in range(120)], "project string, key string, seq long, round int")
    done = spark.createDataFrame([("p0", "k5"), ("p1", "k10"), ("p9", "k1")], "project string, key string")
    ordered = rows.orderBy("seq")
    stream = W.follow_stream(read(spark, rows, rounds_on_disk(ordered, range(3))), "project", "key", 6, done)
    q = stream.writeStream.format("memory").queryName("follow_out").option("checkpointLocation", fresh()).trigger(availableNow=True).start()
    assert q.awaitTermination(200)
    got = sorted((r.project, r.key) for r in spark.table("follow_out").collect())
    want = follow_budget(rows.filter("key is not null"), done, ["project"], "key", ["seq"], 6)
    assert got == sorted((r.project, r.key) for r in want.collect())
