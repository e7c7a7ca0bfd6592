"""Stored tables: replays change nothing, failed runs leave the mark, one scan writes and counts."""

import tempfile

import pytest
from pyspark.sql import functions as F

from attestra.sources import tables as S


@pytest.fixture
def at():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp") + "/table"


def test_partitions_that_are_not_written_stay(spark, at):
    rows = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(30)], "n int, c string")
    S.overwrite_partitions(rows, at, ["c"])
    S.overwrite_partitions(rows.filter("c = 'b'").withColumn("n", F.col("n") + 100), at, ["c"])
    got = spark.read.parquet(at)
    assert sorted((r.n, r.c) for r in got.collect()) == sorted((i + 100 * (i % 3 == 1), "abc"[i % 3]) for i in range(30))
    assert "PartitionFilters: [isnotnull(c" in got.filter("c = 'a'")._jdf.queryExecution().toString()


def test_appends_are_safe_to_replay(spark, at):
    first = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2), (None, 3), (None, 3)], "k string, n int")
    second = spark.createDataFrame([("b", 0), ("c", 5), ("c", 4), (None, 9)], "k string, n int")
    everything = lambda: sorted(((r.k, r.n) for r in S.stored_rows(spark, at, first.schema).collect()), key=str)
    assert S.stored_rows(spark, at, first.schema).count() == 0
    S.append_batch(first, at, "1", "k", ["n"])
    added = S.append_batch(second, at, "2", "k", ["n"])
    once = everything()
    assert once == sorted([("a", 0), ("b", 2), (None, 3), (None, 3), ("c", 4), (None, 9)], key=str)
    assert sorted(((r.k, r.n) for r in added.collect()), key=str) == sorted([("c", 4), (None, 9)], key=str)
    for batch, rows in (("2", second), ("1", first), ("2", second)):
        S.append_batch(rows, at, batch, "k", ["n"])
        assert everything() == once


def test_known_prompts_are_not_asked_again(spark, at):
    calls = tempfile.mkdtemp(prefix="spark-", dir="/tmp")

    def model(prompts):
        import uuid

        with open(f"{calls}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(prompts))
        return ["" if p == "silent" else p.upper() for p in prompts]

    def asked():
        import os

        got = []
        for name in sorted(os.listdir(calls)):
            with open(f"{calls}/{name}") as f:
                got += f.read().split("\n")
            os.remove(f"{calls}/{name}")
        return sorted(got)

    run = lambda words, batch: {r.p: r.answer for r in S.cached_model_map(spark.createDataFrame([(w,) for w in words], "p string"), F.col("p"), model, at, batch, retries=1, wait=0.0).collect()}
    assert run(["x", "y", "x", "silent"], "1") == {"x": "X", "y": "Y", "silent": ""}
    assert asked() == ["silent", "x", "y"]
    assert run(["y", "z", "silent"], "2") == {"y": "Y", "z": "Z", "silent": ""}
    assert asked() == ["silent", "z"]  # an empty answer is not stored


def test_a_failed_run_leaves_the_mark(spark, at):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-03-01"), (3, "someday"), (4, None)], "n int, day string")
    seen = []
    job = lambda df: seen.append(sorted(r.n for r in df.collect()))
    assert S.last_mark(spark, at) is None
    assert S.run_since(rows.filter("n <> 2"), "day", at, job).startswith("2024-01-01")

    def broken(df):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        S.run_since(rows, "day", at, broken)
    assert S.last_mark(spark, at).startswith("2024-01-01")
    assert S.run_since(rows, "day", at, job).startswith("2024-03-01")
    assert S.run_since(rows, "day", at, job).startswith("2024-03-01")
    assert seen == [[1, 3, 4], [2, 3, 4], [3, 4]]
    assert S.run_since(rows.limit(0), "day", at, job).startswith("2024-03-01")


def test_one_scan_writes_and_counts(spark, at):
    rows = spark.range(100).withColumn("g", F.when(F.col("id") % 3 == 0, "x"))
    got = S.write_observed(rows, at, F.when(F.col("id") % 10 == 7, F.concat(F.lit("bad "), F.col("id").cast("string"))), "id", {"x": F.col("g") == "x"})
    assert got == {"items": 90, "errors": 10, "first_id": 0, "last_id": 99, "n_x": 31, "first_error": "bad 7"}
    back = spark.read.parquet(at)
    assert back.filter("failed = 'true'").count() == 10 and back.filter("failed = 'false'").agg(F.min("id")).first()[0] == 0
    assert S.write_observed(rows.limit(0), at + "-none", F.lit(None).cast("string"), "id")["items"] == 0


def test_rounds_are_tagged_once(spark, at):
    import time

    src = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    tag = lambda b: b.withColumn("tag", F.concat(F.lit("t"), "k"))
    checkpoint = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    want = {}
    for i, keys in enumerate((["a", "b", "a"], ["b", "c"], ["a", "d", "d"])):
        spark.createDataFrame([(k, 10 * i + j) for j, k in enumerate(keys)], "k string, n long").coalesce(1).write.mode("append").parquet(src)
        for j, k in enumerate(keys):
            want.setdefault(k, 10 * i + j)
        time.sleep(1.1)
        q = S.delta_tag(spark.readStream.schema("k string, n long").parquet(src), at, tag, "k", ["n"], checkpoint)
        assert q.awaitTermination(200)
    rows = lambda: {r.k: (r.n, r.tag) for r in S.stored_rows(spark, at, "k string, n long, tag string").collect()}
    assert rows() == {k: (n, f"t{k}") for k, n in want.items()}
    # the last round once more, as after a failure between its write and its commit
    last = spark.createDataFrame([("a", 20), ("d", 21), ("d", 22)], "k string, n long")
    S.append_batch(tag(last), at, "00000002", "k", ["n"])
    assert rows() == {k: (n, f"t{k}") for k, n in want.items()}


def test_exports_of_one_table(spark, at):
    S.export_tagged(spark.range(20), at, {"even": F.col("id") % 2 == 0, "small": F.col("id") < 5})
    got = spark.read.parquet(at)
    assert sorted(r.id for r in got.filter("export = 'even'").collect()) == list(range(0, 20, 2)) and got.filter("export = 'small'").count() == 5
