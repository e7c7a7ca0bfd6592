"""Stored tables that runs add to: keyed appends, partition overwrites, marks of the last run, observed writes. A repeated run changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from attestra.functions.columns import as_col
from attestra.operators.joins import append_new
from attestra.operators.ledger import since_last_run
from attestra.operators.model import Model, model_map
from attestra.operators.ranking import first_rows


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


# --- S12 --------------------------------------------------------------------------------------------
def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """One folder per value of ``by``; only the folders that ``df`` has rows for are replaced, the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def export_tagged(rows: DataFrame, path: str, exports: dict[str, Column], by: str = "export") -> None:
    """Named filtered exports of one table, one folder each, in one pass: a row goes to every export whose filter it meets."""
    names = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in exports.items()]), lambda x: x.isNotNull())
    overwrite_partitions(rows.withColumn(by, F.explode(names)), path, [by])


# --- S15, J-21 --------------------------------------------------------------------------------------
def stored_rows(spark: SparkSession, path: str, schema, but: str | None = None) -> DataFrame:
    """Rows of all batches of a keyed table (without batch ``but``); no rows where nothing is stored yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame([], schema).columns
    rows = spark.read.parquet(path).filter(~F.col("batch").cast("string").eqNullSafe(F.lit(but))) if but is not None else spark.read.parquet(path)
    return rows.select(*names)


def append_batch(df: DataFrame, path: str, batch: str, key: str, order: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Appends the first row of every key that no other batch has, in a folder of the batch, and returns what the batch has added.

    A replay of a batch writes its own folder again and looks at the other batches only, so it neither loses nor doubles rows. Rows without a
    key are all new.
    """
    spark = df.sparkSession
    fresh = append_new(df, stored_rows(spark, path, df.schema, but=batch), key, by)
    once = first_rows(fresh.filter(as_col(key).isNotNull()), [*by, key], order).unionByName(fresh.filter(as_col(key).isNull()))
    once.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    return spark.read.schema(df.schema.add("batch", "string")).parquet(path).filter(F.col("batch") == batch).drop("batch")


def cached_model_map(df: DataFrame, prompt: Column, fn: Model, path: str, batch: str, answer: str = "answer", **options) -> DataFrame:
    """Rows with the model's answers through a stored cache: known prompts are looked up, the others are asked once and appended.

    Answers left empty after the last retry are not stored, so the next run asks again.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_prompt", prompt).withColumn("prompt_hash", F.sha2("_prompt", 256))
    cache = stored_rows(spark, path, "prompt_hash string, answer string")
    missing = keyed.select("prompt_hash", "_prompt").dropDuplicates(["prompt_hash"]).join(cache.select("prompt_hash"), "prompt_hash", "left_anti")
    asked = model_map(missing.select("_prompt"), F.col("_prompt"), fn, "answer", **options).select("prompt_hash", "answer").filter("answer <> ''")
    append_batch(asked, path, batch, "prompt_hash", ["answer"])
    known = stored_rows(spark, path, "prompt_hash string, answer string").select("prompt_hash", F.col("answer").alias(answer))
    return keyed.join(known, "prompt_hash", "left").drop("_prompt").withColumn(answer, F.coalesce(answer, F.lit("")))


# --- T3 ---------------------------------------------------------------------------------------------
def delta_tag(stream: DataFrame, path: str, tag: Callable[[DataFrame], DataFrame], key: str, order: Sequence, checkpoint: str, trigger: dict | None = None):
    """Tags only the rows that a round adds: each micro-batch drops keys stored by other rounds, tags the rest and writes its own folder."""

    def one(batch: DataFrame, batch_id: int) -> None:
        append_batch(tag(batch.join(stored_rows(batch.sparkSession, path, tag(batch).schema, but=f"{batch_id:08d}").select(key), key, "left_anti")), path, f"{batch_id:08d}", key, order)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


# --- T4 ---------------------------------------------------------------------------------------------
def last_mark(spark: SparkSession, path: str) -> str | None:
    """The latest stored mark, as text."""
    if not exists(spark, path):
        return None
    return spark.read.schema("mark timestamp").parquet(path).agg(F.max("mark").cast("string").alias("mark")).first().mark


def run_since(df: DataFrame, date: str, path: str, job: Callable[[DataFrame], None]) -> str | None:
    """Runs ``job`` on the items dated after the stored mark and stores the new mark when it has succeeded; a failed run leaves the mark as it was."""
    spark = df.sparkSession
    mark = last_mark(spark, path)
    fresh = since_last_run(df, date, mark)
    job(fresh)
    newest = df.agg(F.max(as_col(date).cast("string").try_cast("timestamp")).alias("mark"))
    newest.filter(F.col("mark").isNotNull() & (F.lit(mark).cast("timestamp").isNull() | (F.col("mark") > F.lit(mark).cast("timestamp")))).write.mode("append").parquet(path)
    return last_mark(spark, path)


# --- S14 --------------------------------------------------------------------------------------------
def write_observed(df: DataFrame, path: str, reason: Column, item: str, groups: dict[str, Column] | None = None) -> dict:
    """Writes good and failed rows apart (folders ``failed=false`` and ``failed=true``) and returns the run's manifest, observed while the rows are written: no second pass.

    items, errors, first_id and last_id of the good rows, the reason of the least failed id, and a count for each named group of good rows.
    """
    seen = Observation()
    failed = F.col("error_reason").isNotNull()
    good = lambda c: F.when(~failed, c)
    metrics = [F.count(good(F.lit(1))).alias("items"), F.count(F.when(failed, 1)).alias("errors"), F.min(good(F.col(item))).alias("first_id"), F.max(good(F.col(item))).alias("last_id"),
               F.min(F.when(failed, F.struct(F.col(item), "error_reason"))).alias("least"), *[F.count_if(~failed & F.coalesce(c, F.lit(False))).alias(f"n_{g}") for g, c in (groups or {}).items()]]
    marked = df.withColumn("error_reason", reason).withColumn("failed", failed)
    marked.observe(seen, *metrics).write.mode("overwrite").partitionBy("failed").parquet(path)
    got = dict(seen.get)
    least = got.pop("least")
    return {**got, "first_error": None if least is None else least["error_reason"]}
