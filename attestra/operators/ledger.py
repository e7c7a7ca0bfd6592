"""Crawl ledger: normalise, merge, mark, skip sets; receipts, checkpoints and unchanged-input skips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.functions.columns import as_col
from attestra.operators.ranking import first_rows, number_rows

KEYS = ("section", "entry_key")


def normalize_ledger(df: DataFrame) -> DataFrame:
    """One row per section and key; a review mark sticks."""
    key = F.trim("entry_key")
    return df.withColumn("entry_key", key).filter("entry_key <> ''").groupBy(*KEYS).agg(F.bool_or(F.coalesce("reviewed", F.lit(False))).alias("reviewed"))


def merge_ledger(prev: DataFrame, disk: DataFrame) -> DataFrame:
    """Previous rows stay; keys found on disk only come in unreviewed."""
    found = disk.select("section", "entry_key", F.lit(False).alias("reviewed"))
    return normalize_ledger(prev.select(*KEYS, "reviewed").unionByName(found))


def mark_reviewed(ledger: DataFrame, marks: DataFrame) -> DataFrame:
    return normalize_ledger(ledger.select(*KEYS, "reviewed").unionByName(marks.select(*KEYS, F.lit(True).alias("reviewed"))))


def reviewed_keys(ledger: DataFrame) -> DataFrame:
    return ledger.filter("reviewed").select(*KEYS).distinct()


def checkpoint_points(published: DataFrame, order: str, n: int = 5) -> DataFrame:
    """Every n-th published item is followed by a ledger checkpoint."""
    return number_rows(published, order).filter(F.col("row_no") % n == 0)


def resume_step(receipts: DataFrame, by: Sequence[str], step: str = "step", receipt: str = "txid") -> DataFrame:
    """First step without a receipt; one past the last when all have one."""
    missing = F.coalesce(as_col(receipt), F.lit("")) == ""
    return receipts.groupBy(*by).agg(F.coalesce(F.min(F.when(missing, F.col(step))), F.max(step) + 1).alias("resume_at"))


def skip_unchanged(items: DataFrame, manifest: DataFrame, key: str, handles: str = "handles") -> DataFrame:
    """Items whose sorted handle list differs from the last successful run's, or that have none."""
    done = manifest.filter("status = 'success'").select(key, F.array_sort(handles).alias("_h"))
    marked = items.withColumn("_h", F.array_sort(handles))
    same = marked.filter(F.size(handles) > 0).join(done, [key, "_h"], "left_semi").select(key)
    return items.join(same, key, "left_anti")


def since_last_run(df: DataFrame, date, mark: str | None) -> DataFrame:
    """Items dated after the last run; without a last run, or with a date that cannot be read, an item is new."""
    if mark is None:
        return df
    when = as_col(date).cast("string").try_cast("timestamp")
    return df.filter(when.isNull() | (when > F.lit(mark).cast("timestamp")))


def follow_budget(candidates: DataFrame, done: DataFrame, by: Sequence[str], key: str, order: Sequence, budget: int = 12) -> DataFrame:
    """The first candidates per project within the budget, those already done left out and repeats counted once."""
    fresh = candidates.join(done.select(*by, key), [*by, key], "left_anti")
    return first_rows(first_rows(fresh, [*by, key], order), by, order, budget)
