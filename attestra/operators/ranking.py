"""Row numbers, first-wins picks, caps, top-k and budgets that hold when one key owns a third of the rows.

Rank filters are written as ``row_number() <= k`` so that Spark limits every group before the shuffle; running numbers
and running sums go through blocks of the order key, so no task ever sorts a whole group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.functions.columns import as_col, lookup
from attestra.functions.urls import handle
from attestra.session import cut_lineage


def first_rows(df: DataFrame, by: Sequence, order_by: Sequence, k: int = 1, rank: str | None = None) -> DataFrame:
    """The first k rows of every group."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))).filter(F.col(name) <= k)
    return out if rank else out.drop(name)


def distinct_first(df: DataFrame, key, order_by: Sequence) -> DataFrame:
    """First row per key; rows without a key all pass, dealt over many window groups so that they are no hot one. One scan of the input."""
    keyed = df.withColumn("_key", as_col(key))
    salted = keyed.withColumn("_salt", F.when(F.col("_key").isNull(), F.monotonically_increasing_id() % 4096))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("_key", "_salt").orderBy(*order_by)))
    return ranked.filter(F.col("_key").isNull() | (F.col("_rank") == 1)).drop("_key", "_salt", "_rank")


def running(df: DataFrame, by: Sequence[str], order: str, value: Column | int, name: str, block: int = 65536) -> DataFrame:
    """Inclusive running sum of ``value`` along a unique integer order column, per group.

    Two levels: a window inside blocks of the order key plus the running total of the blocks before.
    """
    df = df.withColumn("_value", value if isinstance(value, Column) else F.lit(value)).withColumn("_block", F.floor(F.col(order) / block))
    keys = [*by, "_block"]
    totals = df.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1) if by else \
        Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    same = None
    for k in keys:
        cond = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = cond if same is None else same & cond
    part = df.withColumn("_part", F.sum("_value").over(inside))
    joined = part.alias("l").join(offsets.alias("r"), same, "left")
    return joined.select("l.*", (F.col("l._part") + F.col("r._offset")).alias(name)).drop("_value", "_block", "_part")


def number_rows(df: DataFrame, order: str, by: Sequence[str] = (), start: int = 1, name: str = "row_no", block: int = 65536) -> DataFrame:
    """Running numbers along a unique integer order column, continuing at ``start``."""
    return running(df, by, order, F.lit(1).cast("long"), name, block).withColumn(name, F.col(name) + (start - 1))


def number_rows_by(df: DataFrame, order_by: Sequence, by: Sequence[str] = (), start: int = 1, name: str = "row_no") -> DataFrame:
    """Running numbers for any order: one range sort, then per-partition ranks plus partition offsets.

    The sorted table is checkpointed because both passes must see the same partition borders.
    """
    order_by = [as_col(c) for c in order_by]
    ranged = cut_lineage(df.repartitionByRange(*[F.col(c) for c in by], *order_by).withColumn("_pid", F.spark_partition_id()))
    keys = [*by, "_pid"]
    counts = ranged.groupBy(*keys).agg(F.count("*").alias("_n"))
    prior = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(prior), F.lit(0))).drop("_n")
    same = None
    for k in keys:
        cond = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = cond if same is None else same & cond
    ranked = ranged.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    joined = ranked.alias("l").join(offsets.alias("r"), same, "left")
    return joined.select("l.*", (F.col("l._rank") + F.col("r._offset") + (start - 1)).alias(name)).drop("_pid", "_rank")


def top_k(df: DataFrame, by: Sequence[str], order_by: Sequence, k: int) -> DataFrame:
    """First k rows per group with their rank and the number of rows left out."""
    sizes = df.groupBy(*by).agg(F.count("*").alias("_n"))
    return (first_rows(df, by, order_by, k, "rank").join(sizes, list(by))
            .withColumn("omitted", F.greatest(F.col("_n") - k, F.lit(0))).drop("_n"))


def cap_per_source(rows: DataFrame, caps: Mapping[str, int], by: Sequence[str], source: str, order: Sequence, default: int = 20) -> DataFrame:
    """At most ``caps[source]`` rows per group and source in arrival order."""
    ranked = first_rows(rows, [*by, source], order, max([default, *caps.values()]), "_rank")
    return ranked.filter(F.col("_rank") <= F.coalesce(lookup(caps, as_col(source)), F.lit(default))).drop("_rank")


def cap_rounds(rows: DataFrame, stored: DataFrame, batch: Mapping[str, int], total: Mapping[str, int], by: Sequence[str], source: str, order: Sequence,
               default: tuple[int, int] = (20, 200)) -> DataFrame:
    """One round: at most ``batch`` new rows, and ``total`` together with what is stored."""
    have = stored.groupBy(*by, source).agg(F.count("*").alias("_have"))
    s = as_col(source)
    ranked = first_rows(rows, [*by, source], order, max([default[0], *batch.values()]), "_rank").join(have, [*by, source], "left")
    room = F.coalesce(lookup(total, s), F.lit(default[1])) - F.coalesce("_have", F.lit(0))
    return ranked.filter(F.col("_rank") <= F.least(F.coalesce(lookup(batch, s), F.lit(default[0])), room)).drop("_rank", "_have")


def top_under_budget(df: DataFrame, by: Sequence[str], order_by: Sequence, cost, budget: int) -> DataFrame:
    """Rows in rank order while the running cost fits the budget; the first row always stays. Any cost counts as it is, a null one as 0."""
    ranked = number_rows_by(df, order_by, by, name="rank")
    spent = running(ranked, by, "rank", F.coalesce(as_col(cost), F.lit(0)), "running_cost")
    return spent.filter((F.col("rank") == 1) | (F.col("running_cost") <= budget))


def concat_budget(parts: DataFrame, by: Sequence[str], order_by: Sequence, text, budget: int, sep: str = "\n\n", name: str = "text") -> DataFrame:
    """Non-empty parts joined in order until the character budget is used up; the last part is cut to what is left."""
    text = as_col(text)
    limited = first_rows(parts.withColumn("_text", text).filter(F.length("_text") > 0), by, order_by, budget // (1 + len(sep)) + 1, "_rank")
    w = Window.partitionBy(*by).orderBy("_rank")
    size = F.length("_text") + F.when(F.col("_rank") > 1, len(sep)).otherwise(0)
    used = limited.withColumn("_before", F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    room = F.lit(budget) - F.col("_before") - F.when(F.col("_rank") > 1, len(sep)).otherwise(0)
    kept = used.filter(room > 0).withColumn("_cut", F.substring("_text", F.lit(1), room.cast("int")))
    return kept.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_cut"))), lambda s: s["_cut"]), sep).alias(name),
                                 F.count("*").alias("parts"))


def latest(df: DataFrame, by: Sequence[str], ts, seq) -> DataFrame:
    """Row with the greatest timestamp per group; the later arrival wins a tie."""
    rest = [c for c in df.columns if c not in by]
    best = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(as_col(ts), as_col(seq))).alias("_best"))
    return best.select(*by, *[F.col(f"_best.{c}").alias(c) for c in rest])


def pick_smallest(items: DataFrame, size, name, limit: int) -> DataFrame:
    """The smoke sample: smallest items first."""
    return items.orderBy(as_col(size), as_col(name)).limit(limit)


def pick_shuffled(items: DataFrame, key, seed: int, limit: int) -> DataFrame:
    """A deterministic shuffle: the items with the smallest seeded hash, one that other engines have too."""
    return items.orderBy(F.md5(F.concat(as_col(key).cast("string"), F.lit(f":{seed}"))), as_col(key)).limit(limit)


def batches(df: DataFrame, by: Sequence[str], order: str, n: int, name: str = "batch") -> DataFrame:
    return number_rows(df, order, by, start=0, name=name).withColumn(name, F.floor(F.col(name) / n))


def distinct_handles(links: DataFrame, url: str, order: str, by: Sequence[str] = ()) -> DataFrame:
    """by, handle, link, first: every profile once whatever its letters' case, as its first link writes it; a link loses its fragment and closing slashes.

    Partial minima go before the shuffle, so a profile linked by a third of all rows costs one row a task. Null links and those without a profile are
    left out; of rows with one order value the least handle and link count; no rows give no rows.
    """
    name = handle(url)
    plain = F.rtrim(F.substring_index(F.trim(F.col(url)), "#", 1), F.lit("/"))
    found = links.select(*by, F.col(order).alias("first"), name.alias("handle"), plain.alias("link")).filter("handle is not null")
    least = found.groupBy(*by, F.lower("handle").alias("_h")).agg(F.min(F.struct("first", "handle", "link")).alias("x"))
    return least.select(*by, "x.handle", "x.link", "x.first")


def distinct_posts(posts: DataFrame, url: str, order_by: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Rows of posts, of those with one post number (within by) the first only; rows without a number all pass and are not shuffled."""
    number = F.nullif(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"/status/(\d+)", 1), F.lit(""))
    return posts.filter(number.isNull()).unionByName(first_rows(posts.filter(number.isNotNull()), [*by, number], order_by))
