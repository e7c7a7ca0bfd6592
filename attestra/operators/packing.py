"""Windows, chunks and greedy packing; all row-local folds or bounded windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.columns import as_col
from attestra.functions.text import estimate_tokens, strip_space, words

ARRAY = "array<string>"


def sliding_windows(docs: DataFrame, key: Sequence[str], text: str, size: int = 1125, stride: int = 900) -> DataFrame:
    """Overlapping word windows; the one that reaches the end is the last."""
    base = docs.select(*key, words(text).alias("_w")).filter(F.size("_w") > 0)
    last = F.ceil(F.greatest(F.size("_w") - size, F.lit(0)) / stride).cast("int")
    out = base.select(*key, "_w", F.explode(F.sequence(F.lit(0), last)).alias("window_idx"))
    cut = out.select(*key, "window_idx", F.array_join(F.slice("_w", F.col("window_idx") * stride + 1, F.lit(size)), " ").alias("text"))
    return cut.withColumn("token_estimate", estimate_tokens("text"))


def fixed_chunks(docs: DataFrame, key: Sequence[str], text: str, n: int = 500) -> DataFrame:
    base = docs.select(*key, words(text).alias("_w")).filter(F.size("_w") > 0)
    out = base.select(*key, "_w", F.explode(F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / n).cast("int"))).alias("chunk_no"))
    return out.select(*key, "chunk_no", F.concat(F.lit("chunk_"), F.col("chunk_no").cast("string")).alias("section_heading"),
                      F.array_join(F.slice("_w", F.col("chunk_no") * n + 1, F.lit(n)), " ").alias("text"))


def _pack(items: Column, limit: int, sep: str) -> Column:
    """Greedy packing of short items: a full buffer is closed before the next item goes in."""
    gap = len(sep)
    start = F.struct(F.array().cast(ARRAY).alias("done"), F.lit(None).cast("string").alias("buf"), F.lit(0).alias("size"))

    def step(acc, s):
        full = acc["buf"].isNotNull() & (acc["size"] + F.length(s) + gap > limit)
        return F.when(full, F.struct(F.array_append(acc["done"], acc["buf"]).alias("done"), s.alias("buf"), (F.length(s) + gap).alias("size"))).otherwise(
            F.struct(acc["done"].alias("done"), F.concat_ws(sep, acc["buf"], s).alias("buf"), (acc["size"] + F.length(s) + gap).alias("size")))

    return F.aggregate(items, start, step, lambda acc: F.when(acc["buf"].isNotNull(), F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"]))


def pack_text(text, max_chars: int = 3200, min_chars: int = 200, paragraph: str = r"\n\s*\n") -> Column:
    """Paragraphs packed up to ``max_chars``; an oversize one is split by sentence on its own; short chunks drop unless alone."""
    items = F.filter(F.transform(F.split(F.coalesce(as_col(text), F.lit("")), paragraph), lambda p: strip_space(p)), lambda p: p != "")
    start = F.struct(F.array().cast(ARRAY).alias("done"), F.lit(None).cast("string").alias("buf"), F.lit(0).alias("size"))

    def step(acc, p):
        closed = F.when(acc["buf"].isNotNull(), F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"])
        pieces = _pack(F.split(p, r"(?<=[.!?])\s+(?=[A-Z(])"), max_chars, " ")
        empty = F.lit(None).cast("string")
        full = acc["buf"].isNotNull() & (acc["size"] + F.length(p) + 2 > max_chars)
        return (F.when(F.length(p) > max_chars, F.struct(F.concat(closed, pieces).alias("done"), empty.alias("buf"), F.lit(0).alias("size")))
                .when(full, F.struct(closed.alias("done"), p.alias("buf"), (F.length(p) + 2).alias("size")))
                .otherwise(F.struct(acc["done"].alias("done"), F.concat_ws("\n\n", acc["buf"], p).alias("buf"), (acc["size"] + F.length(p) + 2).alias("size"))))

    packed = F.aggregate(items, start, step, lambda acc: F.when(acc["buf"].isNotNull(), F.array_append(acc["done"], acc["buf"])).otherwise(acc["done"]))
    return F.when(F.size(packed) == 1, packed).otherwise(F.filter(packed, lambda c: F.length(c) >= min_chars))


def pack_paragraphs(docs: DataFrame, key: Sequence[str], text: str, max_chars: int = 3200, min_chars: int = 200, paragraph: str = r"\n\s*\n") -> DataFrame:
    return docs.select(*key, F.posexplode(pack_text(text, max_chars, min_chars, paragraph)).alias("chunk_no", "text"))


def pack_sections(docs: DataFrame, key: str, sections: Column, max_chars: int = 3200) -> DataFrame:
    """Chunks of heading sections with ids ``key:sN:cM``."""
    s = docs.select(key, F.posexplode(sections).alias("_s", "_sec")).filter(F.col("_sec.body") != "")
    c = s.select(key, "_s", F.col("_sec.heading").alias("section"), F.posexplode(pack_text(F.col("_sec.body"), max_chars)).alias("_c", "text"))
    return c.select(key, F.concat_ws(":", F.col(key).cast("string"), F.concat(F.lit("s"), "_s"), F.concat(F.lit("c"), "_c")).alias("chunk_id"), "section", "text")


def flush_sums(df: DataFrame, by: Sequence[str], order: Sequence, text: str, cost: Column, target: int, sep: str, flush_after: bool, name: str = "pack") -> DataFrame:
    """Greedy packs along an order: a pack closes before the item that would pass the target, or after the one that reaches it.

    Items are folded per group, each as (order, cost), so a group is its numbers and not its texts until the packs are known; the fold keeps
    where packs begin.
    """
    ordered = F.array_sort(F.collect_list(F.struct(*[as_col(o) for o in order], cost.cast("long").alias("_cost"))))
    folded = df.groupBy(*by).agg(ordered.alias("_all"))
    start = F.struct(F.lit(0).alias("i"), F.lit(0).cast("long").alias("size"), F.array(F.lit(0)).alias("starts"))

    def step(acc, s):
        c = s["_cost"]
        turn = (acc["i"] > 0) & ((acc["size"] >= target) if flush_after else ((acc["size"] > 0) & (acc["size"] + c > target)))
        return F.struct((acc["i"] + 1).alias("i"), F.when(turn, c).otherwise(acc["size"] + c).alias("size"),
                        F.when(turn, F.array_append(acc["starts"], acc["i"])).otherwise(acc["starts"]).alias("starts"))  # one entry for a pack, not for an item

    cut = folded.select(*by, "_all", F.aggregate("_all", start, step, lambda acc: acc["starts"]).alias("_starts"))
    names = [o if isinstance(o, str) else "_o" for o in order]
    packs = cut.select(*by, "_all", "_starts", F.posexplode("_starts").alias(name, "_from"))
    until = F.coalesce(F.get("_starts", F.col(name) + 1), F.size("_all"))
    flat = packs.select(*by, name, F.explode(F.slice("_all", F.col("_from") + 1, until - F.col("_from"))).alias("_x")).select(*by, name, *[F.col(f"_x.{n}").alias(n) for n in names])
    joined = df.join(flat, [*by, *names])
    return joined.groupBy(*by, name).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*names, text))), lambda s: s[text]), sep).alias("text"),
                                         F.count("*").alias("items"), F.sum(cost).alias("cost"))


def pack_by_cost(df: DataFrame, by: Sequence[str], order: str, text: str, target: int = 1000) -> DataFrame:
    """Narratives of a dimension packed to about ``target`` estimated tokens."""
    return flush_sums(df, by, [order], text, estimate_tokens(text), target, "\n\n", False)


def pack_transcript(segments: DataFrame, by: Sequence[str], order: str, text: str, max_chars: int = 3200, min_chars: int = 100) -> DataFrame:
    """Transcript pieces gathered until half of ``max_chars`` is reached; short packs drop out."""
    kept = segments.withColumn(text, F.trim(F.col(text))).filter(F.length(text) > 0)
    return flush_sums(kept, by, [order], text, F.length(text), max_chars // 2, " ", True).filter(F.length("text") >= min_chars)


def split_pages(lines: DataFrame, doc: str, page: str, pos: str, line: str) -> DataFrame:
    """Sections across page borders: heading, first and last page, joined body; lines before any heading go to "Body"."""
    from attestra.operators.ranking import number_rows_by, running
    head = F.regexp_extract(line, r"^#{1,6}\s+(.+?)\s*$", 1)
    marked = number_rows_by(lines.withColumn("_head", F.nullif(head, F.lit(""))), [page, pos], [doc], name="_order")
    flagged = running(marked, [doc], "_order", F.when(F.col("_head").isNotNull(), 1).otherwise(0).cast("long"), "section_no")
    body = F.when(F.col("_head").isNull(), F.col(line))
    agg = flagged.groupBy(doc, "section_no").agg(F.max("_head").alias("_h"), F.min(page).alias("page_start"), F.max(page).alias("page_end"),
                                                 F.array_sort(F.collect_list(F.when(body.isNotNull(), F.struct("_order", body.alias("b"))))).alias("_b"))
    return agg.select(doc, "section_no", F.coalesce("_h", F.lit("Body")).alias("heading"), "page_start", "page_end",
                      strip_space(F.array_join(F.transform("_b", lambda s: s["b"]), "\n")).alias("body"))


def overlap_join(segments: DataFrame, by: Sequence[str], width: float = 5.0, start: str = "start", end: str = "end", text: str = "text") -> DataFrame:
    """Texts of transcript segments per fixed time window they touch, in time order."""
    first = F.floor(F.col(start) / width)
    last = F.greatest(first, F.ceil(F.col(end) / width) - 1)
    touched = segments.filter(F.col(end) > F.col(start)).withColumn("window_no", F.explode(F.sequence(first, last)))
    w0 = F.col("window_no") * width
    kept = touched.filter((F.col(start) < w0 + width) & (F.col(end) > w0))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(start, end, text))), lambda s: s[text]), " ")
    return kept.groupBy(*by, "window_no").agg(F.count("*").alias("segments"), joined.alias("text"))


