"""Sharding by a k-d tree over document metadata (operator 9).

A leaf is one shard. Every node splits at the weighted median (by bytes) of its widest dimension until a leaf has its share of the bytes.
Medians are found by radix refinement: each round sums the bytes under every value of the next 12 bits of the node's key, so what leaves
the executors is one row for a node and round, whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.common import gapless, query, stored, table

VALUE_BITS, TIE_BITS, STEP = 24, 36, 12


def fraction(value: Column) -> Column:
    """A stable place in [0, 1) for a category; the same category has the same place in every run. Null has its own."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit("\0"))), F.lit(1 << 30)) / F.lit(float(1 << 30))


def metadata(lang: str = "lang", source: str = "source") -> dict[str, Column]:
    """The dimensions of ``documents``: language, source and the logarithm of the size."""
    return {"lang": fraction(F.col(lang)), "source": fraction(F.col(source)), "size": F.least(F.log2(F.col("size").cast("double")) / 40, F.lit(0.999999))}


def units(base: DataFrame, dims: list[str], tolerance: float) -> DataFrame:
    """Groups of equal texts with their bytes and the coordinates of their least row; groups above the tolerance are cut in pieces.

    A group of copies stays in one shard unless it is itself larger than the tolerance, so a group that holds a third of all bytes
    is dealt out by a hash of the row while small groups stay whole.
    """
    groups = base.groupBy("_group").agg(F.sum("size").alias("_bytes"), F.min(F.struct("_row", *[f"_{d}" for d in dims])).alias("_least"))
    groups = groups.select("_group", F.greatest(F.lit(1), F.ceil(F.col("_bytes") / F.lit(tolerance))).alias("_pieces"),
                           *[F.col(f"_least._{d}").alias(f"_{d}") for d in dims])
    own = base.select("_group", "_row", "size", "doc_id", "text_crc32").join(groups, "_group")
    return own.withColumn("_piece", F.pmod(F.col("_row"), F.col("_pieces"))).drop("_pieces")


def narrowed(held: DataFrame, nodes: dict[int, dict], exact: float) -> dict[int, int]:
    """For every node the key at which its lower side has its share of the bytes. held: columns node, key (of the node's dimension), bytes."""
    spark, shift = held.sparkSession, VALUE_BITS + TIE_BITS
    at = {n: {"prefix": 0, "left": x["share"] * x["bytes"]} for n, x in nodes.items()}
    cut: dict[int, int] = {}
    while at and shift > 0:
        known = spark.createDataFrame([(n, x["prefix"], float(x["left"])) for n, x in at.items()], "node long, prefix long, remaining double")
        bins = (held.join(F.broadcast(known), "node")  # one row for a node, at most as many as shards
                .filter(F.shiftright("key", shift) == F.col("prefix"))
                .groupBy("node", "remaining", F.shiftright("key", shift - STEP).alias("bin")).agg(F.sum("bytes").alias("bytes")))
        # at most 4096 rows for a node: sums before each bin by a window over them
        sums = bins.withColumn("before", F.expr("sum(bytes) over (partition by node order by bin)") - F.col("bytes"))
        rows = (sums.filter(F.col("before") <= F.col("remaining"))
                .groupBy("node").agg(F.max(F.struct("bin", "before", "bytes", "remaining")).alias("x")).select("node", "x.*").collect())
        shift -= STEP
        for r in rows:
            rest = r.remaining - r.before
            if r.bytes <= exact or shift == 0:  # the nearer border of this bin
                cut[r.node] = (r.bin if rest <= r.bytes / 2 else r.bin + 1) << shift
                del at[r.node]
            else:
                at[r.node] = {"prefix": r.bin, "left": rest}
    return cut


def kd_shards(docs: DataFrame, shards: int = 8, dims: dict[str, Column] | None = None, text: str = "text", id_col: str = "doc_id",
              tolerance: float = 1 / 128) -> DataFrame:
    """Deals all rows to ``shards`` shards of near equal bytes, each a cell of a k-d tree over the metadata.

    Size: UTF-8 bytes of the text plus 1. Equal texts stay together up to ``tolerance`` of a shard's bytes. Null texts count as empty,
    null metadata has a place of its own, null and repeated ids are rows like others, ties go by a hash of the text and an empty table
    gives no rows. Other columns are not read. Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (along id and row hash), grown_shard (null).
    """
    dims = metadata() if dims is None else dims
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.withColumn("size", F.octet_length(body).cast("long") + 1)
    base = stored(base.select(F.col(id_col).alias("doc_id"), "size", F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("_group"),
                              F.xxhash64(F.col(id_col).cast("string"), body).alias("_row"), *[c.alias(f"_{d}") for d, c in dims.items()]), "shard-base")
    total = base.agg(F.sum("size")).first()[0] or 0
    target = total / shards
    held = stored(units(base, list(dims), max(1.0, target * tolerance)), "shard-units")
    coords = [f"_{d}" for d in dims]
    tie = F.pmod(F.xxhash64("_group", "_piece"), F.lit(1 << TIE_BITS))
    cells = stored(held.groupBy("_group", "_piece", *coords).agg(F.sum("size").alias("bytes")).select(
        "_group", "_piece", "bytes", *[(F.shiftleft(F.floor(F.col(c) * (1 << VALUE_BITS)).cast("long"), TIE_BITS) + tie).alias(c) for c in coords]), "shard-cells")

    tree, node = [(1, 0, shards)], F.lit(1).cast("long")
    leaves: dict[int, int] = {}
    while tree:
        placed = cells.withColumn("node", node)
        stats = {r.node: r for r in placed.groupBy("node").agg(F.sum("bytes").alias("bytes"), *[F.min(c).alias(f"min{c}") for c in coords],
                                                               *[F.max(c).alias(f"max{c}") for c in coords]).collect()}
        open_nodes, grown = {}, []
        for n, first, count in tree:
            if count == 1 or n not in stats:
                leaves[n] = first
                continue
            r = stats[n]
            widest = max(coords, key=lambda c: (r[f"max{c}"] - r[f"min{c}"], c))
            open_nodes[n] = {"dim": widest, "share": (count // 2) / count, "bytes": r.bytes}
            grown += [(2 * n, first, count // 2), (2 * n + 1, first + count // 2, count - count // 2)]
        if not open_nodes:
            break
        key = F.coalesce(*[F.when(F.col("node") == n, F.col(x["dim"])) for n, x in open_nodes.items()])
        cuts = narrowed(placed.select("node", key.alias("key"), "bytes").filter("key is not null"), open_nodes, target * tolerance / 4)
        step = node
        for n, x in open_nodes.items():
            step = F.when(F.col("node") == n, F.when(F.col(x["dim"]) >= F.lit(cuts[n]), 2 * n + 1).otherwise(2 * n).cast("long")).otherwise(step if step is not node else F.col("node"))
        cells = stored(placed.withColumn("_next", step).drop("node").withColumnRenamed("_next", "node"), "shard-cells")
        node, tree = F.col("node"), grown + [(n, s, 1) for n, s in leaves.items()]
    names = F.create_map(*[F.lit(x).cast(t) for n, s in leaves.items() for x, t in ((n, "long"), (s, "int"))]) if leaves else F.create_map(F.lit(1).cast("long"), F.lit(0))
    shard_of = cells.withColumn("node", node).select("_group", "_piece", names[F.col("node")].alias("shard"))
    out = held.join(shard_of, ["_group", "_piece"]).select("doc_id", "size", "text_crc32", "shard", "_row")
    return gapless(out, "shard", ["doc_id", "_row"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_kd_sharding")
def op9_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"))
